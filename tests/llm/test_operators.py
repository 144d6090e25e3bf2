"""Each operator against its plain version, on awkward tables and on the fixture tables."""

import random

import pytest

pytest.importorskip("folioforge.llm.queries")

from pyspark.sql import functions as F  # noqa: E402

from folioforge.llm import bpe, linededup, queries, simhash, substring, token_store, topk, warc, winnow  # noqa: E402

from . import brute  # noqa: E402

SF = "/root/testdata/sf0.001"
EXTRA = "doc bigint, hash string, home int, at int, id string, _id int, _text string, fp int, label int, block int, _row int, runs string, items string"


def awkward_texts():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "dé", "x1", "日本", "the", "of", "IT'S", "zz-top"]
    sentence = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, other = sentence(45), sentence(25)
    texts = [None, "", " ", "\n\n", "one", "Two words", "same line here ok\n short \nSAME LINE HERE OK\t\nend", "same line here ok\nnew", " same line here ok"]
    texts += [passage, passage, sentence(7) + " " + passage + "  " + sentence(4), other + "\n" + passage, passage + " " + passage, "a " * 70, "a " * 25, other.upper(), sentence(3000), "ünï " * 30]
    texts += [passage + f" tail{i}" for i in range(6)] + [sentence(rng.randint(1, 60)) for _ in range(20)]
    return texts


@pytest.fixture(scope="module")
def docs():
    texts = awkward_texts()
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    return [*rows, (rows[9][0], rows[9][1]), (None, texts[11]), (10_000_000_000, texts[12])]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for c in EXTRA.split(", ") if extra else []:
        name, kind = c.split()
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def same(df, columns, expected):
    got = sorted((tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.select(*columns).collect()), key=repr)
    assert got == sorted(expected, key=repr)


def unsigned(rows):
    return [(d, f - (1 << 64) if f >= 1 << 63 else f, c) for d, f, c in rows]


def test_decontaminate(spark, docs):
    items = [(1, docs[9][1]), (2, "one"), (3, "Two, words"), (4, None), (5, "!!"), (6, docs[11][1]), (None, "alpha"), (7, docs[12][1]), (7, docs[12][1]), (8, "a " * 30)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = winnow.decontaminate(frame(spark, docs), bench)
    same(out, ["doc_id", "n_words", "n_hit", "items"], brute.decontaminate(docs, items))
    empty = winnow.decontaminate(frame(spark, docs), bench.limit(0))
    assert empty.where("n_hit > 0").count() == 0 and empty.count() == len(docs)
    assert winnow.decontaminate(frame(spark, []), bench).count() == 0


def test_simhash(spark, docs):
    same(simhash.near_duplicates(frame(spark, docs)), ["doc_id", "fp", "component_id"], unsigned(brute.near_duplicates(docs)))
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_simhash_small_tiles(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = sorted({x ^ y for x in base for y in (0, 1, 6, 0b1111 << 20, 1 << 63)} | {rng.getrandbits(64) for _ in range(100)})
    signed = [(x - (1 << 64) if x >= 1 << 63 else x) for x in fps]
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), tile=16)
    roots = {r["node"]: r["root"] for r in simhash.components(found).collect()}
    mine = [roots.get(x, x) for x in signed]
    plain = brute.groups(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    assert len({*zip(mine, plain)}) == len({*mine}) == len({*plain})


def test_simhash_plan_does_not_grow_with_the_tiles(spark):
    """What the driver puts into the plan depends on the 65 population counts alone."""
    rng = random.Random(2)
    fps = spark.createDataFrame([(rng.getrandbits(64) - (1 << 63),) for _ in range(3000)], "fp bigint")
    sizes = [len(simhash.links(fps, tile=t)._jdf.queryExecution().optimizedPlan().toString()) for t in (4, 3000)]
    assert sizes[0] < 1.5 * sizes[1] + 2000


def test_winnow_bitmaps_follow_the_benchmark(spark):
    import numpy as np

    assert [winnow.bits_for(n) for n in (0, 100_000, 5_000_000, 10**9)] == [24, 24, 26, 28]
    hashes = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 500)
    for bits in (24, 26):
        bitmap = winnow._bitmap(spark.createDataFrame([(int(h),) for h in hashes], "hash bigint"), bits)
        assert winnow._has(bitmap, hashes.view(np.uint64)).all()
        assert winnow._has(bitmap, np.random.default_rng(4).integers(0, 2**64, 500, dtype=np.uint64)).sum() < 5


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (200, 201)]
    roots = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {roots[i] for i in range(61)} == {0} and {roots[i] for i in range(100, 160)} == {100} and roots[201] == 200


@pytest.mark.parametrize("batches,fan", [(1, 3), (4, 2), (7, 2)])
def test_line_dedup(spark, docs, batches, fan):
    out = linededup.dedup_lines(frame(spark, docs), batches=batches, fan=fan)
    same(out, ["doc_id", "n_lines", "n_dropped", "text"], brute.dedup_lines(docs))
    assert {"hash", "at", "label"} <= set(out.columns)


def test_line_dedup_of_many_lines_is_linear(spark):
    import time

    text = "\n".join(f"line number {i} of a long list" for i in range(80_000))
    rows = [(1, text), (2, "own first line\n" + text), (3, "a\n" * 80_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    began = time.time()
    same(linededup.dedup_lines(docs), ["doc_id", "n_lines", "n_dropped", "text"], brute.dedup_lines(rows))
    assert time.time() - began < 60


def test_line_dedup_ids_and_names(spark):
    """String ids in their order; columns with the names that are used inside."""
    rows = [("b", "the same line here\nx"), ("a", "the same line here"), ("ab", "The Same Line here \ny"), (None, "the same line here")]
    docs = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, 6) for i, t in rows], "name string, body string, doc int, text int, others int, dropped int, lines int, n_lines int")
    out = linededup.dedup_lines(docs, "name", "body", batches=3, fan=2)
    assert out.columns == ["name", "body", "doc", "text", "others", "dropped", "lines", "n_lines", "n_dropped"]
    same(out, ["name", "n_lines", "n_dropped", "body"], [(i, n, d, t) for i, n, d, t in brute.dedup_lines(rows)])
    assert {tuple(r) for r in out.select("doc", "text", "others", "dropped", "lines").collect()} == {(1, 2, 3, 4, 5)}


def test_line_dedup_runs_are_not_dealt_anew(spark):
    """A batch meets the runs bucket by bucket: neither exchange nor sort of a run."""
    with linededup._bucketed(spark, 8) as buckets:
        runs = linededup.Runs(spark, buckets, fan=3)
        hashed = lambda lo, hi: spark.range(lo, hi).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("hash"), F.col("id").alias("owner"), F.col("id").alias("last"))
        for lo, hi in ((0, 500), (400, 900)):
            firsts = hashed(lo, hi).groupBy("hash").agg(F.min("owner").alias("owner"), F.max("last").alias("last"))
            name = runs.write(runs.marked(firsts), "run_0")
            runs.add(name)
        assert runs.hashes(runs.levels[0][1]).count() == 400
        firsts = hashed(800, 1200).groupBy("hash").agg(F.min("owner").alias("owner"), F.max("last").alias("last"))
        found = runs.marked(firsts)
        assert found.where("known").count() == 100
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and plan.count("FileScan parquet") == 2
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1, plan  # of the batch itself
        name = runs.write(found, "run_0")
        runs.add(name)
        assert [len(level) for level in runs.levels] == [0, 1] and runs.hashes(runs.levels[1][0]).count() == 1200
        runs.drop_all()


def test_line_dedup_empty(spark):
    assert linededup.dedup_lines(frame(spark, [])).count() == 0


@pytest.mark.parametrize("part_bytes", [500, 1 << 20])
def test_substring(spark, docs, part_bytes):
    out = substring.remove_repeats(frame(spark, docs), part_bytes=part_bytes)
    same(out, ["doc_id", "n_words", "n_removed", "kept_text"], brute.remove_repeats(docs))
    assert substring.remove_repeats(frame(spark, [])).count() == 0


def test_top_k(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(130)] + [(200 + i, [0.5] * 8) for i in range(10)]
    rows += [(300, None), (350, [float("nan")] * 8), (400, [None] * 8), (450, [float("inf")] * 8), (None, [0.1] * 8), (500, [0.0] * 8)]
    v = topk.quantise(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("id", F.lit("x")))
    out = topk.search(v, v.where("id % 50 = 0"), 5, block_rows=20, query_rows=2)
    same(out, ["query_id", "rank", "id", "score"], brute.top_k(rows))
    assert topk.search(v.limit(0), v.limit(0)).count() == 0
    few = v.where("id in (0, 1, 2)")
    assert topk.search(few, few.where("id = 0")).count() == 2


def hf():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_bpe(spark, docs):
    t = hf()
    rows = [*docs, (7, "<|startoftext|>Σας ΣΑΣ İ <|endoftext|> don't I'LL ½ ١٢ 한국 🎉"), (8, "x" * 900 + "\x1c\x85y")]
    out = bpe.encode_documents(frame(spark, rows), queries.tokenizer_path(), decoded=True)
    expected = []
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        expected.append((d, tuple(ids), len(ids), t.decode(ids, skip_special_tokens=False)))
    same(out, ["doc_id", "ids", "n_tokens", "decoded"], expected)
    same(bpe.decode_ids(out, queries.tokenizer_path()), ["doc_id", "decoded"], [(e[0], e[3]) for e in expected])
    same(bpe.digest_documents(frame(spark, rows), queries.tokenizer_path()), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], [(e[0], e[2], brute.sha(" ".join(map(str, e[1]))), brute.sha(e[3])) for e in expected])


def test_bpe_backtracks_like_the_merges():
    t, mine = hf(), bpe.WordBpe(queries.tokenizer_path(), cached_words=50)
    rng = random.Random(9)
    for _ in range(1500):
        text = "".join(rng.choice("abcdeehiinorstuyéß'0 !") for _ in range(rng.randint(1, 60)))
        assert mine.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_bpe_knows_the_characters_that_the_library_knows():
    """Also those that Python's Unicode tables do not have yet, alone and among letters."""
    import unicodedata

    import numpy as np

    t, mine = hf(), bpe.WordBpe(queries.tokenizer_path())
    new = [chr(c) for c in range(0x20000) if unicodedata.category(chr(c)) == "Cn" and (c % 5 == 0 or 0x1C80 <= c < 0x1CA0 or 0xA7C0 <= c < 0xA800 or 0x10D40 <= c < 0x10DA0 or 0x13460 <= c < 0x13500)]
    texts = [*new, *(f"a{c}B {c}1" for c in new[::3]), *(chr(c) for c in range(0, 0x3000)), "a\u0301 \u0345\u0300"]
    got = [np.frombuffer(x, "<u4").tolist() for i in range(0, len(texts), 500) for x in mine.encode_batch(texts[i : i + 500])]
    assert got == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_bpe_of_long_texts(monkeypatch):
    t, mine = hf(), bpe.WordBpe(queries.tokenizer_path())
    rng = random.Random(6)
    text = "".join(rng.choice(["word", " ", "\n", "é", "e\u0301", " \u0301", "x" * 40, "12", "İ", "Σ"]) for _ in range(4000))
    whole = t.encode(text, add_special_tokens=False).ids
    for long in (1, 30, 1000, len(text) - 1):
        monkeypatch.setattr(bpe, "LONG", long)
        assert mine.encode(text).tolist() == whole
        assert mine.encode("y" * 500).tolist() == t.encode("y" * 500, add_special_tokens=False).ids
    assert "".join(mine._pieces(text)) == text


def test_bpe_slices_bound_rows_and_bytes():
    import pyarrow as pa

    texts = [None, "", "x" * 10, "y" * (3 << 20), *["z" * 300_000] * 10, *["w"] * 300]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["i", "t"])
    parts = list(bpe.slices([batch]))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(texts)))
    for p in parts:
        assert p.num_rows <= bpe.ROWS and (p.num_rows == 1 or sum(len(x or "") for x in p.column(1).to_pylist()) <= bpe.BYTES)


def test_bpe_caches_are_bounded():
    mine = bpe.WordBpe(queries.tokenizer_path(), cached_words=40)
    mine.table = bpe.WordTable(40, most_units=200)
    t, rng = hf(), random.Random(8)
    for _ in range(300):
        texts = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 12))) for _ in range(2)]
        assert [len(x) // 4 for x in mine.encode_batch(texts)] == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
        assert mine.table.count <= 40 and mine.table.unit_ends[mine.table.count] <= 200


def test_token_store(spark, docs):
    import zlib

    import numpy as np

    t = hf()
    rows = [d for d in docs if d[0] is not None]
    folder = token_store.write_tokens(frame(spark, rows), queries.tokenizer_path(), file_bytes=2_000)
    out = token_store.read_tokens(spark, folder)
    expected, start = [], 0
    for d, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    same(out.withColumn("c", token_store.ids_crc32("ids")), ["doc_id", "start", "n_tokens", "c"], expected)
    assert out.where("doc_id = 27").count() == 2
    assert token_store.read_tokens(spark, token_store.write_tokens(frame(spark, []), queries.tokenizer_path())).count() == 0


def read_rows(df):
    """Rows that the scan of a plan gave out, after it ran; and the plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    return [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())], plan.toString()


def test_token_store_prunes_by_metadata(spark):
    """A read of one id touches one row group; of an id between others the Bloom filter leaves none."""
    docs = spark.range(0, 40_000, 2).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    folder = token_store.write_tokens(docs, queries.tokenizer_path())
    tokens = spark.read.orc(folder)
    assert len(tokens.inputFiles()) == 1 and tokens.count() == 20_000
    rows, plan = read_rows(tokens.where("doc_id = 31234").select("doc_id", "n_tokens"))
    assert sum(rows) <= 1_000 and "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,31234)]" in plan and "ids" not in plan.split("ReadSchema")[1]
    assert sum(read_rows(tokens.where("doc_id = 31235").select("doc_id"))[0]) == 0
    assert sum(read_rows(tokens.where("doc_id >= 38000").select("doc_id"))[0]) == 1_000


def test_token_store_is_read_by_stripe(spark):
    """Several tasks share one file, and give the same rows as one."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(3000)]
    rows = [(i, " ".join(rng.sample(words, 2_000))) for i in range(1_500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    folder = token_store.write_tokens(docs, queries.tokenizer_path(), file_bytes=1 << 30)
    whole = {tuple(r) for r in token_store.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.xxhash64("ids")).collect()}
    with queries.token_store.settings(spark, {"spark.sql.files.maxPartitionBytes": str(1 << 20), "spark.sql.files.openCostInBytes": "0"}):
        out = token_store.read_tokens(spark, folder)
        rdd = spark.read.orc(folder).select("doc_id").rdd
        assert len(spark.read.orc(folder).inputFiles()) == 1 and rdd.getNumPartitions() > 2 and sum(n > 0 for n in rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()) > 1
        assert {tuple(r) for r in out.select("doc_id", "start", "n_tokens", F.xxhash64("ids")).collect()} == whole


def test_token_store_spreads_an_id_with_many_rows(spark):
    rng = random.Random(4)
    rows = [(7, f"hot {rng.random()}") for _ in range(900)] + [(i, f"doc {i}") for i in range(600)] + [(None, "none")]
    folder = token_store.write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), queries.tokenizer_path(), file_bytes=1_500)
    sizes = [r["n"] for r in spark.read.orc(folder).groupBy(F.col("_metadata.file_name")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 8 and max(sizes) < 400
    got = sorted(map(tuple, token_store.read_tokens(spark, folder).select("start", "n_tokens", "doc_id").collect()))
    ends = [0]
    for start, n, _ in got:
        assert start == ends[-1]
        ends.append(start + n)
    ids = [-1 if d is None else d for _, _, d in got]
    assert ids == sorted(ids) and len(ids) == len(rows)


def test_warc(spark):
    big, small = "<p>" + "ä" * 200, "<p>x"
    rows = [(1, "http://a", small), (2, "http://b\r\nX: y", small), (5, None, big), (4, "u", big), (9, "u", big), (7, "u", None), (8, "u", ""), (10, "u", big + "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1)).withColumn("payload", F.lit(2))
    folder = warc.write_pages(pages)
    expected = [(str(p), len((h or "").encode()), brute.sha(h or ""), "revisit" if h == big and p != 4 else "response", "4" if h == big and p != 4 else None) for p, _, h in rows]
    same(warc.read_pages(spark, folder), ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], expected)
    plan = spark.read.format("warc").load(folder).where("warc_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "warc_type" in plan
    assert warc.read_pages(spark, warc.write_pages(pages.limit(0))).count() == 0


def test_warc_passes_over_payloads_without_inflating_them(monkeypatch):
    """Of unwanted records only the headers are inflated; wanted payloads come whole."""
    import io
    import os

    big = os.urandom(300_000).hex().encode()
    rows = [{"record_id": f"<{i}>", "warc_type": t, "payload": p} for i, (t, p) in enumerate([("response", big), ("revisit", b""), ("response", b"x\r\n\r\ny"), ("metadata", big), ("response", b"")])]
    data = b"".join(warc.packed(warc.record(r)) for r in rows)
    assert __import__("gzip").decompress(data) == b"".join(warc.record(r) for r in rows)  # any gzip reader reads it
    bodies = []
    made = warc._Inflated
    monkeypatch.setattr(warc, "_Inflated", lambda *a: bodies.append(made(*a)) or bodies[-1])
    read = lambda wanted, payload: [(r["record_id"], r.get("payload")) for r in warc.parse_members(io.BytesIO(data), wanted, payload)]
    assert read(lambda h: True, lambda h: True) == [(r["record_id"], r["payload"]) for r in rows]
    bodies.clear()
    assert read(lambda h: h["warc_type"] != "response", lambda h: h["warc_type"] != "metadata") == [("<1>", b""), ("<3>", None)]
    assert sum(b.inflated for b in bodies) < 5 * 1_200
    # Members without a length, behind some with one.
    foreign = data + __import__("gzip").compress(warc.record(rows[2])) + __import__("gzip").compress(warc.record(rows[3]))
    got = [(r["record_id"], r.get("payload")) for r in warc.parse_members(io.BytesIO(foreign), lambda h: True, lambda h: h["warc_type"] == "response")]
    assert got[5:] == [("<2>", rows[2]["payload"]), ("<3>", None)]


def test_warc_reads_an_archive_once_and_overwrites_safely(spark, tmp_path):
    place = str(tmp_path / "archive")
    pages = spark.createDataFrame([(i, "u", "p" * 150 if i % 2 else f"own {i} " * 50) for i in range(40)], "page_id bigint, url string, html string")
    warc.write_pages(pages, place)
    plan = warc.read_pages(spark, place)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1
    assert warc.read_pages(spark, place).groupBy("record_type").count().orderBy("record_type").collect() == [("response", 21), ("revisit", 19)]
    warc.page_records(pages.limit(3)).write.format("warc").mode("overwrite").save(place)
    assert warc.read_pages(spark, place).count() == 3
    assert sum(p.name.startswith("_manifest") for p in (tmp_path / "archive").iterdir()) == 1


def test_warc_headers_only_and_foreign_files(spark, tmp_path):
    body = warc.record({"record_id": "<urn:page:1>", "warc_type": "response", "payload": b"a\r\n\r\nWARC/1.1\r\n"}) + warc.record({"warc_type": "metadata", "payload": b""})
    (tmp_path / "x.warc").write_bytes(body)
    warc.register(spark)
    full = spark.read.format("warc").load(str(tmp_path)).select("warc_type", "payload").collect()
    assert [(r[0], bytes(r[1])) for r in full] == [("response", b"a\r\n\r\nWARC/1.1\r\n"), ("metadata", b"")]
    heads = spark.read.format("warc").option("payload", "false").load(str(tmp_path)).where("warc_type in ('metadata', 'x')").collect()
    assert [(r["warc_type"], r["payload"]) for r in heads] == [("metadata", None)]


def test_queries_match_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    q = queries.queries()
    for name, sql in queries.oracle_sql().items():
        df = q[name](spark, SF)
        table = con.sql(sql).to_arrow_table()
        assert sorted(df.columns) == sorted(table.column_names)
        same(df, sorted(df.columns), [tuple(r[c] for c in sorted(r)) for r in table.to_pylist()])


def shared_ids(ids, key):
    """Rows of one id whose texts differ, with a passage (and a line) that an earlier document holds."""
    rng = random.Random(11)
    words = lambda n, c: " ".join(f"{c}{rng.randrange(1000)}" for _ in range(n))
    passage, other = words(30, "p"), words(25, "q")
    long, short, plain = words(120, "a") + "\n" + passage + "\n" + words(9, "b"), words(25, "c") + "\n" + other, words(300, "d") + "\n" + words(40, "e")
    texts = [long, short, plain, passage + "\n" + plain, words(3, "f"), None]
    return [(key, passage + "\n" + other), *[(i, t) for t in texts for i in ids], (9, words(60, "g"))]


@pytest.mark.parametrize("ids,key", [([None], -(2**62)), ([5], 1), ([5, 5, 6], 1), ([None, 7], 1)])
def test_rows_of_one_id_keep_apart(spark, ids, key):
    rows = shared_ids(ids, key)
    df = frame(spark, rows, extra=False)
    for part_bytes in (500, 1 << 20):
        same(substring.remove_repeats(df, part_bytes=part_bytes), ["doc_id", "n_words", "n_removed", "kept_text"], brute.remove_repeats(rows))
    same(linededup.dedup_lines(df), ["doc_id", "n_lines", "n_dropped", "text"], brute.dedup_lines(rows))


def test_substring_compares_words(spark):
    """Words that a polynomial hash modulo 2**64 cannot tell apart, whatever its base."""
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    shared = [f"w{i}" for i in range(10)]
    rows = [(1, " ".join([*shared, one, *shared])), (2, " ".join([*shared, two, *shared]))]
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in got.collect()} == {1: 0, 2: 0}


def test_substring_one_passage_in_every_document(spark):
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i << 20, " ".join(f"x{rng.randrange(10**6)}" for _ in range(40)) + " " + passage + f" end{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    same(substring.remove_repeats(docs, part_bytes=20_000), ["doc_id", "n_words", "n_removed", "kept_text"], brute.remove_repeats(rows))


def test_substring_hot_block_costs_an_entry_a_home():
    """What a part gets of a passage does not grow with the copies in a home, and ids that share low bits spread out."""
    import numpy as np
    import pyarrow as pa

    passage = " ".join(f"p{i}" for i in range(30))
    sizes = []
    for n in (50, 800):
        table = pa.table({"_name": np.arange(n), "_print": np.arange(n), "_text": [passage] * n})
        probes = substring._probe(3, table, 1)
        sizes.append(sum(len(x) for c in ("asked", "others") for x in probes.column(c).to_pylist() if x))
    assert sizes[0] == sizes[1]


def test_home_bytes():
    assert substring.home_bytes(1 << 30) == 8 << 20 and substring.home_bytes(100 << 40) == 64 << 20
    assert substring.home_bytes(10**6, 500) >= 500


def test_texts_longer_than_a_chunk(spark):
    """One text of some 2.5 MB beside small ones, through every operator on documents."""
    import zlib

    import numpy as np

    from folioforge.llm import quality, toxicity

    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvé") for _ in range(rng.randint(2, 9))) for _ in range(20_000)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, item = line(60), line(12)
    long = "\n".join(line(25) for _ in range(15_000)) + "\n" + passage + "\n" + item
    rows = [(1, line(50)), (2, passage), (3, long), (4, line(30) + " " + item), (5, None), (6, line(9) + "\n" + long[:3000])]
    assert len(long) > 2_300_000
    df = frame(spark, rows, extra=False)
    same(substring.remove_repeats(df), ["doc_id", "n_words", "n_removed", "kept_text"], brute.remove_repeats(rows))
    same(linededup.dedup_lines(df), ["doc_id", "n_lines", "n_dropped", "text"], brute.dedup_lines(rows))
    items = [(1, item)]
    same(winnow.decontaminate(df, spark.createDataFrame(items, "item_id bigint, text string")), ["doc_id", "n_words", "n_hit", "items"], brute.decontaminate(rows, items))
    same(simhash.near_duplicates(df), ["doc_id", "fp", "component_id"], unsigned(brute.near_duplicates(rows)))
    t = hf()
    ids = {d: t.encode(x or "", add_special_tokens=False).ids for d, x in rows}
    same(bpe.digest_documents(df, queries.tokenizer_path()), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], [(d, len(x), brute.sha(" ".join(map(str, x))), brute.sha(t.decode(x, skip_special_tokens=False))) for d, x in ids.items()])
    out = token_store.read_tokens(spark, token_store.write_tokens(df, queries.tokenizer_path(), file_bytes=1 << 20))
    same(out.withColumn("c", token_store.ids_crc32("ids")), ["doc_id", "n_tokens", "c"], [(d, len(x) + 1, zlib.crc32(np.array([*x, 2], "<u4").tobytes())) for d, x in ids.items()])
    for module, column in ((quality, "quality"), (toxicity, "toxic")):
        labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 0), (6, 1)], f"doc_id bigint, {column} int")
        scores = module.classify(df, labels).select("score").collect()
        assert len(scores) == len(rows) and all(0 <= r["score"] <= 1 for r in scores)
