"""The pipeline's stages against plain versions of what they decide."""

import pytest

pytest.importorskip("folioforge.llm.queries")

import corpus_pipeline  # noqa: E402
from folioforge.llm import queries, toxicity  # noqa: E402

from . import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    verdict = {r["doc_id"] for r in toxicity.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in verdict)
    rows = [(d, t) for d, _, _, t in brute.dedup_lines(rows)]
    rows = [r for r, (d, _, c) in zip(rows, brute.near_duplicates(rows)) if d == c]
    rows = [r for r, hit in zip(rows, brute.decontaminate(rows, bench)) if not hit[2]]
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == [d for d, _ in rows]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    ids = {d: t.encode(x, add_special_tokens=False).ids for d, x in rows}
    assert all(r["n_tokens"] == len(ids[r["doc_id"]]) and r["ids_sha256"] == brute.sha(" ".join(map(str, ids[r["doc_id"]]))) for r in got)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert out.where("n_chars <> length(text)").count() == 0
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_release_deletes_scratch_tables(spark):
    from folioforge.llm import common

    common.release(spark)
    table, place = common.cut_at(spark.range(3), "x")
    assert table.count() == 3 and common.release(spark) == 1 and common.release(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(place).count()


def stage_rows(spark, stage, rows):
    return sorted(((r["doc_id"], r["text"]) for r in stage(spark, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), SF).collect()), key=repr)


def words(prefix, n=40):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_near_dedup_keeps_clean_documents_without_id(spark):
    rows = [(1, words("a")), (None, words("b")), (None, words("c")), (None, words("c")), (None, words("a")), (2, words("a")), (3, words("d"))]
    expected = [(1, words("a")), (None, words("b")), (None, words("c")), (3, words("d"))]
    assert stage_rows(spark, corpus_pipeline.drop_near_copies, rows) == sorted(expected, key=repr)


def test_decontamination_sees_documents_without_id(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(None, words("a") + " " + item), (None, words("b")), (None, None), (4, item), (5, words("c"))]
    assert stage_rows(spark, corpus_pipeline.drop_contaminated, rows) == sorted([rows[1], rows[2], rows[4]], key=repr)


def test_near_dedup_keeps_one_of_repeated_rows(spark):
    rows = [(1, words("a")), (1, words("a")), (1, words("b")), (2, words("a")), (5, words("c", 1000) + " x"), (5, words("c", 1000))]
    out = stage_rows(spark, corpus_pipeline.drop_near_copies, rows)
    assert len(out) == 3 and out[:2] == [(1, words("a")), (1, words("b"))] and out[2][0] == 5


def test_stages_decide_by_row(spark):
    """Of rows with one id, or none, only the toxic and the contaminated go."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(4, item), (4, words("a")), (None, item), (None, words("b")), (4, None), (6, "")]
    kept = [rows[1], rows[3], rows[4], rows[5]]
    assert stage_rows(spark, corpus_pipeline.drop_contaminated, rows) == sorted(kept, key=repr)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs, other = spark.read.parquet(f"{SF}/documents.parquet"), 10**9
    toxic = [r["text"] for r in toxicity.classify(docs, labels).where("predicted = 1").join(docs, "doc_id").collect()]
    assert toxic
    more = [*((other, t) for t in toxic), *((None, t) for t in toxic), (other, words("a")), (None, words("b"))]
    out = corpus_pipeline.drop_toxic(spark, docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string")), SF)
    assert [tuple(r) for r in out.where(f"doc_id IS NULL OR doc_id = {other}").orderBy("doc_id").collect()] == [(None, words("b")), (other, words("a"))]
