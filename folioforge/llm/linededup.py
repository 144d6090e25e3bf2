"""Line dedup over levelled sorted runs of line hashes.

State is a set of runs: tables of line hashes in the shared folder, bucketed
and sorted by hash, all with the same number of buckets.  Documents come in
batches of rising ids.  A batch's distinct hashes, pre-aggregated with their
first and last document, are merge-joined bucket by bucket with every run, so
neither a run nor the batch is dealt anew or sorted again for a join; what no run
holds is new and becomes a run of level 0.  ``FAN`` runs of one level are
merged into one of the next, so a hash is rewritten a logarithmic number of
times.

All work is DataFrame operations.  A line that very many documents hold is one
row a task before the shuffle; where its lines are looked up, Spark splits the
skewed join.  The text is shuffled once, to meet its own list of dropped lines.
That list is taken away as a set, so the work is linear in a text's lines.

Defined cases: a null or empty text is one empty line and stays; keys of fewer
than ``LEAST`` code points are never dropped; rows with equal ids are one
document, so none of them loses lines to another, and each loses the lines that
its own text shares with an earlier document; rows with a null id keep all
lines and claim none; ids are of any type that Spark orders; an empty table
gives an empty result; a very long text is one row and is split into lines in
memory; other columns are kept whatever their names, but for ``n_lines`` and
``n_dropped``, which the counts replace.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cut, cut_at, drop_path, scratch, settings, spread, text_bytes

LEAST = 10
BATCHES = 4
FAN = 2
#: UTF-8 bytes of text whose line hashes fall into one bucket of a run, and the fewest buckets.
BUCKET_BYTES, BUCKETS = 128 << 20, 8
#: Ids that are gathered to choose the batches; the result does not depend on them.
KEYS = 20_000
_BLANKS = " \t\n\v\f\r"


def line_key(key):
    """A line without blanks at both ends, A-Z lower-cased."""
    # In ASCII text ``lower`` changes nothing but A-Z, and is much faster.
    return F.when(F.octet_length(key) == F.length(key), F.lower(key)).otherwise(F.translate(key, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def text_lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def text_tag(text):
    """A hash of the whole text; a null text is an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_hashes(docs: DataFrame) -> DataFrame:
    """(hash, doc, tag, at): positions of the long lines of each text; the tag tells texts of one id apart."""
    lines = docs.where("doc IS NOT NULL").select("doc", text_tag(F.col("text")).alias("tag"), F.posexplode(text_lines(F.col("text"))).alias("at", "line"))
    # Lower-casing keeps the length, so the test needs no key.
    whole = F.trim("line", F.lit(_BLANKS))
    return lines.where(F.length(whole) >= LEAST).select(F.unhex(F.md5(line_key(whole))).alias("hash"), "doc", "tag", "at")


@dataclass
class Runs:
    """Levelled runs: bucketed, sorted tables in the shared folder."""

    spark: SparkSession
    buckets: int
    fan: int = FAN
    levels: list[list[str]] = field(default_factory=list)
    _tables: dict[str, str] = field(default_factory=dict)

    def write(self, rows: DataFrame, what: str) -> str:
        """A table of ``rows``, which are dealt by hash into as many partitions as there are buckets."""
        name, path = f"folioforge_{what}_{uuid.uuid4().hex}", scratch(self.spark, what)
        rows.write.bucketBy(self.buckets, "hash").sortBy("hash").option("path", path).saveAsTable(name)
        self._tables[name] = path
        return name

    def path(self, name: str) -> str:
        return self._tables[name]

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_path(self.spark, self._tables.pop(name))

    def drop_all(self) -> None:
        for name in list(self._tables):
            self.drop(name)

    def hashes(self, name: str) -> DataFrame:
        """The hashes that came with a run."""
        return self.spark.table(name).where("NOT known").select("hash")

    def marked(self, firsts: DataFrame) -> DataFrame:
        """``firsts`` with known = some run holds the hash: one merge join a run."""
        known = F.lit(False)
        for i, name in enumerate(name for level in self.levels for name in level):
            firsts = firsts.join(self.hashes(name).withColumn(f"in_{i}", F.lit(True)).hint("merge"), "hash", "left")
            known = known | F.coalesce(f"in_{i}", F.lit(False))
        return firsts.select("hash", "owner", "last", known.alias("known"))

    def add(self, name: str) -> None:
        """Take a batch's table as a run of level 0, then compact full levels."""
        at = 0
        while True:
            if len(self.levels) <= at:
                self.levels.append([])
            self.levels[at].append(name)
            if len(self.levels[at]) < self.fan:
                return
            full, self.levels[at] = self.levels[at], []
            merged = self.hashes(full[0])
            for other in full[1:]:
                merged = merged.union(self.hashes(other))
            at += 1
            name = self.write(merged.repartition(self.buckets, "hash").withColumn("known", F.lit(False)), f"run_{at}")
            for old in full:
                self.drop(old)


@contextmanager
def _bucketed(spark: SparkSession, buckets: int) -> Iterator[int]:
    """Shuffles deal into as many partitions as there are buckets, and scans tell that a bucket is sorted."""
    with settings(spark, {"spark.sql.shuffle.partitions": str(buckets), "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}):
        yield int(spark.conf.get("spark.sql.shuffle.partitions"))


def _batch_bounds(docs: DataFrame, batches: int) -> list:
    """Ids at which the batches end, from a bounded sample of the id column."""
    keys = docs.where("doc IS NOT NULL").select("doc")
    n = keys.count() if batches > 1 else 0
    if n > KEYS:
        keys = keys.sample(KEYS / n, seed=1)
    found = [r["doc"] for r in keys.orderBy("doc").collect()] if n else []
    return list(dict.fromkeys(found[i * len(found) // batches] for i in range(1, batches))) if found else []


def dropped_lines(docs: DataFrame, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """(doc, tag, dropped array<int>): positions of the lines that an earlier document holds."""
    spark = docs.sparkSession
    bounds = _batch_bounds(docs, batches)
    hashed, hashed_at = cut_at(line_hashes(docs), "line-hashes")  # the text is read once for all batches
    out, edges = None, [None, *bounds, None]
    with _bucketed(spark, spread(text_bytes(docs), BUCKET_BYTES, BUCKETS)) as buckets:
        runs = Runs(spark, buckets, fan)
        for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
            lines = hashed
            if low is not None:
                lines = lines.where(F.col("doc") > F.lit(low))
            if high is not None:
                lines = lines.where(F.col("doc") <= F.lit(high))
            name = runs.write(runs.marked(lines.groupBy("hash").agg(F.min("doc").alias("owner"), F.max("doc").alias("last"))), "run_0")
            # Earlier batches hold smaller ids, so a hash of a run has an earlier owner.
            # Read by its path, not as a bucketed table: both sides of this join are dealt, so Spark splits a hot hash.
            shared = spark.read.schema(spark.table(name).schema).parquet(runs.path(name)).where("known OR owner < last").select("hash", "owner", "known")
            gone = lines.join(shared.hint("merge"), "hash").where("known OR doc > owner").groupBy("doc", "tag").agg(F.collect_set("at").alias("dropped"))
            gone = cut(gone, "dropped")
            out = gone if out is None else out.union(gone)
            if i < len(edges) - 2:
                runs.add(name)
        runs.drop_all()
    drop_path(spark, hashed_at)
    return out


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """All columns of ``docs`` with the kept text, plus n_lines and n_dropped (bigint)."""
    others = [c for c in docs.columns if c not in (text_column, "n_lines", "n_dropped")]
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("others"), F.col(id_column).alias("doc"), F.col(text_column).alias("text"))
    gone = dropped_lines(plain.select("doc", "text"), batches, fan)
    tagged = plain.withColumn("tag", text_tag(F.col("text")))
    # A merge join at every size: the list of dropped lines grows with the input.
    joined = tagged.join(gone.hint("merge"), ["doc", "tag"], "left").select("others", "text", "dropped", text_lines(F.col("text")).alias("lines"))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    kept = F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.transform(places, lambda i: F.get("lines", i)), "\n"))
    columns = [kept.alias(c) if c == text_column else F.col("others").getField(c).alias(c) for c in docs.columns if c in [*others, text_column]]
    return joined.select(*columns, F.size("lines").cast("bigint").alias("n_lines"), F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("bigint").alias("n_dropped"))
