"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, decontamination, BPE.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and reread as the next stage's ``docs``.  All stages but the last
return the columns of ``docs``.  Joins with lists that grow with the input are
merge joins at every size.

Defined cases: decisions are made by row, not by id.  Rows with a null id, and
rows of one id with different texts, are documents of their own in every stage
that drops documents; line dedup takes rows of one id as one document, and
leaves rows with a null id as they are.  Rows that are repeated whole count as
near copies, so one of them stays.  Null and empty texts are clean and near
copies of each other.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioforge.llm import bpe, linededup, simhash, toxicity, winnow
from folioforge.llm.common import cut_at, drop_path
from folioforge.llm.queries import tokenizer_path

#: No DuckDB SQL: the classifier, XXH64 with a seed and BPE are not expressible in it.
ORACLE_SQL = None


def _digest():
    return F.md5(F.coalesce("text", F.lit("")))


def _key(doc_id, digest):
    return F.concat_ws(" ", doc_id.cast("string"), digest)


def _keyed(docs: DataFrame) -> DataFrame:
    """With a key that only rows of the same id and text share."""
    return docs.withColumn("__key", _key(F.col("doc_id"), _digest()))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    keyed = _keyed(docs)
    rejected = toxicity.score_documents(keyed, model, "__key").where(F.col("score") >= toxicity.THRESHOLD).select("__key").distinct()
    return keyed.join(rejected.hint("merge"), "__key", "left_anti").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; n_chars follows the text."""
    out = linededup.dedup_lines(docs).select(docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, so a row without a near copy always does.

    It is the row with the smallest id, null ids last; of rows with that id
    (or of none but null ids) the one with the smallest MD5 of its text, then
    any of them, since those have the same text.  Rows with one id and texts
    that are no near copies are different documents, and each stays.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", _digest().alias("digest"))
    near = simhash.near_duplicates(docs.select(rank.alias("rank"), "text"), "rank")
    first = near.where(F.col("rank").eqNullSafe(F.col("component_id")))
    kept = first.select(_key(F.col("rank.doc_id"), F.col("rank.digest")).alias("__key")).distinct()
    # Rows with one key are alike; the join has brought them together.
    return _keyed(docs).join(kept.hint("merge"), "__key", "left_semi").dropDuplicates(["__key"]).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    keyed = _keyed(docs)
    hit = winnow.decontaminate(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "__key").where("n_hit > 0").select("__key").distinct()
    return keyed.join(hit.hint("merge"), "__key", "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    return bpe.digest_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, place = cut_at(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:  # the stage after it is written
            drop_path(spark, before)
        before = place
    return STAGES[-1][1](spark, docs, sf_dir)
