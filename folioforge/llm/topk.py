"""Exact top-k inner-product search by term-at-a-time accumulation.

Vectors are sparse integer rows (terms, weights).  Candidates are dealt into
blocks; a block turns its rows into postings (term -> row numbers, weights).
Query rows come to every block in query blocks (a stated query set against all
rows, in blocks), scatter their weighted postings into a dense score array,
and a partition selection keeps each query's best k.  The blocks' lists are
merged by rank.

Defined cases: rows whose vector is null or holds null or non-finite
components take no part; a query meets every row with another id; ties go to
the smaller id; with fewer candidates all are returned; repeated ids are
separate candidates of the same id; empty tables give an empty result; other
columns are not read.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

BLOCK_ROWS = 8_192
QUERY_ROWS = 4_096


def quantise(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(id, terms, weights): floor(scale * x) of whole finite vectors, zeros left out."""
    x = F.transform(F.col(vector_column), lambda v: v.cast("double"))
    good = F.col(vector_column).isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    cells = F.transform(x, lambda v, i: F.struct(i.alias("t"), F.floor(v * scale).cast("bigint").alias("w")))
    rows = vectors.where(good).select(F.col(id_column).cast("bigint").alias("id"), F.filter(cells, lambda c: c["w"] != 0).alias("c")).where("id IS NOT NULL")
    return rows.select("id", F.transform("c", lambda c: c["t"]).alias("terms"), F.transform("c", lambda c: c["w"]).alias("weights"))


def _postings(rows: pd.DataFrame) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Ids in rising order, and for each term its row numbers and weights."""
    rows = rows.sort_values("id", kind="stable")
    sizes = rows["terms"].map(len).to_numpy()
    terms = np.concatenate([np.asarray(x, np.int64) for x in rows["terms"]]) if len(rows) else np.zeros(0, np.int64)
    weights = np.concatenate([np.asarray(x, np.int64) for x in rows["weights"]]) if len(rows) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(terms, kind="stable")
    edges = np.flatnonzero(np.diff(terms[order])) + 1
    out = {}
    for part in np.split(order, edges):
        if len(part):
            # A term that every row has needs no row numbers.
            at = row[part]
            out[int(terms[part[0]])] = (slice(None) if len(at) == len(rows) and np.array_equal(at, np.arange(len(rows))) else at, weights[part])
    return rows["id"].to_numpy(), out


def best(ids: np.ndarray, postings: dict, query: int, terms, weights, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the query's best k rows of one block."""
    scores = np.zeros(len(ids), np.int64)
    for t, w in zip(terms, weights, strict=True):
        found = postings.get(int(t))
        if found is not None:
            scores[found[0]] += int(w) * found[1]
    scores, own = scores[ids != query], ids[ids != query]
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        level = np.flatnonzero(scores == least)[: k - len(above)]  # rising ids
        at = np.concatenate([above, level])
        scores, own = scores[at], own[at]
    return own, scores


def search(rows: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, id, score): the k best rows of each query; both sides as ``quantise`` gives them."""
    n_rows, n_queries = rows.count(), queries.count()
    blocks, query_blocks = max(1, -(-n_rows // block_rows)), max(1, -(-n_queries // query_rows))
    # A task holds one block of rows and one of queries, whatever the tables' sizes.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = queries.withColumn("qblock", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(candidates: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        ids, postings = _postings(candidates)
        out: dict[str, list] = {"query_id": [], "id": [], "score": []}
        for q, terms, weights in zip(questions["id"], questions["terms"], questions["weights"], strict=True):
            own, scores = best(ids, postings, q, terms, weights, k)
            out["query_id"] += [q] * len(own)
            out["id"] += own.tolist()
            out["score"] += scores.tolist()
        return pd.DataFrame({n: np.array(v, np.int64) for n, v in out.items()})

    lists = dealt.groupBy("block", "qblock").cogroup(asked.groupBy("block", "qblock")).applyInPandas(run, "query_id bigint, id bigint, score bigint")
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return lists.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
