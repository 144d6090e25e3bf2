"""Page ranges: look-ups, range joins and ordered text assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T


def ranges_table(spark: SparkSession, page_ranges: dict[str, tuple[int, int]]) -> DataFrame:
    return spark.createDataFrame([(g, a, b) for g, (a, b) in page_ranges.items()], "grp string, start_page int, end_page int")


def lookup_ranges(tasks: DataFrame, ranges: DataFrame, on: str = "grp") -> DataFrame:
    """Left look-up of each task's group; the planner broadcasts the ranges only while they are small."""
    found = ranges.select(F.col("grp").alias(on), F.col("start_page").alias("range_start"), F.col("end_page").alias("range_end"))
    return tasks.join(found, on, "left")


def valid_pages(start: str = "start_page") -> F.Column:
    """Ranges begin at page 1 or later."""
    return F.assert_true(F.col(start) >= 1, F.lit("a page range starts before page 1"))


def pages_in_ranges(entries: DataFrame, pages: DataFrame, keys: list[str], start: str = "start_page", end: str = "end_page") -> DataFrame:
    """Entries with one row a page of their inclusive range, as an equi-join.

    A range is unrolled to its page numbers (no nested-loop join); pages that
    are not there give null text.
    """
    last = pages.groupBy("pdf_id").agg(F.max("page_no").alias("_last"))
    clipped = entries.join(last, "pdf_id", "left").withColumn("_stop", F.least(F.col(end), F.coalesce("_last", F.lit(0))))
    numbers = F.when(F.col("_stop") >= F.col(start), F.sequence(F.col(start), F.col("_stop"))).otherwise(F.array().cast("array<int>"))
    unrolled = clipped.select(*entries.columns, F.explode_outer(numbers).alias("page_no"))
    return unrolled.join(pages, ["pdf_id", "page_no"], "left")


def ordered_text(rows: DataFrame, keys: list[str], separator: str = "\n", order: str = "page_no", text: str = "text") -> DataFrame:
    """(keys, n_pages, text): non-empty texts in order, joined; no pages give the empty text."""
    filled = F.nullif(F.col(text), F.lit(""))
    parts = F.array_sort(F.collect_list(F.when(filled.isNotNull(), F.struct(F.col(order), filled.alias("t")))))
    return rows.groupBy(*keys).agg(parts.alias("_p")).select(*keys, F.size("_p").alias("n_pages"), F.array_join(F.transform("_p", lambda p: p["t"]), separator).alias("text"))


def range_text(entries: DataFrame, pages: DataFrame, keys: list[str], start: str = "start_page", end: str = "end_page") -> DataFrame:
    """Text of each entry's page range."""
    slim = entries.select("pdf_id", *[k for k in keys if k != "pdf_id"], F.col(start).cast("int").alias("_a"), F.col(end).cast("int").alias("_b"))
    return ordered_text(pages_in_ranges(slim, pages.select("pdf_id", F.col("page_no").cast("int").alias("page_no"), "text"), keys, "_a", "_b"), keys)


def range_tables(entries: DataFrame, page_tables: DataFrame, keys: list[str], start: str = "start_page", end: str = "end_page") -> DataFrame:
    """Markdown of the non-empty tables of each entry's page range."""
    drawn = page_tables.where(F.size("rows") > 0).select("pdf_id", F.col("page_no").cast("int").alias("page_no"), "table_ix", T.markdown_table("rows").alias("text"))
    slim = entries.select("pdf_id", *[k for k in keys if k != "pdf_id"], F.col(start).cast("int").alias("_a"), F.col(end).cast("int").alias("_b"))
    joined = pages_in_ranges(slim, drawn, keys, "_a", "_b").withColumn("_at", F.struct("page_no", "table_ix"))
    return ordered_text(joined, keys, "\n\n", "_at")


def group_text(ranges: DataFrame, pages: DataFrame) -> DataFrame:
    """(grp, text): each group's pages are put together once, however many tasks use them."""
    return range_text(ranges, pages, ["grp"]).select("grp", "text")
