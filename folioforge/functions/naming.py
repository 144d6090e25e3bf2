"""File names and title lines of outputs, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import text as T

NAME_MOST, TITLE_MOST = 200, 50
_TEXT = lambda name: F.coalesce(F.col(name), F.lit(""))


def default_name(suffix: Column | str = "") -> Column:
    """Name by task type, from the promoted task columns."""
    end = F.lit(suffix) if isinstance(suffix, str) else suffix
    interp = F.concat(F.lit("第"), _TEXT("num"), F.lit("条【"), T.safe_name(_TEXT("title"), TITLE_MOST), F.lit("】"), end)
    head = F.concat(F.lit("证据分析【"), _TEXT("evidence"), F.lit("】"))
    by_point = F.concat(head, _TEXT("yaodian_name"), F.when(_TEXT("sub_name") != "", F.concat(F.lit("（"), _TEXT("sub_name"), F.lit("）"))).otherwise(F.lit("")))
    by_fact = F.concat(head, F.lit("非法证据排除（"), _TEXT("point"), F.lit("）"))
    other = T.safe_name(F.coalesce("task_id", F.lit("output")), NAME_MOST)
    return F.when(F.col("type") == "interp", interp).when(F.col("type").isin("evidence", "evidence_sub"), by_point).when(F.col("type") == "json_dict", by_fact).otherwise(other)


def output_names(tasks: DataFrame, pattern: str = "", title_prefix: str = "", suffix: str = "") -> DataFrame:
    """Adds ``file`` and ``title_line``; ``meta`` (map) fills the pattern.

    With a pattern the name is the filled pattern; the title line is the
    prefix with a colon, or the bare name.
    """
    if not pattern:
        named = tasks.withColumn("_name", default_name(F.when(F.col("type") == "interp", F.lit(suffix)).otherwise(F.lit(""))))
        return named.withColumn("file", F.concat("_name", F.lit(".md"))).withColumn("title_line", F.concat("_name", F.lit("："))).drop("_name")
    named = tasks.withColumn("_name", T.safe_name(T.fill_from_map(F.lit(pattern), "meta"), NAME_MOST))
    line = F.lit(f"{title_prefix}：") if title_prefix else F.col("_name")
    return named.withColumn("file", F.concat("_name", F.lit(".md"))).withColumn("title_line", line).drop("_name")


def _numbered(names: DataFrame) -> DataFrame:
    """(base, k): names that look like the k-th holder of a base name."""
    stem, kind = T.file_stem("name"), T.extension("name")
    parts = names.select(F.regexp_extract(stem, r"^(.+)_(\d{1,9})$", 1).alias("stem"), F.regexp_extract(stem, r"^(.+)_(\d{1,9})$", 2).alias("k"), kind.alias("kind"))
    return parts.where("stem <> ''").groupBy(F.concat("stem", "kind").alias("base")).agg(F.max(F.col("k").cast("int")).alias("most"))


def unique_names(df: DataFrame, name: str = "file", order: str = "ord", taken: DataFrame | None = None) -> DataFrame:
    """Second and later holders of one name get ``_1``, ``_2`` before the extension.

    ``taken`` (name) holds names of other outputs, which no row gets.  Numbers go
    on behind the largest that a taken name, or a name of a row, has already.
    Numbering needs the rows of one name in order; the sort of a name that
    many rows share spills to disk.
    """
    own = df.select(F.col(name).alias("name"))
    others = taken.select(F.col(taken.columns[0]).alias("name")) if taken is not None else own.limit(0)
    most = _numbered(own.union(others)).select(F.col("base").alias(name), F.col("most").alias("_most"))
    held = others.distinct().select(F.col("name").alias(name), F.lit(1).alias("_held"))
    rank = F.row_number().over(Window.partitionBy(name).orderBy(order)) - 1 + F.coalesce("_held", F.lit(0))
    number = F.col("_n") + F.coalesce("_most", F.lit(0))
    numbered = F.concat(T.file_stem(name), F.lit("_"), number.cast("string"), T.extension(name))
    out = df.join(most, name, "left").join(held, name, "left").withColumn("_n", rank).withColumn("_new", F.when(F.col("_n") > 0, numbered).otherwise(F.col(name)))
    return out.select(*[F.col("_new").alias(c) if c == name else F.col(c) for c in df.columns])
