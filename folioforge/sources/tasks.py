"""Task sources: tables of contents, inline lists and tables, three JSON shapes.

Each gives the same columns, so branches unite by name:
``task_id, label, grp, type, ord, num, title, start_page, end_page, next_num,
evidence, yaodian_name, sub_item, sub_name, point, pages, meta`` where ``meta``
is a string map of all fields.  Ids are strings.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as t

from ..functions import text as T

# Fixed values --------------------------------------------------------------
LAST_PAGES = 5
ID_TITLE, LABEL_TITLE = 20, 25
TABLE_LABEL = "表格内容"
NESTED_KEYS = ("yaodians", "items", "tasks", "entries")
# ---------------------------------------------------------------------------

_STRINGS = ("task_id", "label", "grp", "type", "num", "title", "next_num", "evidence", "yaodian_name", "sub_item", "sub_name", "point")
SCHEMA = t.StructType([t.StructField(c, t.StringType()) for c in _STRINGS] + [t.StructField(c, t.IntegerType()) for c in ("start_page", "end_page")] + [t.StructField("ord", t.LongType()), t.StructField("pages", t.ArrayType(t.IntegerType())), t.StructField("meta", t.MapType(t.StringType(), t.StringType()))])


def _whole(df: DataFrame) -> DataFrame:
    """All task columns in the fixed order, missing ones null."""
    have = {c: F.col(c) for c in df.columns}
    return df.select([have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMA.fields])


def _meta(**columns) -> F.Column:
    """String map of the columns that are not null."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in columns.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def from_toc(toc: DataFrame, partition: list[str] | None = None) -> DataFrame:
    """Tasks of a table of contents (ord, num, title, start_page [, partition columns]).

    An entry ends on the page where the next one starts; the last one runs on.
    """
    following = Window.partitionBy(*(partition or [])).orderBy("ord")
    clean = toc.withColumn("num", F.col("num").cast("string")).withColumn("title", T.trim_brackets("title"))
    ranged = clean.withColumn("end_page", F.coalesce(F.lead("start_page").over(following), F.col("start_page") + LAST_PAGES)).withColumn("next_num", F.lead("num").over(following))
    named = ranged.withColumn("task_id", F.concat("num", F.lit("_"), F.left("title", F.lit(ID_TITLE)))).withColumn("label", F.concat(F.lit("第"), "num", F.lit("条 ["), F.left("title", F.lit(LABEL_TITLE)), F.lit("]")))
    meta = _meta(type=F.lit("interp"), num=F.col("num"), title=F.col("title"), start_page=F.col("start_page"), end_page=F.col("end_page"), next_num=F.col("next_num"))
    out = _whole(named.withColumn("type", F.lit("interp")).withColumn("grp", F.lit("")).withColumn("meta", meta).select("*"))
    return out


def toc_rows(json_rows: DataFrame, column: str = "json") -> DataFrame:
    """(ord, num, title, start_page) from positional JSON arrays [num, title, page]."""
    items = json_rows.select(F.posexplode(F.from_json(column, "array<array<string>>")).alias("ord", "x"))
    return items.select(F.col("ord").cast("long"), F.col("x")[0].alias("num"), F.col("x")[1].alias("title"), F.col("x")[2].cast("int").alias("start_page"))


def _inline(items: DataFrame, kind: str) -> DataFrame:
    """(ord, item string map, pages) to tasks; an item's own ``type`` wins."""
    item = lambda k: F.element_at("item", k)
    number = F.col("ord").cast("string")
    task_id = item("id") if kind == "custom" else F.coalesce(item("id"), number)
    label = F.coalesce(item("label"), task_id if kind == "custom" else F.lit(TABLE_LABEL))
    return _whole(items.select("ord", "pages", task_id.alias("task_id"), label.alias("label"), F.lit("").alias("grp"), F.coalesce(item("type"), F.lit(kind)).alias("type"), item("evidence").alias("evidence"), item("point").alias("point"), _merged(kind).alias("meta")))


def _merged(kind: str) -> F.Column:
    """The item's map with the type added unless it has one."""
    return F.when(F.map_contains_key("item", "type"), F.col("item")).otherwise(F.map_concat(F.create_map(F.lit("type"), F.lit(kind)), "item"))


_ITEMS = "ord long, item map<string,string>, pages array<int>"


def item_rows(spark: SparkSession, items: list[dict]) -> DataFrame:
    """Rows of an inline list; values are kept as strings, ``pages`` also as numbers."""
    plain = lambda v: v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    return spark.createDataFrame([(i, {k: plain(v) for k, v in x.items() if v is not None}, [int(p) for p in x.get("pages") or []]) for i, x in enumerate(items)], _ITEMS)


def from_list(items: DataFrame) -> DataFrame:
    """``id`` is needed, the label defaults to it."""
    return _inline(items, "custom")


def from_table(items: DataFrame) -> DataFrame:
    """``id`` defaults to the running number, the label to a fixed text."""
    return _inline(items, "table")


def from_strings(rows: DataFrame, column: str = "value") -> DataFrame:
    """(ord, value): the string is id, label and text."""
    raw = F.col(column)
    return _whole(rows.select("ord", raw.alias("task_id"), raw.alias("label"), F.lit("").alias("grp"), F.lit("json_list").alias("type"), F.create_map(F.lit("type"), F.lit("json_list"), F.lit("raw"), raw).alias("meta")))


def from_dicts(items: DataFrame) -> DataFrame:
    """(ord, item): id is the first filled of task_id, id, label, evidence with point, num, position."""
    item = lambda k: F.element_at("item", k)
    filled = lambda k: F.nullif(item(k), F.lit(""))
    pair = F.when(filled("evidence").isNotNull() & filled("point").isNotNull(), F.concat(item("evidence"), F.lit("｜"), item("point")))
    task_id = F.coalesce(filled("task_id"), filled("id"), filled("label"), pair, item("num"), F.col("ord").cast("string"))
    own = [k for k in ("num", "title", "evidence", "yaodian_name", "sub_item", "sub_name", "point")]
    return _whole(items.select("ord", "pages", task_id.alias("task_id"), F.coalesce(filled("label"), task_id).alias("label"), F.lit("").alias("grp"), F.coalesce(item("type"), F.lit("json_dict")).alias("type"), *[item(k).alias(k) for k in own], _merged("json_dict").alias("meta")))


NESTED = "array<struct<evidence:string,yaodian_name:string,name:string,sub_items:array<string>>>"


def nested_rows(json_rows: DataFrame, column: str = "json") -> DataFrame:
    """(ord, evidence, name, sub_item) of a JSON object; the first key that is there decides, even if empty."""
    schema = "struct<" + ",".join(f"{k}:{NESTED}" for k in NESTED_KEYS) + ">"
    parsed = json_rows.select(F.from_json(column, schema).alias("j")).select(F.coalesce(*[F.col(f"j.{k}") for k in NESTED_KEYS]).alias("items"))
    items = parsed.select(F.posexplode("items").alias("i", "x")).select("i", F.coalesce("x.evidence", F.lit("")).alias("evidence"), F.coalesce("x.yaodian_name", "x.name", F.lit("")).alias("name"), F.posexplode_outer("x.sub_items").alias("j", "sub_item"))
    return items.select((F.col("i") * F.lit(1_000_000).cast("long") + F.coalesce("j", F.lit(0))).alias("ord"), "evidence", "name", "sub_item")


def from_nested(rows: DataFrame) -> DataFrame:
    """One task for each sub-item, or one for an item without any; the group is the evidence."""
    sub, has = F.col("sub_item"), F.col("sub_item").isNotNull()
    sub_name = F.when(has, T.strip_enumeration("sub_item"))
    kind = F.when(has, "evidence_sub").otherwise("evidence")
    task_id = F.concat_ws("|", "evidence", "name", "sub_item")
    label = F.when(has, F.concat("name", F.lit(" -> "), sub)).otherwise(F.col("name"))
    meta = _meta(type=kind, evidence=F.col("evidence"), yaodian_name=F.col("name"), sub_item=sub, sub_name=sub_name)
    return _whole(rows.select("ord", task_id.alias("task_id"), label.alias("label"), F.col("evidence").alias("grp"), kind.alias("type"), "evidence", F.col("name").alias("yaodian_name"), "sub_item", sub_name.alias("sub_name"), meta.alias("meta")))


def unite(*tasks: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tasks)


def colliding_ids(tasks: DataFrame) -> DataFrame:
    """Ids that several tasks share (they would share their progress)."""
    return tasks.groupBy("task_id").agg(F.count("*").alias("n")).where("n > 1")


def read_tasks(spark: SparkSession, data_source: str, data_path: str = "", task_list: list[dict] | None = None) -> DataFrame:
    """Tasks of a configuration (one file or one inline list gives many rows)."""
    if data_source == "list":
        return from_list(item_rows(spark, task_list or []))
    if data_source == "table":
        return from_table(item_rows(spark, task_list or []))
    whole = spark.read.text(data_path, wholetext=True).select(F.col("value").alias("json"))
    if data_source == "toc":
        return from_toc(toc_rows(whole))
    shape = whole.select(F.substring(F.ltrim("json"), 1, 1).alias("c"), F.from_json("json", "array<string>").alias("a")).first()
    if shape["c"] == "{":
        return from_nested(nested_rows(whole))
    raw = whole.select(F.posexplode(F.from_json("json", "array<string>")).alias("ord", "value")).withColumn("ord", F.col("ord").cast("long"))
    objects = raw.where(F.startswith("value", F.lit("{")))
    dicts = objects.select("ord", F.from_json("value", "map<string,string>").alias("item"), F.coalesce(F.from_json(F.get_json_object("value", "$.pages"), "array<int>"), F.array().cast("array<int>")).alias("pages"))
    return unite(from_dicts(dicts), from_strings(raw.where(~F.startswith("value", F.lit("{")))))
