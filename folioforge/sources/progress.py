"""Progress tables: versions in a folder, each written whole before it counts."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "task_id string, status string, error string, elapsed double, updated timestamp"
DONE = ("success", "skipped")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[str]:
    """Finished versions, oldest first."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = sorted(s.getPath().getName() for s in fs.listStatus(p))
    return [f"{path}/{n}" for n in found if n.startswith("v") and _fs(spark, f"{path}/{n}/_SUCCESS")[0].exists(_fs(spark, f"{path}/{n}/_SUCCESS")[1])]


def load(spark: SparkSession, path: str) -> DataFrame:
    """The newest version; none or an unreadable one gives an empty table."""
    found = versions(spark, path) if path else []
    return spark.read.schema(SCHEMA).option("ignoreCorruptFiles", True).parquet(found[-1]) if found else spark.createDataFrame([], SCHEMA)


def save(progress: DataFrame, path: str, keep: int = 2) -> str:
    """Write a new version; older ones go once it is whole."""
    spark = progress.sparkSession
    name = f"{path}/v{time.time_ns():020d}"
    progress.select([f"`{c.split()[0]}`" for c in SCHEMA.split(", ")]).write.parquet(name)
    for old in versions(spark, path)[:-keep]:
        fs, p = _fs(spark, old)
        fs.delete(p, True)
    return name


def from_json(json_rows: DataFrame, column: str = "json") -> DataFrame:
    """Rows of a progress document {task_name, updated, results: {id: {status, error, elapsed}}}."""
    parsed = json_rows.select(F.from_json(column, "struct<task_name:string,updated:string,results:map<string,struct<status:string,error:string,elapsed:double>>>").alias("j"))
    return parsed.select(F.to_timestamp("j.updated").alias("updated"), F.explode("j.results").alias("task_id", "r")).select("task_id", "r.status", "r.error", "r.elapsed", "updated")


def to_json(progress: DataFrame, name: str):
    """One row with the progress document."""
    entry = F.struct("task_id", F.struct("status", "error", "elapsed").alias("r"))
    return progress.agg(F.to_json(F.struct(F.lit(name).alias("task_name"), F.date_format(F.max("updated"), "yyyy-MM-dd HH:mm:ss").alias("updated"), F.map_from_entries(F.collect_list(entry)).alias("results"))).alias("json"))
