"""Tables as DataFrames, with schemas stated and rows of the wrong shape set apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder, by any path that Spark reads."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def json_records(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejected): JSON lines read with a schema; a line of another shape is rejected, never an empty result."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_rejected"}
    raw = spark.read.text(path).select(F.from_json("value", f"{schema}, _rejected string", options).alias("r"), "value").where("trim(value) <> ''")
    return raw.where("r is not null and r._rejected is null").select("r.*").drop("_rejected"), raw.where("r is null or r._rejected is not null").select("value")


def list_shape(response, items: str = "items", total: str = "totalResults"):
    """Status of a raw list response: OK, or UNKNOWN where the items or the total are missing or of the wrong type."""
    kind = F.get_json_object(response, f"$.{items}")
    count = F.get_json_object(response, f"$.{total}")
    return F.when(F.coalesce(kind.startswith("[") & count.rlike(r"^\d+$"), F.lit(False)), "OK").otherwise("UNKNOWN")


def complete(rows: DataFrame, announced: DataFrame, key: str) -> DataFrame:
    """S-10: fetched and announced numbers of rows for each key, and what is missing. announced: (key, total)."""
    got = rows.groupBy(key).agg(F.count("*").alias("fetched"))
    both = announced.join(got, key, "left").withColumn("fetched", F.coalesce("fetched", F.lit(0).cast("long")))
    return both.select(key, "total", "fetched", (F.col("total") - F.col("fetched")).alias("missing"), F.when(F.col("fetched") == F.col("total"), "COMPLETE").otherwise("UNKNOWN").alias("status"))


def preferred(rows: DataFrame, key: str, kind: str, order: list[str]) -> DataFrame:
    """S-14, S-34: for each key the row whose kind comes first in order; kinds that are not in it never."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(kind))
    best = rows.where(place > 0).groupBy(key).agg(F.min_by(F.struct(*rows.columns), place).alias("_r"))
    return best.select("_r.*")


DECISION = "struct<refid: string, kind: string, publication: struct<status: string, inforce: boolean>, parts: int, dates: array<struct<date: string, use: string, status: string, refid: string, scope: string>>>"


def decisions(records: DataFrame, record: str) -> DataFrame:
    """S-25, S-26: raw JSON decisions as (refid, kind, status, in_force, has_body, dates); a record that is no such object, or has no refid, is left out."""
    parsed = records.select(F.from_json(record, DECISION).alias("r")).where("r.refid is not null")
    return parsed.select("r.refid", "r.kind", F.col("r.publication.status").alias("status"), F.col("r.publication.inforce").alias("in_force"), (F.coalesce("r.parts", F.lit(0)) > 0).alias("has_body"), "r.dates")


def control_history(decided: DataFrame) -> DataFrame:
    """S-26: (refid, at, use, by, scope) of what happened to each decision; entries without a date or a use say nothing and are left out."""
    rows = decided.select("refid", F.explode("dates").alias("d"))
    return rows.select("refid", F.try_to_timestamp("d.date").alias("at"), "d.use", F.col("d.refid").alias("by"), "d.scope").where("at is not null and use is not null")
