"""Windows over ordered units: gaps, runs, intervals, depth. Partitions are documents or cases, so no window spans the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gaps(rows: DataFrame, doc: str, order: list[str], number: str) -> DataFrame:
    """W-02: numbers that do not follow the last one: 'gap' or 'inversion' (a restart at 1 is none), with the last number."""
    last = F.lag(number).over(Window.partitionBy(doc).orderBy(*order))
    kind = F.when(F.col(number) > last + 1, "gap").when((F.col(number) < last) & (F.col(number) != 1), "inversion")
    return rows.withColumn("last", last).withColumn("finding", kind).where("finding is not null")


def runs(rows: DataFrame, key: str, number: str) -> DataFrame:
    """W-03: '9–11, 14' for each key, by islands of consecutive distinct numbers."""
    distinct = rows.select(key, number).distinct()
    island = F.col(number) - F.row_number().over(Window.partitionBy(key).orderBy(number))
    parts = distinct.withColumn("_i", island).groupBy(key, "_i").agg(F.min(number).alias("a"), F.max(number).alias("b"))
    said = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat(F.col("a").cast("string"), F.lit("–"), F.col("b").cast("string")))
    return parts.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", said.alias("t")))), lambda x: x["t"]), ", ").alias("runs"))


def first_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """W-04: the first row of each key; a pre-aggregated minimum instead of a sort."""
    rest = [c for c in rows.columns if c not in {key, *order}]
    return rows.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in [*order, *rest]])


def merged_intervals(rows: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """W-05: union of overlapping or touching intervals of each key, with the number of those merged."""
    w = Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("_new", F.when(F.col(start) <= reach, 0).otherwise(1))
    islands = marked.withColumn("_i", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return islands.groupBy(key, "_i").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("merged")).drop("_i")


def running_depth(rows: DataFrame, doc: str, order: list[str], step: Column) -> DataFrame:
    """W-06: sum of +1 and -1 up to each row."""
    w = Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("depth", F.sum(step).over(w))


def open_after_decisive(rows: DataFrame, case: str, when: str, decisive: Column, trial: Column) -> DataFrame:
    """W-08: for each case the last decisive date and whether a trial follows it (any trial, where nothing was decided)."""
    per = rows.groupBy(case).agg(F.max(F.when(decisive, F.col(when))).alias("decided"), F.max(F.when(trial, F.col(when))).alias("tried"))
    return per.select(case, "decided", "tried", F.coalesce(F.col("tried") > F.col("decided"), F.col("tried").isNotNull()).alias("open"))


def confirmed_markers(rows: DataFrame, doc: str, position: str, number: str, known: str) -> DataFrame:
    """W-07: doubtful markers are confirmed by a known neighbour with the number before or after theirs, again until nothing changes.

    Along a document that is: every doubtful marker in a run of steps of one that holds a known marker.
    """
    w = Window.partitionBy(doc).orderBy(position)
    new = F.when(F.col(number) == F.lag(number).over(w) + 1, 0).otherwise(1)
    run = rows.withColumn("_n", new).withColumn("_run", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return run.withColumn("confirmed", F.max(F.col(known)).over(Window.partitionBy(doc, "_run"))).drop("_n", "_run")
