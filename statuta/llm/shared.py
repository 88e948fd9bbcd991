"""Helpers that several operators of this subpackage use: shared scratch tables and word patterns."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = tempfile.mkdtemp(prefix="statuta-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _clear(spark: SparkSession, root: str) -> None:
    """At the end of the driver, as results are lazy and may read their tables until then."""
    with contextlib.suppress(Py4JError, OSError, AttributeError):  # the JVM may have gone before
        _delete(spark, root)


class Scratch:
    """Tables written to the shared folder; each cuts the lineage, so a lost executor costs one stage. What is left goes when the driver ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/statuta-{uuid.uuid4().hex}"
        self.paths: list[str] = []
        self.n = 0

    def write(self, df: DataFrame, hashes: bool = False) -> DataFrame:
        """df as a table of its own; hashes: its columns are mostly hashes, for which building dictionaries is wasted work."""
        if not self.n:
            atexit.register(_clear, self.spark, self.root)
        self.n += 1
        path = f"{self.root}/{self.n}"
        writer = df.write.mode("errorifexists")
        if hashes:
            writer = writer.option("parquet.enable.dictionary", "false")
        writer.parquet(path)
        self.paths.append(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that nothing reads any more."""
        for t in tables:
            self.paths.remove(t._scratch_path)
            _delete(self.spark, t._scratch_path)

    def keep(self, *tables: DataFrame) -> None:
        """Remove all other tables; for the end of an operator whose result reads these alone."""
        stay = {t._scratch_path for t in tables}
        for path in [p for p in self.paths if p not in stay]:
            self.paths.remove(path)
            _delete(self.spark, path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body) -> Column:
    """body(value) with value computed once for a row, also where body uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (on a cluster it is installed or sent with --py-files)."""
    import pathlib

    here = str(pathlib.Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if here not in paths:
        env["PYTHONPATH"] = ":".join([*paths, here])
