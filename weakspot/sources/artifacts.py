"""Stage artifacts: one dataset per stage, partitioned by run."""

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weakspot.schemas import REPORT

ARTIFACTS = ["diagnoses", "weaknesses", "specs", "run_metadata", "events"]


def check_run_id(run_id: str) -> str:
    """A run id names one folder: a single path segment that stays inside the root."""
    if run_id in ("", ".", "..") or re.search(r"[/\\]", run_id):
        raise ValueError(f"run_id must be a single safe path segment, got {run_id!r}")
    return run_id


class RunStore:
    """Reads and writes the artifacts of one run under ``root``."""

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), check_run_id(run_id)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}/run_id={self.run_id}"

    def write(self, df: DataFrame, name: str, mode: str = "overwrite") -> None:
        df.write.mode(mode).parquet(self.path(name))

    def write_part(self, df: DataFrame, name: str, part: str) -> None:
        """Add a named part to an artifact; a part of that name is replaced."""
        df.write.mode("overwrite").parquet(f"{self.path(name)}/part-of-{check_run_id(part)}")

    def read(self, name: str, schema: T.StructType) -> DataFrame | None:
        """The artifact with all its parts, or None when this run has not written it."""
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def read_or_empty(self, name: str, schema: T.StructType) -> DataFrame:
        found = self.read(name, schema)
        return self.spark.createDataFrame([], schema) if found is None else found

    def write_report(self, report: DataFrame) -> None:
        """Keep the one-row report as a single JSON document."""
        as_json = report.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
        as_json.coalesce(1).write.mode("overwrite").text(self.path("weaknesses"))

    def read_report(self) -> DataFrame | None:
        try:
            text = self.spark.read.text(self.path("weaknesses"))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return text.select(F.from_json("value", REPORT).alias("r")).select("r.*")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the one the cluster names.

    Only a session on one machine that names none gets one beside its warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_written"
    return configured.rstrip("/")


_KEPT_FOR: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("tables of the scope", default=None)


@contextmanager
def scratch() -> Iterator[None]:
    """Intermediates written inside go when the block ends, also when it fails.

    What is made from them has to be stored by then.  An inner block removes its own
    tables only.  Outside of any block they stay, as a result that nobody has read yet
    may need them.  What a killed driver leaves lies under ``weakspot`` in the shared folder.
    """
    tables = []
    outer = _KEPT_FOR.set(tables)
    try:
        yield
    finally:
        _KEPT_FOR.reset(outer)
        for spark, path in tables:
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can write."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage, survives lost executors and keeps user callbacks from being
    run a second time.  `scratch` says when it goes.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/weakspot/{label}-{uuid.uuid4().hex}"
    tables = _KEPT_FOR.get()
    if tables is not None:
        tables.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
