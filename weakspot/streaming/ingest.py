"""Incremental diagnosis of arriving task files.

An id is taken once and for ever, with its content.  A ledger keeps a digest of the row
that each id came with, dealt to buckets by a hash of the id; a batch reads the buckets
of its own ids only, so its work doesn't grow with the log.  A later row with equal
content is a repeat and dropped; one with other content is set aside.

All that a batch writes is named by the query and the number of the batch.  A batch that
is run again after a failure leaves out what it wrote before and replaces it, at
whatever step it was lost.
"""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from weakspot import fixed_values as fixed
from weakspot.plans.diagnose import new_diagnoses
from weakspot.schemas import DIAGNOSIS, LONG, STRING, TASK, row
from weakspot.sources import jsonl
from weakspot.sources.artifacts import RunStore
from weakspot.sources.gate import key_violations

QUARANTINE = "quarantine"
LEDGER = "ledger"
ENTRY = "task_id bigint, digest string, bucket int, part string"
ASIDE = row(file=STRING, raw=STRING, problem=STRING, batch=LONG)
BUCKETS = 1024


def task_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of (file, raw) lines of the JSON files appearing under a folder."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"))


def judged(lines: DataFrame) -> DataFrame:
    """Lines with their task ``r`` and ``problem``, null where the line is a whole task."""
    parsed = jsonl.with_problems(lines)
    keys = key_violations(F.col("raw"), fixed.TASK_KEYS)
    typed = parsed.withColumn("r", F.from_json("raw", TASK))
    problem = F.coalesce("problem", F.when(F.size(keys) > 0, F.array_join(keys, ", ")))
    return typed.drop("row").withColumn(
        "problem", F.coalesce(problem, F.when(F.col("r.task_id").isNull(), F.lit("task_id is no whole number")))
    )


def content_digest(task: Column) -> Column:
    """Digest of a typed task: key order and spacing of its line don't count, nor does the order of labels."""
    fields = [task[f].alias(f) for f in TASK.fieldNames() if f != "labels"]
    labels = F.array_sort(F.map_entries(task["labels"])).alias("labels")
    return F.sha2(F.to_json(F.struct(*fields, labels)), 256)


def identified(lines: DataFrame) -> DataFrame:
    """Judged lines; whole tasks with their ``task_id`` and ``digest``."""
    seen = judged(lines)
    return seen.withColumns({"task_id": F.col("r.task_id"), "digest": content_digest(F.col("r"))})


def sorted_out(lines: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Tasks with one row per new id, and the (file, raw, problem) of all rows set aside."""
    return sorted_rows(identified(lines), known)


def sorted_rows(seen: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The same for identified lines; ``known`` (task_id, digest) holds the ids taken before.

    Rows with equal content are one.  Among differing rows of an id the one it was
    taken with counts, in a batch the first in text order; the others are told apart
    as such.  A known id without a digest (adopted from a log) accepts any content.

    Ids and digests grow with the rows, however small their files look: both joins are
    sorted ones, and nothing of them passes the driver.
    """
    good = seen.filter("problem IS NULL")
    first = good.groupBy("task_id").agg(F.min(F.struct("raw", "digest")).alias("first"))
    if known is None:
        taken = first.withColumns({"old": F.lit(False), "kept": F.col("first.digest")})
    else:
        before = known.select("task_id", F.lit(True).alias("old"), F.col("digest").alias("kept"))
        taken = first.join(before.hint("merge"), "task_id", "left").select(
            "task_id", "first", F.coalesce("old", F.lit(False)).alias("old"), F.when(F.col("old"), F.col("kept")).otherwise(F.col("first.digest")).alias("kept"),
        )
    rows = taken.filter(~F.col("old")).select(F.from_json("first.raw", TASK).alias("r")).select("r.*")
    others = good.join(taken.select("task_id", "old", "kept").hint("merge"), "task_id").filter(F.col("digest") != F.col("kept")).withColumn(
        "problem", F.when(F.col("old"), F.lit("another row with this task_id came earlier")).otherwise(F.lit("another row has this task_id"))
    )
    bad = seen.filter("problem IS NOT NULL").select("file", "raw", "problem")
    return rows, bad.unionByName(others.select("file", "raw", "problem"))


class Ledger:
    """Ids taken so far, with digests of their content, in buckets by a hash of the id."""

    def __init__(self, store: RunStore, buckets: int = BUCKETS):
        self.store, self.buckets = store, buckets

    def bucket(self, task_id: str = "task_id") -> Column:
        return F.pmod(F.xxhash64(task_id), F.lit(self.buckets)).cast("int")

    def entries(self, numbers: list[int]) -> DataFrame:
        """Entries of some buckets; no other folder is listed or read."""
        spark, root = self.store.spark, self.store.path(LEDGER)
        none = spark.createDataFrame([], ENTRY)
        if not numbers:
            return none
        try:
            chosen = f"{root}/bucket={{{','.join(map(str, sorted(numbers)))}}}"
            return spark.read.schema(ENTRY).option("basePath", root).parquet(chosen)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return none
            raise

    def before(self, ids: DataFrame, part: str) -> DataFrame:
        """(task_id, digest) of ids taken by others than this part, read from the buckets of ``ids``."""
        touched = [found.bucket for found in ids.select(self.bucket().alias("bucket")).distinct().collect()]  # at most `buckets`
        return self.entries(touched).filter(F.col("part") != part).select("task_id", "digest")

    def add(self, entries: DataFrame, part: str) -> None:
        rows = entries.select("task_id", "digest", self.bucket().alias("bucket"), F.lit(part).alias("part"))
        # one file per bucket: a bucket's rows of a batch meet in one task
        rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "bucket", "part"
        ).parquet(self.store.path(LEDGER))

    def adopt(self) -> None:
        """Take over the ids of a log that was written without a ledger; their content isn't known."""
        log = self.store.read("diagnoses", DIAGNOSIS)
        if log is not None and self.entries(list(range(self.buckets))).isEmpty():
            self.add(log.select("task_id", F.lit(None).cast("string").alias("digest")).distinct(), "adopted")


def diagnose_batch(store: RunStore, rules: list | None = None, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Append the diagnoses of the ids that weren't there yet; set bad and differing rows aside."""
    ledger = Ledger(store, buckets)
    ledger.adopt()

    def run(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        part = f"{query}-{number}"
        seen = identified(batch).persist()  # read by all writes below; lost blocks are worked out again
        try:
            good = seen.filter("problem IS NULL")
            rows, bad = sorted_rows(seen, ledger.before(good, part))
            store.write_part(new_diagnoses(rows, rules), "diagnoses", part)
            store.write_part(bad.withColumn("batch", F.lit(number).cast("long")), QUARANTINE, part)
            ledger.add(rows.select("task_id", content_digest(F.struct(*TASK.fieldNames())).alias("digest")), part)
        finally:
            seen.unpersist()

    return run


def set_aside(store: RunStore) -> DataFrame:
    """Rows set aside so far: file, raw, problem and batch."""
    return store.read_or_empty(QUARANTINE, ASIDE)


def start(
    lines: DataFrame, store: RunStore, checkpoint: str, rules: list | None = None, trigger: dict | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Start the ingest; by default it works off what is there and stops."""
    observed = judged(lines).observe(
        "ingest", F.count(F.lit(1)).alias("processed"), F.count_if(F.col("problem").isNotNull()).alias("errors")
    )
    return (
        observed.select("file", "raw").writeStream.foreachBatch(diagnose_batch(store, rules, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


class ProgressLog(StreamingQueryListener):
    """Running counters per ingest, kept from the queries' observed metrics."""

    def __init__(self) -> None:
        self.processed = 0
        self.errors = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get("ingest")
        if seen is not None:
            self.processed += seen.processed
            self.errors += seen.errors

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
