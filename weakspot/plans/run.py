"""The whole run: stage planning, artifacts, summary."""

import json
import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.operators import slots as sl
from weakspot.operators.diagnose import normalized, unprocessed
from weakspot.operators.report import from_document
from weakspot.operators.summary import run_summary
from weakspot.plans.aggregate import Report, aggregate
from weakspot.plans.diagnose import new_diagnoses
from weakspot.plans.synthesize import Settings, Synthesis, synthesize
from weakspot.schemas import DIAGNOSIS, EVENT_LOG, SPEC
from weakspot.sources.artifacts import RunStore, scratch, written
from weakspot.sources.tasks import check_unique


class Stages(NamedTuple):
    """Which stages have to run."""

    diagnose: bool
    aggregate: bool
    synthesize: bool


def plan_stages(
    start_from: str, inputs: int, diagnosed: int | None, weaknesses: int | None, specs: int | None,
) -> Stages:
    """Decide from artifact counts (None: the artifact is missing).

    Complete stages are skipped, an incomplete diagnosis is filled up, and a
    stage that runs makes the later ones run again.  ``start_from`` forces the
    stages from there on and forbids the ones before it.
    """
    at = fixed.STAGES.index(start_from)
    diagnose = at == 0 and (diagnosed is None or diagnosed < inputs)
    stale = weaknesses is None or (bool(diagnosed) and weaknesses == 0)
    again = at <= 1 and (diagnose or at == 1 or stale)
    empty = specs is None or (bool(weaknesses) and specs == 0)
    return Stages(diagnose, again, again or at == 2 or empty)


class Hooks(NamedTuple):
    """User functions that a run calls; what they answer badly goes to the run's log.

    ``confirm``, ``deep``: see `plans.diagnose`; ``level``, ``reachable``, ``verifiers``,
    ``rediagnose``, ``collective``, ``causal``: see `plans.aggregate`; ``generate``,
    ``check``: see `plans.synthesize`.
    """

    confirm: Callable | None = None
    deep: Callable | None = None
    level: str = "auto"
    reachable: bool = False
    verifiers: dict | None = None
    rediagnose: Callable | None = None
    collective: Callable | None = None
    causal: Callable | None = None
    generate: Callable | None = None
    check: Callable | None = None


def same_model(analysis_model: str, evaluated_model: str) -> bool:
    """The analysed model analyses itself."""
    return bool(analysis_model) and analysis_model == evaluated_model


def _count(df: DataFrame | None) -> int | None:
    return None if df is None else df.count()


def run(
    spark: SparkSession,
    tasks: DataFrame,
    root: str,
    run_id: str,
    start_from: str = "diagnose",
    settings: Settings = Settings(),
    rules: list | None = None,
    diagnose_stage: Callable[[DataFrame], DataFrame] | None = None,
    aggregate_stage: Callable[[DataFrame], Report] | None = None,
    synthesize_stage: Callable[[Report, DataFrame, DataFrame | None], Synthesis] | None = None,
    analysis_model: str = "",
    evaluated_model: str = "",
    input_files: tuple = (),
    hooks: Hooks = Hooks(),
    prompt_versions: dict[str, str] | None = None,
) -> DataFrame:
    """Run the missing stages and return the run's metadata row.

    ``hooks`` are called by the stages of this package; a whole stage can be replaced by
    a function of its own.

    Every stage reads the written artifact of the one before it, so a run can
    be taken up again after any of them.  Intermediates of a stage are removed once its
    artifact is written, or the stage has failed.
    """
    started = time.monotonic()
    store = RunStore(spark, root, run_id)

    def log(events: DataFrame) -> None:
        store.write(_events(events), "events", "append")

    check_unique(tasks)
    inputs = tasks.count()
    executed = []
    document = store.read_report()
    stages = plan_stages(
        start_from, inputs, _count(store.read("diagnoses", DIAGNOSIS)),
        None if document is None else document.select(F.size("weaknesses")).first()[0],
        _count(store.read("specs", SPEC)),
    )

    if stages.diagnose:
        done = store.read("diagnoses", DIAGNOSIS)
        todo = tasks if done is None else unprocessed(tasks, done)
        with scratch():
            new = diagnose_stage(todo) if diagnose_stage else new_diagnoses(todo, rules, hooks.confirm, hooks.deep, log)
            store.write(new.select(*DIAGNOSIS.fieldNames()), "diagnoses", "append")
        executed.append("diagnose")
    diagnoses = store.read_or_empty("diagnoses", DIAGNOSIS)

    if stages.aggregate:
        rows = normalized(diagnoses) if stages.diagnose else diagnoses
        with scratch():
            report = aggregate_stage(rows) if aggregate_stage else aggregate(
                rows, hooks.level, hooks.reachable, hooks.verifiers, hooks.rediagnose, hooks.collective, hooks.causal, on_log=log
            )
            store.write_report(report.document())
        executed.append("aggregate")
    document = store.read_report()
    if document is None:
        raise ValueError(f"run {run_id} has no weakness report to start from")
    report = Report(**from_document(document))

    if stages.synthesize:
        prior = store.read("specs", SPEC)
        with scratch():
            if prior is not None:
                prior = written(prior, "prior")  # the artifact is rewritten below
            made = synthesize_stage(report, diagnoses, prior) if synthesize_stage else synthesize(
                report, diagnoses, prior, settings, hooks.generate, hooks.check
            )
            # the specs stand beside the artifact before it is replaced, so that a fault in making them leaves it whole
            specs = written(made.specs, "specs")
            log(made.events)
            store.write(specs, "specs")
        executed.append("synthesize")
    specs = store.read_or_empty("specs", SPEC)
    if stages.synthesize and specs.isEmpty():
        raise ValueError("No specs were synthesized successfully")

    attempted = sl.keyed(sl.top_weaknesses(report.weaknesses, settings.top_n)).select("rank", "key")
    summary = run_summary(
        diagnoses, report.weaknesses, attempted, specs, store.read_or_empty("events", EVENT_LOG), inputs
    )
    metadata = summary.select(
        F.lit(run_id).alias("id"),
        F.current_timestamp().alias("timestamp"),
        F.lit(json.dumps(settings._asdict())).alias("config_snapshot"),
        F.lit(analysis_model or "unknown").alias("analysis_model"),
        F.from_json(F.lit(json.dumps(prompt_versions or {})), "map<string,string>").alias("prompt_versions"),
        F.array(*map(F.lit, input_files)).cast("array<string>").alias("input_files"),
        F.lit(inputs).cast("bigint").alias("input_count"),
        F.array(*map(F.lit, executed)).cast("array<string>").alias("stages_executed"),
        F.lit(same_model(analysis_model, evaluated_model)).alias("self_analysis_warning"),
        F.struct("*", F.lit(time.monotonic() - started).alias("elapsed_seconds")).alias("summary"),
    )
    store.write(metadata, "run_metadata")
    return spark.read.parquet(store.path("run_metadata"))


def _events(events: DataFrame) -> DataFrame:
    """Events in the shape of the log, missing columns null; an event about one task has it in its cluster."""
    if "task_id" in events.columns and "cluster" not in events.columns:
        about = F.struct(
            F.lit(None).cast("string").alias("fault_type"), F.lit(None).cast("array<string>").alias("sub_tags"),
            F.array("task_id").alias("task_ids"),
        )
        events = events.withColumn("cluster", about)
    columns = [
        (F.col(f.name) if f.name in events.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in EVENT_LOG.fields
    ]
    return events.select(*columns)
