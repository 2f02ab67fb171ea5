"""Diagnose stage."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot.operators import diagnose as ops
from weakspot.operators.rules import Rule
from weakspot.schemas import DIAGNOSIS
from weakspot.sources.artifacts import written
from weakspot.sources.gate import diagnosis_violations
from weakspot.sources.tasks import union_all

# batches of routed tasks (columns of the task plus ``rule``) -> batches of diagnosis rows
Analyzer = Callable


def diagnose(
    tasks: DataFrame,
    rules: list[Rule] | None = None,
    existing: DataFrame | None = None,
    confirm: Analyzer | None = None,
    deep: Analyzer | None = None,
    on_events: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Diagnosis of every task: earlier rows, re-normalised, plus the missing ones.

    Without analyzers the whole stage is one narrow projection behind the anti
    join.  ``confirm`` and ``deep`` take and yield pandas batches and only see
    the tasks routed to them; ``on_events`` receives the log of tasks whose answer
    was missing or could not be used.
    """
    todo = tasks if existing is None else ops.unprocessed(tasks, existing)
    new = new_diagnoses(todo, rules, confirm, deep, on_events)
    return new if existing is None else ops.normalized(existing).unionByName(new)


def new_diagnoses(
    tasks: DataFrame, rules: list[Rule] | None = None,
    confirm: Analyzer | None = None, deep: Analyzer | None = None,
    on_events: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    routed = ops.screened(tasks, rules)
    if confirm is None and deep is None:
        return ops.normalized(ops.default_diagnosis(routed))

    # the branches read the screened rows several times: screen once, write, branch
    routed = written(routed, "routed")
    branches = []
    hooked = {ops.CONFIRM: confirm, ops.DEEP: deep}
    plain = [name for name in [ops.RULE_ONLY, ops.CONFIRM, ops.DEEP] if hooked.get(name) is None]
    branches.append(ops.normalized(ops.default_diagnosis(routed.filter(routed["route"].isin(*plain)))))
    for name, analyzer in hooked.items():
        if analyzer is not None:
            rows, events = analyzed(routed.filter(routed["route"] == name), analyzer)
            branches.append(rows)
            if on_events is not None:
                on_events(events)
    return union_all(branches)


def analyzed(part: DataFrame, analyzer: Analyzer) -> tuple[DataFrame, DataFrame]:
    """Exactly one diagnosis per routed task, and a log row for each the analyzer failed on.

    An answer counts if it is the only one for its task (equal rows are one), passes
    the schema gate and, once normalised, the taxonomy.  A task left without such an
    answer gets the default diagnosis.
    """
    fields = DIAGNOSIS.fieldNames()
    answers = written(part.mapInPandas(analyzer, DIAGNOSIS), "answers")
    text = F.to_json(F.struct(*fields))
    single = (
        answers.withColumns({"_text": text, "_wrong": diagnosis_violations()}).groupBy("task_id")
        .agg(F.min_by(F.struct(*fields), "_text").alias("_answer"), F.min_by("_wrong", "_text").alias("_wrong"),
             (F.min("_text") != F.max("_text")).alias("_several"))
    )
    wrong = (
        F.when(F.col("_answer").isNull(), F.lit("not answered")).when(F.col("_several"), F.lit("answered in several ways"))
        .when(F.size("_wrong") > 0, F.concat(F.lit("invalid: "), F.array_join("_wrong", ", ")))
    )
    met = part.join(single, "task_id", "left").withColumn("_problem", wrong)
    told = met.filter("_problem IS NULL").select(*[F.col("_answer")[f].alias(f) for f in fields], "content", "completion")
    checked = written(ops.with_taxonomy_error(ops.normalized(told)), "checked")
    outside = checked.filter("taxonomy_error IS NOT NULL").select("task_id", "taxonomy_error")
    lost = met.join(checked.filter("taxonomy_error IS NULL").select("task_id"), "task_id", "left_anti").join(outside, "task_id", "left")
    events = lost.select(
        F.lit("diagnose").alias("stage"), F.lit("analyzer_answer_rejected").alias("error_type"),
        F.coalesce("_problem", "taxonomy_error").alias("message"), "task_id",
    )
    rows = checked.filter("taxonomy_error IS NULL").select(*fields)
    return rows.unionByName(ops.normalized(ops.default_diagnosis(lost.select(*part.columns)))), events
