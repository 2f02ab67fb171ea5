"""Verification ladder over failure rows."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.schemas import DIAGNOSIS
from weakspot.sources.artifacts import written
from weakspot.sources.gate import diagnosis_violations


def ladder(level: str = "auto", reachable: bool = False) -> list[str]:
    """Levels tried in turn; ``auto`` starts with execution only where it is reachable."""
    start = ("exec_api" if reachable else "cross_model") if level == "auto" else level
    return fixed.VERIFICATION_LADDERS.get(start, fixed.VERIFICATION_LADDERS["self_check"])


def verdict(levels: list[str], verifiers: dict[str, Column] | None = None) -> Column:
    """Struct of the first level that gives an answer, and the answer.

    A verifier is a column that is ``passed``, ``failed`` or null for no answer.
    Without one, execution and cross-model checks give none and the self check passes.
    """
    answers = {"self_check": F.lit("passed"), **(verifiers or {})}
    tried = [
        F.when(answers[name].isNotNull(), F.struct(F.lit(name).alias("level"), answers[name].alias("status")))
        for name in levels
        if name in answers
    ]
    nothing = F.raise_error(F.lit("No verification path produced a result"))
    return F.coalesce(*tried, nothing.cast("struct<level:string,status:string>"))


#: batches of failure rows -> batches with task_id and status (passed, failed or null)
BatchVerifier = Callable
Events = Callable[[DataFrame], None]


def _told(rows: DataFrame, level: str, verifier: Column | BatchVerifier, on_events: Events | None) -> DataFrame:
    """(task_id, level, status): the usable answers of one level about these rows.

    A batch verifier is asked once; its answers are written.  A row that it leaves out or
    gives no status has no answer at this level, which is no fault.  A row answered in
    several ways or with a foreign status has none either, and is logged.
    """
    if isinstance(verifier, Column):
        return rows.select("task_id", F.lit(level).alias("level"), verifier.alias("status")).filter("status IS NOT NULL")
    answers = written(rows.mapInPandas(verifier, "task_id bigint, status string"), "verdicts")
    single = answers.filter("status IS NOT NULL").groupBy("task_id").agg(F.min("status").alias("status"), F.max("status").alias("last"))
    wrong = F.when(F.col("status") != F.col("last"), F.lit("answered in several ways")).when(
        ~F.col("status").isin("passed", "failed"), F.concat(F.lit("no such status: "), F.col("status"))
    )
    met = rows.select("task_id").distinct().join(single.withColumn("wrong", wrong), "task_id")
    if on_events is not None:
        on_events(met.filter("wrong IS NOT NULL").select(
            F.lit("aggregate").alias("stage"), F.lit("verifier_answer_rejected").alias("error_type"),
            F.concat(F.lit(f"{level}: "), F.col("wrong")).alias("message"), "task_id",
        ))
    return met.filter("wrong IS NULL").select("task_id", F.lit(level).alias("level"), "status")


def verified(
    rows: DataFrame, levels: list[str], verifiers: dict[str, Column | BatchVerifier] | None = None, on_events: Events | None = None,
) -> DataFrame:
    """Rows with ``_v``: the first level that gives an answer, and the answer.

    With columns only this is one expression.  A batch verifier sees the rows that
    earlier levels left undecided; verdicts are a narrow table, so the rows with their
    texts are read once per batch level and once for the result.
    """
    answers = {"self_check": F.lit("passed"), **(verifiers or {})}
    if all(isinstance(answer, Column) for answer in answers.values()):
        return rows.withColumn("_v", verdict(levels, verifiers))
    decided = None
    for level in levels:
        if level in answers:
            open_rows = rows if decided is None else rows.join(decided, "task_id", "left_anti")
            told = _told(open_rows, level, answers[level], on_events)
            decided = written(told if decided is None else decided.unionByName(told), "decided")
    nothing = F.raise_error(F.lit("No verification path produced a result")).cast("struct<level:string,status:string>")
    found = decided.distinct().select("task_id", F.struct("level", "status").alias("_v"))
    return rows.join(found, "task_id", "left").withColumn("_v", F.coalesce("_v", nothing))


def batch_rediagnoser(analyzer: Callable, on_events: Events | None = None) -> Callable[[DataFrame], DataFrame]:
    """Diagnose failed rows again by a function over pandas batches of diagnoses.

    Its answers are gated as an analyzer's: one per task, by the schema.  A row without such
    an answer keeps its diagnosis, and the log says why.
    """
    fields = DIAGNOSIS.fieldNames()

    def again(failed: DataFrame) -> DataFrame:
        answers = written(failed.select(*fields).mapInPandas(analyzer, DIAGNOSIS), "rediagnoses")
        text = F.to_json(F.struct(*fields))
        single = answers.withColumns({"_text": text, "_wrong": diagnosis_violations()}).groupBy("task_id").agg(
            F.min_by(F.struct(*fields), "_text").alias("_answer"), F.min_by("_wrong", "_text").alias("_bad"),
            (F.min("_text") != F.max("_text")).alias("_several"),
        )
        met = failed.join(single, "task_id", "left").withColumn(
            "_problem",
            F.when(F.col("_answer").isNull(), F.lit("not answered")).when(F.col("_several"), F.lit("answered in several ways"))
            .when(F.size("_bad") > 0, F.concat(F.lit("invalid: "), F.array_join("_bad", ", "))),
        )
        if on_events is not None:
            on_events(met.filter("_problem IS NOT NULL").select(
                F.lit("aggregate").alias("stage"), F.lit("rediagnosis_rejected").alias("error_type"),
                F.col("_problem").alias("message"), "task_id",
            ))
        taken = F.col("_problem").isNull()
        return met.select(*[F.when(taken, F.col("_answer")[f]).otherwise(F.col(f)).alias(f) if f in fields else F.col(f) for f in failed.columns])

    return again


def _labelled(rows: DataFrame, level: Column, status: Column) -> DataFrame:
    own = F.map_filter(
        F.col("enriched_labels"), lambda k, _: ~k.isin("verification_level", "verification_status")
    )
    added = F.create_map(
        F.lit("verification_level"), level, F.lit("verification_status"), status
    )
    return rows.withColumn("enriched_labels", F.map_concat(own, added))


def repaired(
    failures: DataFrame,
    level: str = "auto",
    reachable: bool = False,
    verifiers: dict[str, Column | BatchVerifier] | None = None,
    rediagnose: Callable[[DataFrame], DataFrame] | None = None,
    on_events: Events | None = None,
) -> DataFrame:
    """Rows with their verification labels; twice failed ones lose confidence.

    A row that fails is diagnosed again once (``rediagnose`` maps the failed
    rows, see `batch_rediagnoser`) and verified again.  A verifier is a column or a
    function over batches; ``on_events`` receives the log of its unusable answers.
    """
    columns = failures.columns
    levels = ladder(level, reachable)
    if any(not isinstance(v, Column) for v in (verifiers or {}).values()):
        failures = written(failures, "failures")  # read by each batch level
    checked = verified(failures, levels, verifiers, on_events)
    failed = F.col("_v.status") == "failed"

    def close(rows):
        labelled = _labelled(
            rows.withColumn(
                "confidence",
                F.when(failed, F.least(F.col("confidence"), F.lit(0.5))).otherwise(F.col("confidence")),
            ),
            F.col("_v.level"),
            F.when(failed, F.lit("unverified")).otherwise(F.lit("passed")),
        )
        return labelled.select(*columns)

    if rediagnose is None:
        # the same row gets the same verdict, so the second look is the first
        return close(checked)
    again = verified(rediagnose(checked.filter(failed).drop("_v")), levels, verifiers, on_events)
    return close(checked.filter(~failed)).unionByName(close(again))
