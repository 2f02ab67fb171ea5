"""Task rows to diagnosis rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions import tags as tg
from weakspot.functions.budget import staged_budget
from weakspot.functions.text import first, has_outer_fence, let, lookup, pinned, requests_wrapper, strings
from weakspot.operators.rules import Rule, with_first_hit
from weakspot.schemas import DIAGNOSIS

RULE_ONLY, CONFIRM, DEEP = "rule_only", "confirm", "deep"


def screening_text(content: Column, completion: Column, test_code: Column) -> Column:
    """Non-empty parts joined by line ends."""
    return F.concat_ws("\n", *[F.nullif(c, F.lit("")) for c in [content, completion, test_code]])


def route(rule: Column) -> Column:
    """Branch of a task: severe hits are confirmed, mild ones stand, the rest goes deep."""
    return (
        F.when(rule.isNull() | (rule["rule_id"] == fixed.DEEP_ROUTED_RULE), F.lit(DEEP))
        .when(rule["severity"].isin("medium", "high"), F.lit(CONFIRM))
        .otherwise(F.lit(RULE_ONLY))
    )


def screened(tasks: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Tasks with their first rule hit and the branch it selects."""
    text = screening_text(F.col("content"), F.col("completion"), F.col("test_code"))
    hit = with_first_hit(tasks.withColumn("_text", text), "_text", rules)
    return hit.drop("_text").withColumn("route", route(F.col("rule")))


def _evidence(correct_approach: Column) -> Column:
    return F.struct(
        F.col("completion").alias("wrong_line"),
        correct_approach.alias("correct_approach"),
        F.col("test_code").alias("failed_test"),
    )


def _by_route(rule_only: Column, confirm: Column, deep: Column) -> Column:
    return (
        F.when(F.col("route") == RULE_ONLY, rule_only)
        .when(F.col("route") == CONFIRM, confirm)
        .otherwise(deep)
    )


def default_diagnosis(routed: DataFrame) -> DataFrame:
    """Deterministic diagnosis of every branch, as one projection.

    Keeps ``content`` and ``completion`` for the normalisation that follows.
    """
    rule, deep = F.col("rule"), fixed.DEEP_FALLBACK
    worded = lambda form, name: F.format_string(form, rule[name])
    const = lambda key: _by_route(
        F.lit(fixed.RULE_ONLY[key]), F.lit(fixed.CONFIRMED[key]), F.lit(deep[key])
    )
    pairs = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    approach = _by_route(
        worded(fixed.RULE_ONLY["correct_approach"], "sub_tag"),
        worded(fixed.CONFIRMED["correct_approach"], "sub_tag"),
        F.lit(deep["correct_approach"]),
    )
    is_deep = F.col("route") == DEEP
    return routed.select(
        "task_id",
        F.when(is_deep, F.lit(deep["fault_type"])).otherwise(rule["fault_type"]).alias("fault_type"),
        F.array(F.when(is_deep, F.lit(deep["tag"])).otherwise(rule["sub_tag"])).alias("sub_tags"),
        F.when(is_deep, F.lit(deep["severity"])).otherwise(rule["severity"]).alias("severity"),
        _by_route(
            worded(fixed.RULE_ONLY["description"], "rule_id"),
            worded(fixed.CONFIRMED["description"], "rule_id"),
            F.lit(deep["description"]),
        ).alias("description"),
        _evidence(approach).alias("evidence"),
        _by_route(
            F.create_map().cast("map<string,string>"),
            F.create_map(F.lit("rule_id"), rule["rule_id"]),
            pairs(deep["labels"]),
        ).alias("enriched_labels"),
        const("confidence").alias("confidence"),
        const("source").alias("diagnosis_source"),
        const("version").alias("prompt_version"),
        "content",
        "completion",
    )


def normalized(rows: DataFrame) -> DataFrame:
    """Canonical tags, source and fault type.

    With ``content`` and ``completion`` at hand a logic error whose answer is
    one unrequested fence becomes a formatting error; rows without a task
    (read back from a log) skip that.
    """
    tags = tg.primary_tags(F.col("sub_tags"))
    if "completion" in rows.columns:
        unrequested = has_outer_fence(F.col("completion")) & ~requests_wrapper(F.col("content"))
        tags = let(
            tags,
            lambda t: F.when(
                (first(t) == "logic_error") & unrequested, strings(["markdown_formatting"])
            ).otherwise(t),
        )
    df = pinned(rows, "sub_tags", tags)
    df = df.withColumn(
        "diagnosis_source",
        F.when(tg.only_success(F.col("sub_tags")), F.lit("non_failure")).otherwise(F.col("diagnosis_source")),
    )
    known = F.coalesce(lookup(first(F.col("sub_tags")), fixed.FAULT_TYPE_OF_TAG), F.col("fault_type"))
    df = df.withColumn(
        "fault_type",
        F.when(F.col("diagnosis_source") == "non_failure", F.col("fault_type")).otherwise(known),
    )
    return df.select(*DIAGNOSIS.fieldNames())


def unprocessed(tasks: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Tasks without a diagnosis yet; a log row without an id is an error."""
    nameless = F.raise_error(F.lit("Missing task_id in the diagnosis log")).cast("bigint")
    return tasks.join(diagnoses.select(F.coalesce("task_id", nameless).alias("task_id")), "task_id", "left_anti")


def with_taxonomy_error(diagnoses: DataFrame) -> DataFrame:
    return diagnoses.withColumn(
        "taxonomy_error", tg.taxonomy_error(F.col("diagnosis_source"), F.col("sub_tags"))
    )


def with_failure_flag(diagnoses: DataFrame) -> DataFrame:
    return diagnoses.withColumn(
        "is_failure",
        tg.is_failure(
            F.col("diagnosis_source"), F.col("sub_tags"), F.col("enriched_labels"), F.col("evidence")
        ),
    )


def failures(diagnoses: DataFrame) -> DataFrame:
    return with_failure_flag(diagnoses).filter("is_failure").drop("is_failure")


def analyzer_payload(tasks: DataFrame, max_tokens: int) -> DataFrame:
    """Task id and the JSON payload an analyzer receives, cut to its budget."""
    label = lambda name: F.coalesce(F.try_element_at(F.col("labels"), F.lit(name)), F.lit(""))
    wanted = tasks.withColumn("prompt_requests_markdown_wrapper", requests_wrapper(F.col("content")))
    cut = staged_budget(wanted, max_tokens)
    flags = ["completion_truncated", "canonical_solution_truncated", "test_code_truncated"]
    payload = F.struct(
        "task_id", "content", "completion", "canonical_solution", "test_code", "labels", "accepted",
        label("programming_language").alias("programming_language"),
        label("execution_language").alias("execution_language"),
        "prompt_requests_markdown_wrapper",
        F.struct(*flags).alias("truncation_info"),
    )
    return cut.select("task_id", F.to_json(payload).alias("payload"))
