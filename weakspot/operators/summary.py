"""Run summaries and cost estimates."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.tags import is_failure
from weakspot.functions.text import contains_any, first, token_count


def _is_error() -> Column:
    return F.coalesce(F.col("event_type"), F.lit("")) != "fallback_used"


def _is_fallback() -> Column:
    return (F.col("stage") == "synthesize") & (F.coalesce(F.col("event_type"), F.lit("")) == "fallback_used")


def diagnosis_counts(diagnoses: DataFrame, input_count: Column) -> DataFrame:
    """One row of diagnosis counts, taken in one pass."""
    deep = F.col("diagnosis_source") == "model_deep"
    failing = is_failure(
        F.col("diagnosis_source"), F.col("sub_tags"), F.col("enriched_labels"), F.col("evidence")
    )
    counts = diagnoses.agg(
        F.count(F.lit(1)).alias("diagnosed"),
        F.count_if(~deep).alias("rule_screened"),
        F.count_if(deep).alias("model_analyzed"),
        F.count_if(~failing).alias("non_failures"),
    )
    return counts.withColumn(
        "skipped", F.greatest(input_count - F.col("diagnosed"), F.lit(0).cast("bigint"))
    )


def event_counts(events: DataFrame) -> DataFrame:
    """One row: errors in all, errors of the synthesize stage, fallbacks."""
    return events.agg(
        F.count_if(_is_error()).alias("errors"),
        F.count_if(_is_error() & (F.col("stage") == "synthesize")).alias("synthesize_failures"),
        F.count_if(_is_fallback()).alias("synthesize_fallbacks"),
    )


def errors_by_stage(events: DataFrame) -> DataFrame:
    return events.filter(_is_error()).groupBy("stage").agg(F.count(F.lit(1)).alias("errors"))


def fallbacks_by_weakness(events: DataFrame) -> DataFrame:
    return (
        events.filter(_is_fallback())
        .groupBy(F.coalesce("weakness", F.lit("unknown")).alias("weakness"))
        .agg(F.count(F.lit(1)).alias("fallbacks"))
    )


def failure_reasons(events: DataFrame) -> DataFrame:
    """Distinct messages per weakness in first-seen order.

    Messages are made distinct by an aggregate first, so a key gathers its
    different messages, never its events.
    """
    seen = (
        events.filter(_is_error() & (F.col("stage") == "synthesize"))
        .groupBy(
            F.coalesce("weakness", F.lit("unknown")).alias("weakness"),
            F.coalesce("message", F.lit("")).alias("message"),
        )
        .agg(F.min("seq").alias("seq"))
    )
    ordered = F.array_sort(F.collect_list(F.when(F.col("message") != "", F.struct("seq", "message"))))
    return seen.groupBy("weakness").agg(F.transform(ordered, lambda e: e["message"]).alias("reasons"))


def specs_by_weakness(specs: DataFrame) -> DataFrame:
    tag = F.coalesce(first(F.col("target_weakness.sub_tags")), F.lit("unknown"))
    return specs.groupBy(tag.alias("weakness")).agg(F.count(F.lit(1)).alias("specs"))


def coverage(attempted: DataFrame, spec_counts: DataFrame) -> DataFrame:
    """Attempted keys (rank, key) with their number of specs."""
    counts = spec_counts.select(F.col("weakness").alias("key"), "specs")
    joined = attempted.join(counts, "key", "left")
    return joined.withColumn("specs", F.coalesce("specs", F.lit(0).cast("bigint"))).withColumn(
        "covered", F.col("specs") > 0
    )


def uncovered(weaknesses: DataFrame, covered: DataFrame) -> DataFrame:
    """Weaknesses with an attempted key that got no spec, one row each in rank order."""
    tag = F.coalesce(first(F.col("sub_tags")), F.lit("unknown"))
    open_keys = covered.filter("NOT covered").select("key")
    return weaknesses.select("rank", tag.alias("key")).join(open_keys, "key", "left_semi")


def _listed(rows: DataFrame, name: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("rank", "key")))
    return rows.agg(F.transform(ordered, lambda e: e["key"]).alias(name))


def _as_map(rows: DataFrame, value: str, name: str) -> DataFrame:
    return rows.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("weakness", value)))).alias(name)
    )


def run_summary(
    diagnoses: DataFrame, weaknesses: DataFrame, attempted: DataFrame, specs: DataFrame,
    events: DataFrame, input_count: int,
) -> DataFrame:
    """The one-row summary of a run."""
    spec_counts = specs_by_weakness(specs)
    covered = coverage(attempted, spec_counts)
    parts = [
        diagnosis_counts(diagnoses, F.lit(input_count).cast("bigint")),
        event_counts(events),
        weaknesses.agg(F.count(F.lit(1)).alias("weaknesses_found")),
        specs.agg(F.count(F.lit(1)).alias("specs_generated")),
        _as_map(spec_counts, "specs", "specs_by_weakness"),
        _listed(covered, "attempted_weaknesses"),
        _listed(covered.filter("covered"), "covered_weaknesses"),
        _listed(uncovered(weaknesses, covered), "weaknesses_without_specs"),
        _as_map(fallbacks_by_weakness(events), "fallbacks", "synthesize_fallbacks_by_weakness"),
        _as_map(failure_reasons(events), "reasons", "synthesize_failure_reasons_by_weakness"),
    ]
    # every part is a global aggregate, so each has exactly one row
    one = [p.withColumn("_one", F.lit(1)) for p in parts]
    row = reduce(lambda a, b: a.join(b, "_one"), one).drop("_one")
    return row.withColumn(
        "synthesize_status",
        F.when(F.col("weaknesses_found") == 0, F.lit("skipped"))
        .when(F.size("weaknesses_without_specs") == 0, F.lit("success"))
        .otherwise(F.lit("degraded")),
    )


def cheap_screen(completion: Column) -> Column:
    """The completion names one of five common errors."""
    return contains_any(F.lower(completion), fixed.CHEAP_SCREEN_NAMES)


def cost_estimate(tasks: DataFrame, start_from: str = "diagnose", concurrency: int = 5) -> DataFrame:
    """One row of calls, tokens and seconds per stage, from one pass over the tasks."""
    stages = fixed.STAGES[fixed.STAGES.index(start_from):]
    texts = ["content", "completion", "test_code", "canonical_solution"]
    words = sum((token_count(F.col(t)) for t in texts[1:]), token_count(F.col(texts[0])))
    zero = F.lit(0).cast("bigint")
    base = tasks.agg(
        F.count(F.lit(1)).alias("input_count"),
        F.coalesce(F.sum(words), zero).alias("_tokens"),
        F.count_if(cheap_screen(F.col("completion"))).alias("_screened"),
    )
    n, any_task = F.col("input_count"), F.col("input_count") > 0
    screened = F.col("_screened") if "diagnose" in stages else zero
    calls = {
        "diagnose": F.greatest(n - screened, zero),
        "aggregate": F.when(any_task, F.lit(1).cast("bigint")).otherwise(zero),
        "synthesize": n,
    }
    tokens_in = {
        "diagnose": F.col("_tokens"),
        "aggregate": F.when(any_task, F.lit(fixed.AGGREGATE_INPUT_TOKENS).cast("bigint")).otherwise(zero),
        "synthesize": F.col("_tokens"),
    }
    of = lambda table, stage: table[stage] if stage in stages else zero
    df = base.withColumn("rule_screened", screened)
    for stage in fixed.STAGES:
        df = df.withColumn(f"{stage}_calls", of(calls, stage)).withColumns(
            {
                f"{stage}_input_tokens": of(tokens_in, stage),
                f"{stage}_output_tokens": F.col(f"{stage}_calls") * fixed.OUTPUT_TOKENS_PER_CALL[stage],
                f"{stage}_seconds": F.col(f"{stage}_calls") * fixed.SECONDS_PER_CALL,
            }
        )
    total = lambda name: sum((F.col(f"{s}_{name}") for s in fixed.STAGES[1:]), F.col(f"diagnose_{name}"))
    workers = max(concurrency, 1)
    return df.withColumns(
        {
            "concurrency": F.lit(workers),
            "estimated_model_calls": total("calls"),
            "estimated_input_tokens": total("input_tokens"),
            "estimated_output_tokens": total("output_tokens"),
            "estimated_seconds": F.when(
                total("calls") > 0,
                F.greatest(F.lit(1).cast("bigint"), F.floor(total("seconds") / F.lit(workers))),
            ).otherwise(zero),
        }
    ).drop("_tokens", "_screened")
