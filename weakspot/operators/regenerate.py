"""Bounded regeneration of rejected slots."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions import contracts as ct
from weakspot.functions.responses import clean_response, parsed
from weakspot.functions.text import distinct_notes
from weakspot.operators import specs as sp
from weakspot.sources.artifacts import written
from weakspot.sources.tasks import union_all

# pandas batches with slot_key and payload -> batches with slot_key and answer
Generator = Callable
# pandas batches with slot_key and spec -> batches with slot_key, accepted, reason, missing_contracts
Checker = Callable


def retry_hint(reason: Column) -> Column:
    return ct.retry_mode(reason, fixed.FEASIBILITY_RETRY_MODES, fixed.FEASIBILITY_RETRY_DEFAULT)


def diversity_hint(reason: Column) -> Column:
    return ct.retry_mode(reason, fixed.DIVERSITY_RETRY_MODES, fixed.DIVERSITY_RETRY_DEFAULT)


def payloads(view: DataFrame) -> DataFrame:
    """Slot key and the JSON payload a generator receives."""
    weakness = F.struct(
        "fault_type", F.col("key").alias("primary_sub_tag"), "frequency", "sample_task_ids", "canonical_summary"
    )
    languages = F.struct(
        "primary_language", F.array("primary_language").alias("target_languages"),
        (F.col("primary_language") != "unknown").alias("language_specific"),
    )
    payload = F.struct(
        weakness.alias("weakness"), F.col("evidence").alias("original_evidence"),
        languages.alias("language_profile"), "diversity_tags", "difficulty",
        F.col("notes").alias("must_avoid_constraints"), "repair_context",
    )
    return view.select("slot_key", F.to_json(payload).alias("payload"))


def _answered(view: DataFrame, generate: Generator | None) -> DataFrame:
    if generate is None:
        return view.withColumn("answer", sp.default_answer())
    answers = payloads(view).mapInPandas(generate, "slot_key string, answer string")
    typed = answers.select("slot_key", clean_response(parsed(F.col("answer"))).alias("answer"))
    return view.join(typed, "slot_key", "left")


def _checked(specs: DataFrame, check: Checker | None, label: str) -> DataFrame:
    """Outcome of the local checks, then of the external one for specs that pass them, written."""
    local = written(sp.linted(specs), label)
    if check is None:
        return local
    spec = F.to_json(
        F.struct("target_weakness", "problem_spec", "verification_spec", "diversity_tags",
                 "generation_hints", "language_constraint", "prompt_version", "evidence")
    )
    asked = local.filter("accepted AND error IS NULL").select("slot_key", spec.alias("spec"))
    verdicts = asked.mapInPandas(
        check, "slot_key string, accepted boolean, reason string, missing_contracts array<string>"
    )
    # one verdict per spec: accepted only if every answer says so, a spec without one is rejected
    single = verdicts.groupBy("slot_key").agg(
        F.min(F.coalesce("accepted", F.lit(False))).alias("_a"), F.min("reason").alias("_r"),
        F.array_distinct(F.flatten(F.collect_list("missing_contracts"))).alias("_m"),
    )
    joined = local.join(single, "slot_key", "left")
    given = F.col("accepted") & F.col("error").isNull()
    judged = joined.select(
        *[F.col(c) for c in local.columns if c not in ("accepted", "reason", "missing_contracts")],
        F.when(given, F.coalesce("_a", F.lit(False))).otherwise(F.col("accepted")).alias("accepted"),
        F.when(given, F.coalesce("_r", F.lit(fixed.EXTERNAL_CHECK_REASON))).otherwise(F.col("reason")).alias("reason"),
        F.when(given, F.coalesce("_m", F.array().cast("array<string>"))).otherwise(F.col("missing_contracts")).alias("missing_contracts"),
    )
    return written(judged, f"{label}-checked")


def _events(rows: DataFrame, event: Column, error: Column, message: Column) -> DataFrame:
    return rows.select(
        (F.col("rank").cast("bigint") * 2**32 + F.col("slot")).cast("bigint").alias("seq"),
        F.lit("synthesize").alias("stage"), F.col("key").alias("weakness"),
        error.cast("string").alias("error_type"), event.cast("string").alias("event_type"),
        message.alias("message"),
    )


def generated(
    view: DataFrame, generate: Generator | None = None, check: Checker | None = None, attempts: int = 3
) -> tuple[DataFrame, DataFrame]:
    """Accepted specs and log events of the slots in a (written) synthesis view.

    Each round answers all pending slots at once.  Accepted ones leave, rejected
    ones go on with the reason and a retry hint, unusable answers and slots out
    of attempts take the fallback of their tag, and what the fallback cannot
    serve is logged as failed.  Every round is written: a run has few slots, a
    callback answers a slot once per round, and accepting and rejecting read the
    outcome instead of working it out again.
    """
    view = view.withColumn(
        "repair_context",
        F.struct(
            F.lit("initial_generation").alias("mode"), F.lit("").alias("reason"),
            F.array().cast("array<string>").alias("missing_contracts"),
        ),
    )
    columns = view.columns
    hooked = generate is not None or check is not None
    accepted, dropped = [], []
    pending = view
    # the default answer and the local checks do not depend on the retry notes:
    # a second round would repeat the first
    for round_number in range(attempts if hooked else 1):
        if round_number and pending.isEmpty():
            break
        done = _checked(sp.assembled(_answered(pending, generate)), check, f"round-{round_number}")
        fine = F.col("error").isNull() & F.col("accepted")
        accepted.append(done.filter(fine))
        dropped.append(done.filter("error IS NOT NULL").select(*columns, "error"))
        pending = (
            done.filter("error IS NULL AND NOT accepted")
            .withColumn(
                "notes",
                distinct_notes(
                    F.array_append("notes", F.format_string(fixed.FEASIBILITY_NOTE_FORMAT, F.col("reason")))
                ),
            )
            .withColumn(
                "repair_context",
                F.struct(
                    retry_hint(F.col("reason")).alias("mode"), F.col("reason").alias("reason"),
                    F.col("missing_contracts").alias("missing_contracts"),
                ),
            )
            .select(*columns)
        )
    dropped.append(
        pending.withColumn("error", F.format_string(fixed.ERROR_EXHAUSTED_FORMAT, F.col("key")))
        .select(*columns, "error")
    )

    keep = ["rank", "slot", "key", "target_weakness", "problem_spec", "verification_spec",
            "diversity_tags", "generation_hints", "language_constraint", "prompt_version"]
    # the fallback starts from the notes a slot had at first
    lost = union_all(dropped).drop("notes", "repair_context").join(
        view.select("slot_key", "notes"), "slot_key"
    ).withColumnRenamed("error", "_first_error")
    backed = sp.without_extra_syntax_notes(sp.assembled(sp.with_fallback_answer(lost)))
    tried = _checked(backed, check, "fallback")
    saved = F.col("error").isNull() & F.col("accepted")
    nothing = F.lit(None)
    events = _events(
        tried.filter(saved), F.lit("fallback_used"), nothing, F.lit(fixed.FALLBACK_EVENT)
    ).unionByName(
        _events(tried.filter(~saved), nothing, F.lit("spec_generation_failed"), F.col("_first_error"))
    )
    rows = union_all([part.select(*keep) for part in [*accepted, tried.filter(saved)]])
    return rows, events
