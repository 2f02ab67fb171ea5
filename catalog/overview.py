"""Run summaries, coverage and cost estimates."""

from pyspark.sql import functions as F

from catalog import sqltext as s
from catalog.aggregation import diagnoses
from catalog.budgets import PAIRS_SQL, pairs
from catalog.planning import USER_WEAKNESS_SQL, user_weaknesses
from catalog.registry import query, table
from catalog.views import TASKS_SQL, tasks
from weakspot import fixed_values as fixed
from weakspot.operators import slots as sl
from weakspot.operators import summary as sm

# event log made from ``events``: stage, kind and message by event
EVENTS = {
    "seq": "event_id",
    "stage": "CASE event_id % 3 WHEN 0 THEN 'aggregate' ELSE 'synthesize' END",
    "weakness": "CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'tag_' || CAST(user_id % 12 AS STRING) END",
    "error_type": "CASE WHEN event_type = 'view' THEN NULL ELSE 'spec_generation_failed' END",
    "event_type": "CASE WHEN event_type = 'view' THEN 'fallback_used' WHEN event_type = 'click' THEN 'note' END",
    "message": "CASE WHEN user_id % 4 = 0 THEN '' ELSE 'reason ' || CAST(user_id % 5 AS STRING) || event_type END",
}
EVENTS_SQL = "run_log AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in EVENTS.items()) + " FROM events)"
_ERROR = "coalesce(event_type, '') <> 'fallback_used'"


def run_log(spark, sf):
    return table(spark, sf, "events").selectExpr(*[f"{e} AS {n}" for n, e in EVENTS.items()])


@query(f"""WITH {s.NORMALIZED}, f AS (SELECT diagnosis_source, {s.IS_FAILURE} AS failing FROM diagnoses)
SELECT count(*) AS diagnosed, count(*) FILTER (WHERE diagnosis_source <> 'model_deep') AS rule_screened,
  count(*) FILTER (WHERE diagnosis_source = 'model_deep') AS model_analyzed,
  count(*) FILTER (WHERE NOT failing) AS non_failures,
  greatest(CAST((SELECT count(*) FROM orders) AS BIGINT) - count(*), 0) AS skipped FROM f""")
def diagnosis_counts(spark, sf):
    """Counts of the log, the orders standing for the inputs."""
    inputs = table(spark, sf, "orders").count()
    return sm.diagnosis_counts(diagnoses(spark, sf), F.lit(inputs).cast("bigint"))


@query(f"""WITH {EVENTS_SQL} SELECT count(*) FILTER (WHERE {_ERROR}) AS errors,
  count(*) FILTER (WHERE {_ERROR} AND stage = 'synthesize') AS synthesize_failures,
  count(*) FILTER (WHERE event_type = 'fallback_used' AND stage = 'synthesize') AS synthesize_fallbacks FROM run_log""")
def event_counts(spark, sf):
    return sm.event_counts(run_log(spark, sf))


@query(f"WITH {EVENTS_SQL} SELECT stage, count(*) AS errors FROM run_log WHERE {_ERROR} GROUP BY stage")
def errors_by_stage(spark, sf):
    return sm.errors_by_stage(run_log(spark, sf))


@query(f"""WITH {EVENTS_SQL} SELECT coalesce(weakness, 'unknown') AS weakness, count(*) AS fallbacks FROM run_log
WHERE stage = 'synthesize' AND event_type = 'fallback_used' GROUP BY ALL""")
def fallbacks_by_weakness(spark, sf):
    return sm.fallbacks_by_weakness(run_log(spark, sf))


@query(f"""WITH {EVENTS_SQL}, e AS (SELECT seq, coalesce(weakness, 'unknown') AS weakness, message FROM run_log WHERE stage = 'synthesize' AND {_ERROR})
SELECT weakness, array_to_string({s.distinct("list_filter(list(message ORDER BY seq), lambda m: m <> '')")}, '|') AS reasons FROM e GROUP BY weakness""")
def failure_reasons(spark, sf):
    return sm.failure_reasons(run_log(spark, sf)).select("weakness", F.array_join("reasons", "|").alias("reasons"))


@query("""SELECT CASE WHEN p_size % 9 = 0 THEN 'unknown' ELSE p_type END AS weakness, count(*) AS specs FROM part GROUP BY ALL""")
def specs_by_weakness(spark, sf):
    return sm.specs_by_weakness(part_specs(spark, sf))


def part_specs(spark, sf):
    tags = F.when(F.col("p_size") % 9 == 0, F.array().cast("array<string>")).otherwise(F.array("p_type"))
    return table(spark, sf, "part").select(F.struct(tags.alias("sub_tags")).alias("target_weakness"))


_COVERED_SQL = f"""{USER_WEAKNESS_SQL},
keyed AS (SELECT *, coalesce(tag, fault_type || '_' || CAST(rank AS VARCHAR)) AS key FROM user_weak),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rank) AS nth FROM keyed) WHERE nth = 1),
attempted AS (SELECT rank, key FROM best ORDER BY rank LIMIT 15),
spec_counts AS (SELECT 'tag_' || CAST(p_size % 15 AS VARCHAR) AS key, count(*) AS specs FROM part GROUP BY ALL)"""


def _covered(spark, sf):
    attempted = sl.keyed(sl.top_weaknesses(user_weaknesses(spark, sf), 15)).select("rank", "key")
    counts = table(spark, sf, "part").groupBy(F.concat(F.lit("tag_"), (F.col("p_size") % 15).cast("string")).alias("weakness")).agg(
        F.count(F.lit(1)).alias("specs"))
    return sm.coverage(attempted, counts)


@query(f"""WITH {_COVERED_SQL} SELECT a.rank, a.key, coalesce(c.specs, 0) AS specs, c.specs IS NOT NULL AS covered
FROM attempted a LEFT JOIN spec_counts c USING (key)""")
def weakness_coverage(spark, sf):
    return _covered(spark, sf)


@query(f"""WITH {_COVERED_SQL} SELECT w.rank, coalesce(w.tag, 'unknown') AS key FROM user_weak w
WHERE coalesce(w.tag, 'unknown') IN (SELECT key FROM attempted) AND coalesce(w.tag, 'unknown') NOT IN (SELECT key FROM spec_counts)""")
def uncovered_weaknesses(spark, sf):
    return sm.uncovered(user_weaknesses(spark, sf), _covered(spark, sf))


_SCREENED = s.any_phrase("lower(completion)", fixed.CHEAP_SCREEN_NAMES)


@query(f"""WITH {TASKS_SQL} SELECT count(*) FILTER (WHERE {_SCREENED}) AS screened, count(*) AS tasks FROM tasks""")
def cheap_screen_count(spark, sf):
    return tasks(spark, sf).agg(
        F.count_if(sm.cheap_screen(F.col("completion"))).alias("screened"), F.count(F.lit(1)).alias("tasks")
    )


_WORDS = " + ".join(s.count_words(c) for c in ["content", "completion", "test_code", "canonical_solution"])


@query(f"""WITH {PAIRS_SQL}, n AS (SELECT count(*) AS n, CAST(sum({_WORDS}) AS BIGINT) AS tokens, count(*) FILTER (WHERE {_SCREENED}) AS screened FROM pairs)
SELECT n AS input_count, screened AS rule_screened, CAST(8 AS INTEGER) AS concurrency,
  n - screened AS diagnose_calls, tokens AS diagnose_input_tokens, (n - screened) * 32 AS diagnose_output_tokens, (n - screened) * 3 AS diagnose_seconds,
  CAST(1 AS BIGINT) AS aggregate_calls, CAST(4 AS BIGINT) AS aggregate_input_tokens, CAST(16 AS BIGINT) AS aggregate_output_tokens, CAST(3 AS BIGINT) AS aggregate_seconds,
  n AS synthesize_calls, tokens AS synthesize_input_tokens, n * 24 AS synthesize_output_tokens, n * 3 AS synthesize_seconds,
  n - screened + 1 + n AS estimated_model_calls, 2 * tokens + 4 AS estimated_input_tokens,
  (n - screened) * 32 + 16 + n * 24 AS estimated_output_tokens,
  greatest(1, CAST(floor(((n - screened) * 3 + 3 + n * 3) / 8) AS BIGINT)) AS estimated_seconds FROM n""")
def cost_estimate(spark, sf):
    return sm.cost_estimate(pairs(spark, sf), concurrency=8)


@query(f"""WITH {TASKS_SQL}, n AS (SELECT count(*) AS n, CAST(sum({_WORDS}) AS BIGINT) AS tokens FROM tasks)
SELECT n AS input_count, CAST(0 AS BIGINT) AS rule_screened, 1 + n AS estimated_model_calls, tokens + 4 AS estimated_input_tokens,
  16 + n * 24 AS estimated_output_tokens, greatest(1, CAST(floor((3 + n * 3) / 5) AS BIGINT)) AS estimated_seconds FROM n""")
def cost_estimate_from_aggregate(spark, sf):
    return sm.cost_estimate(tasks(spark, sf), start_from="aggregate").select(
        "input_count", "rule_screened", "estimated_model_calls", "estimated_input_tokens", "estimated_output_tokens", "estimated_seconds"
    )
