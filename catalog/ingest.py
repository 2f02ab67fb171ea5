"""Scans of logs and their integrity."""

from pyspark.sql import functions as F

from catalog import sqltext as s
from catalog.registry import query, table
from catalog.views import LOG_SQL, NUM, UID, log
from weakspot import fixed_values as fixed
from weakspot.schemas import DIAGNOSIS, SPEC, TASK
from weakspot.sources import gate, jsonl, nested_gate
from weakspot.sources import tasks as tk
from weakspot.streaming import ingest

# ``events`` written out as real-log JSON lines, read by both engines
_PASS = """CASE event_id % 9 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '1.0' WHEN 3 THEN 'true'
  WHEN 4 THEN 'false' WHEN 5 THEN '"0"' WHEN 6 THEN 'null' WHEN 7 THEN '0.0' ELSE '2' END"""
_TEST = f"""CASE event_id % 8 WHEN 0 THEN '{{"code": "assert f_' || {UID} || '(1)", "asset": [1]}}'
  WHEN 1 THEN '"run_' || {UID} || '()"' WHEN 2 THEN '{{"code": {{"b": [' || {NUM} || ',2], "a": "x:y,z"}}}}'
  WHEN 3 THEN '[1, ' || {NUM} || ']' WHEN 4 THEN 'null' WHEN 5 THEN '{{}}' WHEN 6 THEN '0' ELSE '""' END"""
_LABELS = f"""CASE event_id % 5 WHEN 0 THEN '{{"fewshot": 1, "lang": "py' || {UID} || '"}}'
  WHEN 1 THEN '{{"locale": "en", "is_lctx": true, "n": ' || {NUM} || '}}' WHEN 2 THEN '[1]' WHEN 3 THEN 'null' ELSE '{{}}' END"""
REAL_LOG_LINE = f"""'{{"id": ' || CAST(event_id AS STRING) || ', "content": "do ' || event_type || '"'
  || CASE event_id % 4 WHEN 0 THEN ', "canonical_solution": null' WHEN 1 THEN '' ELSE ', "canonical_solution": "s"' END
  || ', "completion": "c' || {NUM} || '", "model": "m' || CAST(user_id % 3 AS STRING) || '", "labels": ' || {_LABELS}
  || ', "pass_at_1": ' || {_PASS} || ', "test": ' || {_TEST} || '}}'"""
LINES_SQL = f"lines AS (SELECT event_id, event_type, {REAL_LOG_LINE} AS raw FROM events)"


def lines(spark, sf):
    """Parsed real-log lines, one per event."""
    raw = table(spark, sf, "events").selectExpr("event_id", "event_type", f"{REAL_LOG_LINE} AS raw")
    return jsonl.good_rows(jsonl.with_problems(raw))


@query(f"""WITH {LINES_SQL} SELECT CAST(raw->>'$.id' AS BIGINT) AS task_id, raw->>'$.content' AS content,
  CASE WHEN NOT json_exists(raw, '$.canonical_solution') THEN ''
       WHEN json_type(raw, '$.canonical_solution') = 'NULL' THEN 'None'
       ELSE raw->>'$.canonical_solution' END AS canonical_solution,
  raw->>'$.completion' AS completion,
  coalesce(CASE WHEN json_type(raw, '$.pass_at_1') = 'VARCHAR' THEN false
    ELSE raw->>'$.pass_at_1' IN ('1', '1.0', 'true') END, false) AS accepted,
  raw->>'$.model' AS model
FROM lines""")
def real_log_tasks(spark, sf):
    return tk.real_log_tasks(lines(spark, sf)).select(
        "task_id", "content", "canonical_solution", "completion", "accepted",
        F.get_json_object("extra", "$.model").alias("model"),
    )


@query(f"""WITH {LINES_SQL}, t AS (SELECT event_id, raw->'$.test' AS test FROM lines)
SELECT event_id AS task_id, CASE json_type(test)
  WHEN 'OBJECT' THEN CASE coalesce(json_type(test, '$.code'), 'NONE') WHEN 'NONE' THEN ''
    WHEN 'VARCHAR' THEN test->>'$.code'
    ELSE '{{"b": [' || (test->>'$.code.b[0]') || ', 2], "a": "x:y,z"}}' END
  WHEN 'VARCHAR' THEN test->>'$'
  WHEN 'ARRAY' THEN '[1, ' || (test->>'$[1]') || ']'
  ELSE '' END AS test_code
FROM t""")
def harness_code(spark, sf):
    return tk.real_log_tasks(lines(spark, sf)).select("task_id", "test_code")


@query(f"""WITH {LINES_SQL}, l AS (
  SELECT event_id, CASE WHEN json_type(raw, '$.labels') = 'OBJECT' THEN list_filter(json_keys(raw, '$.labels'),
    lambda k: k NOT IN {s.among(fixed.HOUSEKEEPING_LABELS)}) ELSE [] END AS keys, raw->'$.labels' AS labels FROM lines)
SELECT event_id AS task_id, array_to_string(list_transform(keys, lambda k: k || '=' || (labels->>k)), ';') AS labels FROM l""")
def pruned_labels(spark, sf):
    listed = F.transform(F.map_entries("labels"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return tk.real_log_tasks(lines(spark, sf)).select("task_id", F.array_join(listed, ";").alias("labels"))


_ZERO = "coalesce(CASE WHEN json_type(raw, '$.pass_at_1') = 'VARCHAR' THEN false ELSE raw->>'$.pass_at_1' IN ('0', '0.0', 'false') END, false)"


@query(f"""WITH {LINES_SQL} SELECT event_type AS file, count(*) AS total_rows,
  count(*) FILTER (WHERE {_ZERO}) AS kept_rows FROM lines GROUP BY ALL""")
def zero_pass_stats(spark, sf):
    """Counts of the filter job, the event type standing for the file."""
    return jsonl.filter_stats(lines(spark, sf).withColumnRenamed("event_type", "file"))


@query("SELECT d.doc_id, d.lang, d.n_chars FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 0")
def failed_rows_by_outcome(spark, sf):
    """The outcome filter over documents: their label is the pass mark."""
    marked = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").withColumn(
        "row", F.try_parse_json(F.to_json(F.struct(F.col("quality").alias("pass_at_1"))))
    )
    return jsonl.failed_rows(marked).select("doc_id", "lang", "n_chars")


_BROKEN = """'{"task_id": ' || CAST(task_id AS STRING) || ', "fault_type": "' || CASE task_id % 7 WHEN 0 THEN 'style' ELSE fault_type END
  || '", "sub_tags": ["' || tags_text || '"], "severity": "' || CASE task_id % 11 WHEN 0 THEN 'fatal' ELSE severity END
  || '", "description": "d", "evidence": {"wrong_line": "w", "correct_approach": "c", "failed_test": "t"}, "enriched_labels": {}, '
  || CASE task_id % 5 WHEN 0 THEN '' ELSE '"confidence": ' || CASE task_id % 6 WHEN 0 THEN '1.5' ELSE '0.5' END || ', ' END
  || CASE task_id % 13 WHEN 0 THEN '"extra_key": 1, ' ELSE '' END
  || '"diagnosis_source": "' || CASE task_id % 17 WHEN 0 THEN 'guess' ELSE diagnosis_source END || '", "prompt_version": "v1"}'"""


@query(f"""WITH {LOG_SQL} SELECT task_id, array_to_string(list_filter([
  CASE WHEN task_id % 13 = 0 THEN 'unknown extra_key' END,
  CASE WHEN task_id % 5 = 0 THEN 'missing confidence' END,
  CASE WHEN task_id % 7 = 0 THEN 'fault_type' END,
  CASE WHEN task_id % 11 = 0 THEN 'severity' END,
  CASE WHEN task_id % 5 = 0 OR task_id % 6 = 0 THEN 'confidence' END,
  CASE WHEN task_id % 17 = 0 THEN 'diagnosis_source' END
], lambda v: v IS NOT NULL), ',') AS violations FROM log""")
def schema_violations(spark, sf):
    """Diagnosis rows as JSON text, some of them broken, through the schema gate."""
    raw = log(spark, sf).withColumn("tags_text", F.array_join("sub_tags", ";")).selectExpr(f"{_BROKEN} AS raw")
    gated = gate.gate(raw, DIAGNOSIS, gate.diagnosis_violations())
    return gated.select("task_id", F.array_join(gate.VIOLATIONS, ",").alias("violations"))


# events as spec answers, broken at several depths
_SPEC_LINE = f"""CASE WHEN event_id % 31 = 0 THEN '{{broken' ELSE '{{"spec_id": "' || event_type || CAST(event_id AS STRING)
  || '", "target_weakness": {{"fault_type": "' || CASE event_id % 7 WHEN 0 THEN 'style' ELSE '{fixed.FAULT_TYPES[0]}' END
  || '", "sub_tags": [' || CASE event_id % 11 WHEN 0 THEN '"a", 1' WHEN 1 THEN '' ELSE '"a"' END || '], "root_cause": '
  || CASE event_id % 13 WHEN 0 THEN 'null' ELSE '"r"' END || ', "capability_cliff": "c"}}, "problem_spec": {{"algorithm_type": "a", "difficulty": "'
  || CASE event_id % 5 WHEN 0 THEN 'easy' ELSE '{fixed.DIFFICULTIES[0]}' END || '", "narrative_theme": "n", '
  || CASE event_id % 17 WHEN 0 THEN '' ELSE '"constraints": {{"n_range": ' || CASE event_id % 3 WHEN 0 THEN '[1]' WHEN 1 THEN '[1, "9"]' ELSE '[1, 9]' END
  || ', "value_range": [0, 5], "time_limit": "1s", "memory_limit": "1m"' || CASE event_id % 19 WHEN 0 THEN ', "more": 1' ELSE '' END || '}}, ' END
  || '"key_trap": "k", "must_cover": [], "must_avoid": []}}, "verification_spec": {{"min_test_cases": ' || CAST(event_id % 4 AS STRING)
  || ', "must_include_edge_cases": [], "brute_force_verifiable": ' || CASE event_id % 23 WHEN 0 THEN '"yes"' ELSE 'true' END
  || ', "brute_force_complexity_limit": "n"}}, "diversity_tags": {{"narrative_theme": "n", "data_structure": "d", "constraint_scale": "s"}}, '
  || '"generation_hints": {{"solution_approach": "s", "common_wrong_approach": "w"' || CASE event_id % 29 WHEN 0 THEN '' ELSE ', "distinguishing_test": "t"' END
  || '}}, "language_constraint": {{"target_languages": ["python"], "language_specific": false}}, "prompt_version": "v1"}}' END"""


@query("""SELECT event_id, CASE WHEN event_id % 31 = 0 THEN 'type $' ELSE array_to_string(list_sort(list_filter([
  CASE WHEN event_id % 7 = 0 THEN 'value target_weakness.fault_type' END,
  CASE WHEN event_id % 11 = 0 THEN 'type target_weakness.sub_tags[1]' END,
  CASE WHEN event_id % 13 = 0 THEN 'type target_weakness.root_cause' END,
  CASE WHEN event_id % 5 = 0 THEN 'value problem_spec.difficulty' END,
  CASE WHEN event_id % 17 = 0 THEN 'missing problem_spec.constraints' WHEN event_id % 3 = 0 THEN 'value problem_spec.constraints.n_range'
    WHEN event_id % 3 = 1 THEN 'type problem_spec.constraints.n_range[1]' END,
  CASE WHEN event_id % 17 <> 0 AND event_id % 19 = 0 THEN 'unknown problem_spec.constraints.more' END,
  CASE WHEN event_id % 4 = 0 THEN 'value verification_spec.min_test_cases' END,
  CASE WHEN event_id % 23 = 0 THEN 'type verification_spec.brute_force_verifiable' END,
  CASE WHEN event_id % 29 = 0 THEN 'missing generation_hints.distinguishing_test' END
], lambda v: v IS NOT NULL)), ',') END AS violations FROM events""")
def nested_violations(spark, sf):
    """Specs as JSON text through the gate at every depth."""
    raw = table(spark, sf, "events").selectExpr("event_id", f"{_SPEC_LINE} AS raw")
    checked = nested_gate.gated(raw, SPEC, nested_gate.SPEC_RULES)
    return checked.select("event_id", F.array_join(nested_gate.VIOLATIONS, ",").alias("violations"))


@query("SELECT d.doc_id, d.lang, l.quality, l.toxic, d.n_chars FROM documents d JOIN labels l USING (doc_id)")
def split_join(spark, sf):
    sides = [table(spark, sf, "documents").drop("text"), table(spark, sf, "labels")]
    return tk.join_results(*sides, key="doc_id").select("doc_id", "lang", "quality", "toxic", "n_chars")


@query("""WITH results AS (
  SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM labels WHERE toxic = 1 UNION ALL SELECT item_id + 900000000 FROM benchmark),
n AS (SELECT doc_id, count(*) AS c FROM results GROUP BY ALL)
SELECT doc_id, 'duplicate_result' AS issue FROM n WHERE c > 1
UNION ALL SELECT doc_id, 'missing_result' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM n)
UNION ALL SELECT doc_id, 'extra_result' FROM n WHERE c = 1 AND doc_id NOT IN (SELECT doc_id FROM documents)""")
def split_issues(spark, sf):
    """Documents without a label, labels twice over and labels of nothing."""
    labels = table(spark, sf, "labels")
    stray = table(spark, sf, "benchmark").select((F.col("item_id") + 900000000).alias("doc_id"))
    results = labels.select("doc_id").union(labels.filter("toxic = 1").select("doc_id")).union(stray)
    return tk.split_issues(table(spark, sf, "documents"), results, key="doc_id")


@query("SELECT user_id AS task_id, count(*) AS copies FROM events GROUP BY user_id HAVING count(*) > 1")
def duplicate_task_ids(spark, sf):
    """Ids that occur more than once (user ids, so that there are some)."""
    return tk.duplicate_ids(table(spark, sf, "events").select(F.col("user_id").alias("task_id")))


# events as task lines: some broken, some without keys, some with the id of the event before
_TASK_LINE = """CASE event_id % 10 WHEN 0 THEN '{broken ' || event_type WHEN 1 THEN '{"task_id": ' || CAST(event_id AS STRING) || '}'
  ELSE '{"task_id": ' || CAST(event_id - CASE event_id % 10 WHEN 3 THEN 1 ELSE 0 END AS STRING) || ', "content": "' || event_type
  || CAST(event_id AS STRING) || '", "canonical_solution": "", "completion": "c", "test_code": "", "labels": {}, "accepted": false, "metrics": "{}", "extra": "{}"}' END"""


# the odd events come later, with the lines of some events of the first batch again
_BATCHES = f"""arrived AS (SELECT event_id % 2 AS batch, event_id, {_TASK_LINE} AS raw FROM events
  UNION ALL SELECT 1, event_id, {_TASK_LINE} FROM events WHERE event_id % 2 = 0 AND event_id % 7 = 0)"""


@query(f"""WITH {_BATCHES}, seen AS (SELECT batch, raw, event_id % 10 AS kind, event_id - CASE WHEN event_id % 10 = 3 THEN 1 ELSE 0 END AS id FROM arrived),
first AS (SELECT id, arg_min(raw, {{'b': batch, 'r': raw}}) AS taken, min(batch) AS since FROM seen WHERE kind > 1 GROUP BY id)
SELECT batch, 'not JSON' AS outcome, raw AS line FROM seen WHERE kind = 0
UNION ALL SELECT batch, 'missing ' || list_aggregate({fixed.TASK_KEYS[1:]}, 'string_agg', ', missing '), raw FROM seen WHERE kind = 1
UNION ALL SELECT since, 'accepted', taken->>'$.content' FROM first
UNION ALL SELECT s.batch, CASE WHEN since < s.batch THEN 'another row with this task_id came earlier' ELSE 'another row has this task_id' END, raw
FROM seen s JOIN first USING (id) WHERE kind > 1 AND raw <> taken""")
def stream_rows(spark, sf):
    """Rows of two batches by what becomes of them, the second knowing the ids of the first."""
    lines = [F.lit("events").alias("file"), F.expr(_TASK_LINE).alias("raw")]
    arrived, known, told = table(spark, sf, "events"), None, []
    again = arrived.filter("event_id % 2 = 0 AND event_id % 7 = 0")
    for number in (0, 1):
        batch = arrived.filter(f"event_id % 2 = {number}")
        rows, bad = ingest.sorted_out((batch.union(again) if number else batch).select(*lines), known)
        known = rows.select("task_id", ingest.content_digest(F.struct(*TASK.fieldNames())).alias("digest"))
        told.append(rows.select(F.lit(number).alias("batch"), F.lit("accepted").alias("outcome"), F.col("content").alias("line")))
        told.append(bad.select(F.lit(number).alias("batch"), F.col("problem").alias("outcome"), F.col("raw").alias("line")))
    return tk.union_all(told).withColumn("batch", F.col("batch").cast("bigint"))


# real-log lines of which some are cut off, no object, or have no or no usable id
_POOR_LINE = f"""CASE event_id % 12 WHEN 0 THEN '{{"id": ' WHEN 1 THEN '[' || CAST(event_id AS STRING) || ']'
  WHEN 2 THEN '{{"content": "x"}}' WHEN 3 THEN '{{"id": null}}' WHEN 4 THEN '{{"id": "seven"}}' WHEN 5 THEN '{{"id": "' || CAST(event_id AS STRING) || '"}}'
  ELSE {REAL_LOG_LINE} END"""


@query("""SELECT event_id, CASE event_id % 12 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'not an object' WHEN 2 THEN 'id is missing'
  ELSE 'id is no whole number' END AS problem FROM events WHERE event_id % 12 < 5""")
def real_log_rejects(spark, sf):
    """Lines of a real log that are set aside, with the reason."""
    raw = table(spark, sf, "events").selectExpr("event_id", f"{_POOR_LINE} AS raw")
    return tk.with_log_problems(jsonl.with_problems(raw)).filter("problem IS NOT NULL").select("event_id", "problem")


_LOG_LINE = """'{"task_id": ' || CASE event_id % 8 WHEN 0 THEN 'true' WHEN 1 THEN CAST(event_id AS STRING) || '.5' WHEN 2 THEN '"' || CAST(event_id AS STRING) || '"'
  WHEN 3 THEN 'null' ELSE CAST(event_id AS STRING) END || CASE event_id % 16 WHEN 15 THEN '' ELSE '}' END"""


@query("""SELECT event_id, CASE event_id % 16 WHEN 15 THEN 'not JSON' ELSE CASE WHEN event_id % 8 < 4 THEN 'task_id is no whole number' END END AS problem
FROM events WHERE event_id % 8 < 4 OR event_id % 16 = 15""")
def resume_log_rejects(spark, sf):
    """Rows of a diagnosis log whose id can't be told."""
    raw = table(spark, sf, "events").selectExpr("event_id", f"{_LOG_LINE} AS raw")
    return jsonl.with_id_problems(jsonl.with_problems(raw)).filter("problem IS NOT NULL").select("event_id", "problem")


@query("""WITH kind AS (SELECT CASE event_id % 10 WHEN 0 THEN 'not' WHEN 1 THEN 'missing' WHEN 3 THEN 'another' ELSE 'accepted' END AS outcome FROM events)
SELECT outcome, count(*) AS n FROM kind GROUP BY ALL""")
def stream_rejects(spark, sf):
    """Lines of a batch by what the ingest does with them."""
    raw = table(spark, sf, "events").select(F.lit("events").alias("file"), F.expr(_TASK_LINE).alias("raw"))
    rows, bad = ingest.sorted_out(raw)
    outcome = F.substring_index("problem", " ", 1).alias("outcome")
    return rows.select(F.lit("accepted").alias("outcome")).unionByName(bad.select(outcome)).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
