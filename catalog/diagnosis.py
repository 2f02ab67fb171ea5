"""Screening, routing and normalising."""

from pyspark.sql import functions as F

from catalog import sqltext as s
from catalog.registry import query, table
from catalog.views import LOG_SQL, TASKS_SQL, log, tasks
from weakspot import fixed_values as fixed
from weakspot.functions import tags as tg
from weakspot.functions.text import first, has_outer_fence, requests_wrapper
from weakspot.operators import diagnose as dg
from weakspot.operators import rules as ru
from weakspot.plans.diagnose import diagnose


@query(f"WITH {TASKS_SQL} SELECT task_id, {s.TEXT} AS text FROM tasks")
def screening_text(spark, sf):
    text = dg.screening_text(F.col("content"), F.col("completion"), F.col("test_code"))
    return tasks(spark, sf).select("task_id", text.alias("text"))


@query(f"WITH {s.SCREEN} SELECT task_id, rule_id, rule_fault, rule_tag, rule_severity FROM routed")
def first_rule_hit(spark, sf):
    return dg.screened(tasks(spark, sf)).select(
        "task_id", "rule.rule_id", F.col("rule.fault_type").alias("rule_fault"),
        F.col("rule.sub_tag").alias("rule_tag"), F.col("rule.severity").alias("rule_severity"),
    )


# what a harness may have printed after the text of every fourth document
_PRINTED = ["SyntaxError: invalid syntax", "KeyError: 3", "Time limit exceeded", "AssertionError: wrong"]
_PRINTED_SQL = " ".join(f"WHEN {4 * n} THEN {s.lit(text)}" for n, text in enumerate(_PRINTED))


@query(f"""
SELECT l.quality, {s.first_rule("d.whole")} AS rule_id, count(*) AS texts
FROM (SELECT doc_id, text || chr(10) || CASE doc_id % 16 {_PRINTED_SQL} ELSE '' END AS whole FROM documents) d
LEFT JOIN labels l USING (doc_id) GROUP BY ALL""")
def document_rule_hits(spark, sf):
    """Whole documents, some with what a harness printed, through the screen, by label."""
    printed = F.coalesce(F.create_map(*[F.lit(x) for n, text in enumerate(_PRINTED) for x in (4 * n, text)])[(F.col("doc_id") % 16).cast("int")], F.lit(""))
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    whole = docs.select("quality", F.concat_ws("\n", "text", printed).alias("whole"))
    return ru.with_first_hit(whole, "whole").groupBy("quality", "rule.rule_id").agg(F.count(F.lit(1)).alias("texts"))


_ALL_RULES = "[" + ", ".join(
    f"CASE WHEN {s.hit('text', r[1], 'im')} THEN {s.lit(r[0])} END" for r in fixed.RULES
) + "]"


@query(f"""WITH {TASKS_SQL},
listed AS (SELECT task_id, list_filter({_ALL_RULES}, lambda r: r IS NOT NULL) AS hits
           FROM (SELECT task_id, {s.TEXT} AS text FROM tasks))
SELECT task_id, unnest(hits) AS rule_id FROM listed""")
def every_rule_hit(spark, sf):
    text = dg.screening_text(F.col("content"), F.col("completion"), F.col("test_code"))
    texts = tasks(spark, sf).select("task_id", text.alias("text"))
    return ru.hits(texts, "text").select("task_id", "rule_id")


CUSTOM = [
    {"name": " C_NOOUT ", "pattern": r"printed\s+no", "fault_type": "comprehension", "sub_tag": "silent", "severity": "low"},
    {"name": "C_SUB", "pattern": r"subtle", "fault_type": "surface", "sub_tag": "subtlety", "severity": "medium"},
    {"name": "C_OFF", "pattern": r"return", "fault_type": "surface", "sub_tag": "unused", "severity": "high"},
]
_COMPOSED = ["R010", "C_SUB", *[r[0] for r in fixed.RULES if r[0] not in ("R010", "R008", "R012")], "C_NOOUT"]
_BY_ID = {r[0]: r for r in fixed.RULES} | {
    c["name"].strip(): (c["name"].strip(), c["pattern"], c["fault_type"], c["sub_tag"], c["severity"]) for c in CUSTOM
}
_SEVERITIES = {"syntax_error": "low", "R009": "low", "compilation_error": "high", "subtlety": "low", "C_SUB": "high"}


@query(f"""WITH {TASKS_SQL},
hit AS (SELECT task_id, {s.first_rule('text', [_BY_ID[i] for i in _COMPOSED])} AS rule_id
        FROM (SELECT task_id, {s.TEXT} AS text FROM tasks))
SELECT rule_id, CAST(list_position({list(_COMPOSED)}, rule_id) AS INTEGER) AS priority,
  CASE rule_id WHEN 'R001' THEN 'low' WHEN 'R009' THEN 'low' WHEN 'C_SUB' THEN 'high'
    ELSE {s.case_map('rule_id', {i: r[4] for i, r in _BY_ID.items()}, 'NULL')} END AS severity,
  count(*) AS tasks
FROM hit GROUP BY ALL""")
def composed_rule_hits(spark, sf):
    """Defaults with two disabled, custom rules, severity overrides and an explicit order."""
    rules = ru.compose_rules(
        CUSTOM, disabled=["R008", "R012", "C_OFF"], severities=_SEVERITIES, order=["R010", "C_SUB"]
    )
    text = dg.screening_text(F.col("content"), F.col("completion"), F.col("test_code"))
    hit = ru.with_first_hit(tasks(spark, sf).select(text.alias("text")), "text", rules)
    return hit.groupBy("rule.rule_id", "rule.priority", "rule.severity").agg(F.count(F.lit(1)).alias("tasks"))


@query(f"WITH {s.SCREEN} SELECT route, rule_id, count(*) AS tasks FROM routed GROUP BY ALL")
def rule_routing(spark, sf):
    routed = dg.screened(tasks(spark, sf)).select("route", "rule.rule_id")
    return routed.groupBy("route", "rule_id").agg(F.count(F.lit(1)).alias("tasks"))


def _default_row(name, route, values):
    """Register the default diagnosis of one branch."""
    sql = f"""WITH {s.SCREEN} SELECT task_id, {values['fault_type']} AS fault_type, {values['tag']} AS tag,
      {values['severity']} AS severity, {values['description']} AS description,
      {values['approach']} AS correct_approach, completion AS wrong_line, test_code AS failed_test,
      {values['label']} AS rule_label, {values['confidence']} AS confidence, '{values['source']}' AS source,
      '{values['version']}' AS version
    FROM routed WHERE route = '{route}'"""

    @query(sql, name=name)
    def branch(spark, sf):
        routed = dg.screened(tasks(spark, sf)).filter(F.col("route") == route)
        key = "fallback_mode" if route == dg.DEEP else "rule_id"
        return dg.default_diagnosis(routed).select(
            "task_id", "fault_type", F.col("sub_tags")[0].alias("tag"), "severity", "description",
            "evidence.correct_approach", "evidence.wrong_line", "evidence.failed_test",
            F.try_element_at("enriched_labels", F.lit(key)).alias("rule_label"), "confidence",
            F.col("diagnosis_source").alias("source"), F.col("prompt_version").alias("version"),
        )


_default_row("rule_only_diagnosis", dg.RULE_ONLY, {
    "fault_type": "rule_fault", "tag": "rule_tag", "severity": "rule_severity",
    "description": "'Matched diagnosis rule ' || rule_id || '.'",
    "approach": "'Investigate the issue classified by ' || rule_tag || '.'",
    "label": "CAST(NULL AS VARCHAR)", "confidence": "CAST(0.6 AS DOUBLE)", "source": "rule_only", "version": "rule-only-v1"})
_default_row("confirmed_diagnosis", dg.CONFIRM, {
    "fault_type": "rule_fault", "tag": "rule_tag", "severity": "rule_severity",
    "description": "'Model-confirmed diagnosis for ' || rule_id || '.'",
    "approach": "'Review the matched rule context for ' || rule_tag || ' and repair it.'",
    "label": "rule_id", "confidence": "CAST(0.75 AS DOUBLE)", "source": "rule_confirmed_by_model", "version": "confirm-v1"})
_default_row("deep_diagnosis", dg.DEEP, {
    "fault_type": "'implementation'", "tag": "'deep_analysis'", "severity": "'medium'",
    "description": "'Deep model analysis unavailable; fallback placeholder recorded.'",
    "approach": "'Inspect the failing behavior in context and reason from tests.'",
    "label": "'true'", "confidence": "CAST(0.2 AS DOUBLE)", "source": "model_deep", "version": "deep-fallback-v1"})


@query(f"WITH {s.NORMALIZED} SELECT task_id, array_to_string(sub_tags, ',') AS tags FROM diagnoses")
def normalized_tags(spark, sf):
    return log(spark, sf).select("task_id", F.array_join(tg.primary_tags(F.col("sub_tags")), ",").alias("tags"))


@query(rf"""WITH {TASKS_SQL} SELECT task_id,
  regexp_full_match({s.strip('completion')}, {s.lit('(?s)' + fixed.OUTER_FENCE)}) AS fenced FROM tasks""")
def outer_fence(spark, sf):
    return tasks(spark, sf).select("task_id", has_outer_fence(F.col("completion")).alias("fenced"))


@query(f"""WITH {TASKS_SQL} SELECT task_id, contains(lower(content), 'markdown') AND
  (contains(content, '```') OR {s.hit('lower(content)', fixed.WRAPPER_REQUEST)}) AS asks FROM tasks""")
def wrapper_requested(spark, sf):
    return tasks(spark, sf).select("task_id", requests_wrapper(F.col("content")).alias("asks"))


@query(f"""WITH {s.NORMALIZED}, {TASKS_SQL}
SELECT task_id, CASE WHEN d.sub_tags[1] = 'logic_error'
    AND NOT (contains(lower(content), 'markdown') AND (contains(content, '```') OR {s.hit('lower(content)', fixed.WRAPPER_REQUEST)}))
    AND regexp_full_match({s.strip('completion')}, {s.lit('(?s)' + fixed.OUTER_FENCE)})
  THEN 'markdown_formatting' ELSE d.sub_tags[1] END AS tag
FROM diagnoses d JOIN tasks t USING (task_id)""")
def fenced_logic_errors(spark, sf):
    """Primary tag after the override for unrequested fences."""
    rows = log(spark, sf).join(tasks(spark, sf).select("task_id", "content", "completion"), "task_id")
    return dg.normalized(rows).select("task_id", first(F.col("sub_tags")).alias("tag"))


@query(f"WITH {s.NORMALIZED} SELECT task_id, diagnosis_source AS source FROM diagnoses")
def normalized_source(spark, sf):
    return dg.normalized(log(spark, sf)).select("task_id", F.col("diagnosis_source").alias("source"))


@query(f"WITH {s.NORMALIZED} SELECT fault_type, sub_tags[1] AS tag, count(*) AS diagnoses FROM diagnoses GROUP BY ALL")
def fault_of_tag(spark, sf):
    rows = dg.normalized(log(spark, sf)).select("fault_type", first(F.col("sub_tags")).alias("tag"))
    return rows.groupBy("fault_type", "tag").agg(F.count(F.lit(1)).alias("diagnoses"))


_OUTSIDE = f"list_filter(tags, lambda t: t NOT IN {s.among(fixed.CANONICAL_TAGS + fixed.SUCCESS_TAGS)})"


@query(f"""WITH {LOG_SQL}, raw AS (SELECT *, string_split(tags_text, ';') AS tags FROM log)
SELECT task_id, CASE
  WHEN diagnosis_source = 'non_failure' THEN NULL
  WHEN len(tags) = 0 THEN 'Diagnosis must include at least one sub_tag.'
  WHEN tags[1] NOT IN {s.among(fixed.CANONICAL_TAGS)}
    THEN 'Primary sub_tag ''' || tags[1] || ''' is outside the allowed taxonomy.'
  WHEN len({_OUTSIDE}) > 0 THEN 'Sub_tags [' ||
    array_to_string(list_transform({_OUTSIDE}, lambda t: '''' || t || ''''), ', ') || '] are outside the allowed taxonomy.'
  END AS taxonomy_error FROM raw""")
def taxonomy_errors(spark, sf):
    return dg.with_taxonomy_error(log(spark, sf)).select("task_id", "taxonomy_error")


@query(f"""WITH {LOG_SQL}, raw AS (SELECT *, CASE WHEN tags_text = '' THEN [] ELSE string_split(tags_text, ';') END AS sub_tags FROM log)
SELECT task_id, {s.IS_FAILURE} AS is_failure FROM raw""")
def failure_flag(spark, sf):
    """Raw log rows: tags as worded, none where the text is empty."""
    rows = log(spark, sf).withColumn("sub_tags", F.filter("sub_tags", lambda t: t != ""))
    return dg.with_failure_flag(rows).select("task_id", "is_failure")


@query(f"""WITH {TASKS_SQL}, done AS (SELECT event_id FROM events WHERE event_type IN ('click', 'error'))
SELECT task_id FROM tasks WHERE task_id NOT IN (SELECT event_id FROM done)""")
def missing_ids(spark, sf):
    done = table(spark, sf, "events").filter(F.col("event_type").isin("click", "error"))
    return dg.unprocessed(tasks(spark, sf).select("task_id"), done.select(F.col("event_id").alias("task_id")))


@query(f"""WITH {s.SCREEN}, {s.NORMALIZED},
done AS (SELECT d.task_id, d.fault_type, d.sub_tags[1] AS tag, d.diagnosis_source AS source, d.confidence
         FROM diagnoses d JOIN events e ON e.event_id = d.task_id WHERE e.event_type = 'error'),
fresh AS (SELECT task_id,
    CASE WHEN route = 'deep' THEN 'implementation'
         ELSE {s.case_map('rule_tag', fixed.FAULT_TYPE_OF_TAG, 'rule_fault')} END AS fault_type,
    CASE WHEN route = 'deep' THEN 'deep_analysis' ELSE rule_tag END AS tag,
    CASE route WHEN 'deep' THEN 'model_deep' WHEN 'confirm' THEN 'rule_confirmed_by_model' ELSE 'rule_only' END AS source,
    CAST(CASE route WHEN 'deep' THEN 0.2 WHEN 'confirm' THEN 0.75 ELSE 0.6 END AS DOUBLE) AS confidence
  FROM routed WHERE task_id NOT IN (SELECT task_id FROM done))
SELECT * FROM done UNION ALL SELECT * FROM fresh""")
def resumed_diagnoses(spark, sf):
    """Earlier log rows, re-normalised, plus the diagnoses of the tasks the log lacks."""
    errors = table(spark, sf, "events").filter("event_type = 'error'").select(F.col("event_id").alias("task_id"))
    done = log(spark, sf).join(errors, "task_id", "left_semi")
    return diagnose(tasks(spark, sf), existing=done).select(
        "task_id", "fault_type", first(F.col("sub_tags")).alias("tag"),
        F.col("diagnosis_source").alias("source"), "confidence",
    )


@query(f"""WITH {s.NORMALIZED}
SELECT task_id,
  array_to_string(list_filter(sub_tags, lambda t: t NOT IN {s.among(fixed.SUCCESS_TAGS)}), ',') AS failing,
  array_to_string(list_filter(sub_tags, lambda t: t IN {s.among(fixed.SUCCESS_TAGS)}), ',') AS succeeding
FROM diagnoses""")
def tag_set_split(spark, sf):
    """Difference and intersection of the tags with the success tags."""
    known = F.array(*map(F.lit, fixed.SUCCESS_TAGS))
    rows = dg.normalized(log(spark, sf))
    return rows.select(
        "task_id",
        F.array_join(F.array_except("sub_tags", known), ",").alias("failing"),
        F.array_join(F.array_intersect("sub_tags", known), ",").alias("succeeding"),
    )
