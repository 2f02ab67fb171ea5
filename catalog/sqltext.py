"""Pieces of SQL the checks share (DuckDB)."""

from catalog.views import LOG_SQL, TASKS_SQL
from weakspot import fixed_values as fixed

WS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def among(items) -> str:
    return "(" + ", ".join(map(lit, items)) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def hit(text: str, pattern: str, flags: str = "") -> str:
    prefix = f"(?{flags})" if flags else ""
    return f"regexp_matches({text}, {lit(prefix + pattern)})"


def all_of(text: str, pattern: str, group: int = 1, flags: str = "") -> str:
    prefix = f"(?{flags})" if flags else ""
    return f"regexp_extract_all({text}, {lit(prefix + pattern)}, {group})"


def any_phrase(text: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({text}, {lit(p)})" for p in phrases) + ")"


def case_map(x: str, table: dict, default: str) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v) if isinstance(v, str) else f'CAST({v} AS DOUBLE)'}" for k, v in table.items())
    return f"CASE {x} {whens} ELSE {default} END"


def distinct(x: str) -> str:
    """Distinct list items in first-seen order."""
    return f"list_filter({x}, lambda dx, di: list_position({x}, dx) = di)"


def words(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '[\s\p{{Z}}\x{{85}}\x{{1c}}-\x{{1f}}]+'), lambda w: w <> '')"


def count_words(x: str) -> str:
    return f"len({words(x)})"


TEXT = "concat_ws(chr(10), nullif(content, ''), nullif(completion, ''), nullif(test_code, ''))"


def first_rule(text: str, rules=None, column: int = 0) -> str:
    """CASE giving a field of the first rule that matches."""
    rules = fixed.RULES if rules is None else rules
    whens = " ".join(f"WHEN {hit(text, r[1], 'im')} THEN {lit(r[column])}" for r in rules)
    return f"CASE {whens} END"


def rule_field(rule_id: str, column: int) -> str:
    return case_map(rule_id, {r[0]: r[column] for r in fixed.RULES}, "NULL")


SCREEN = f"""{TASKS_SQL},
screened AS (
  SELECT *, {first_rule(TEXT)} AS rule_id FROM tasks
),
routed AS (
  SELECT *, {rule_field('rule_id', 2)} AS rule_fault, {rule_field('rule_id', 3)} AS rule_tag,
         {rule_field('rule_id', 4)} AS rule_severity,
         CASE WHEN rule_id IS NULL OR rule_id = 'R010' THEN 'deep'
              WHEN {rule_field('rule_id', 4)} IN ('medium', 'high') THEN 'confirm'
              ELSE 'rule_only' END AS route
  FROM screened
)"""

CLEAN_TAG = "replace(replace(lower(" + strip("t") + "), '-', '_'), ' ', '_')"
CANONICAL_TAG = case_map("t", fixed.DIAGNOSIS_TAG_ALIASES, "t")

# log rows with normalised tags, source and fault type (no task at hand)
NORMALIZED = f"""{LOG_SQL},
cleaned AS (
  SELECT *, list_transform(list_filter(list_transform(string_split(tags_text, ';'), lambda t: {CLEAN_TAG}),
            lambda t: t <> ''), lambda t: {CANONICAL_TAG}) AS known
  FROM log
),
tagged AS (
  SELECT *, CASE
    WHEN len(list_filter(known, lambda t: t NOT IN {among(fixed.SUCCESS_TAGS)})) > 0
      THEN [list_filter(known, lambda t: t NOT IN {among(fixed.SUCCESS_TAGS)})[1]]
    WHEN len(known) > 0 THEN {distinct('known')}
    ELSE ['unknown'] END AS sub_tags
  FROM cleaned
),
normed AS (
  SELECT * REPLACE (
    CASE WHEN len(list_filter(sub_tags, lambda t: t NOT IN {among(fixed.SUCCESS_TAGS)})) = 0
         THEN 'non_failure' ELSE diagnosis_source END AS diagnosis_source)
  FROM tagged
),
diagnoses AS (
  SELECT * REPLACE (
    CASE WHEN diagnosis_source = 'non_failure' THEN fault_type
         ELSE {case_map('sub_tags[1]', fixed.FAULT_TYPE_OF_TAG, 'fault_type')} END AS fault_type)
  FROM normed
)"""


def label(name: str) -> str:
    """Last value of a label of ``labels_text``, names compared without case and outer space."""
    pairs = (
        "list_filter(list_transform(string_split(labels_text, ';'), lambda p: string_split(p, '=')), "
        f"lambda p: len(p) = 2 AND lower({strip('p[1]')}) = {lit(name)})"
    )
    return f"lower({strip(pairs + '[-1][2]')})"


def exact_label(name: str) -> str:
    """Value of a label under exactly this name."""
    return (
        "list_filter(list_transform(string_split(labels_text, ';'), lambda p: string_split(p, '=')), "
        f"lambda p: len(p) = 2 AND p[1] = {lit(name)})[-1][2]"
    )


IS_FAILURE = f"""CASE
  WHEN diagnosis_source = 'non_failure' THEN false
  WHEN len(list_filter(sub_tags, lambda t: lower({strip('t')}) NOT IN {among(fixed.SUCCESS_TAGS)})) > 0 THEN true
  WHEN len(sub_tags) > 0 THEN false
  WHEN coalesce({label('status')} = 'correct_solution', false) THEN false
  WHEN coalesce({label('test_result')} = 'pass', false) THEN false
  WHEN coalesce({label('functional_correctness')} = 'true', false) THEN false
  WHEN upper({strip('wrong_line')}) = 'N/A' AND upper({strip('failed_test')}) = 'N/A' THEN false
  ELSE true END"""

REPORT_TAG_NAMES = case_map(strip("t"), fixed.REPORT_TAG_ALIASES, strip("t"))


def report_tag(x: str) -> str:
    named = case_map(strip(x), fixed.REPORT_TAG_ALIASES, strip(x))
    return f"CASE WHEN {named} IN {among(fixed.CANONICAL_TAGS)} THEN {named} ELSE 'logic_error' END"


# failures of the normalised log with the default verification, clustered twice
CLUSTERED = f"""{NORMALIZED},
failures AS (SELECT * FROM diagnoses WHERE {IS_FAILURE}),
keyed AS (SELECT *, coalesce(sub_tags[1], 'unknown') AS tag FROM failures),
clusters AS (
  SELECT fault_type, tag, count(*) AS frequency, min(task_id) AS min_task_id,
         list(task_id ORDER BY task_id)[1:3] AS sample_task_ids
  FROM keyed GROUP BY ALL
),
final_keyed AS (
  SELECT *, CASE WHEN len(sub_tags) = 0 THEN 'unknown' ELSE {report_tag('sub_tags[1]')} END AS final_tag FROM failures
),
final_clusters AS (
  SELECT fault_type, final_tag AS tag, count(*) AS frequency, min(task_id) AS min_task_id,
         list(task_id ORDER BY task_id)[1:3] AS sample_task_ids
  FROM final_keyed GROUP BY ALL
),
groups AS (
  SELECT fault_type, tag AS raw_tag, {report_tag('tag')} AS tag, min_task_id,
    'Grouped by ' || fault_type || '/' || tag || ' (verification_status=passed; verification_level=self_check)' AS root_cause,
    tag || ' remains unstable under repeated similar tasks.' AS cliff
  FROM clusters
),
told AS (
  SELECT fault_type, tag, arg_max(root_cause, min_task_id) AS root_cause, arg_max(cliff, min_task_id) AS cliff
  FROM groups GROUP BY ALL
),
weaknesses AS (
  SELECT CAST(row_number() OVER (ORDER BY f.fault_type, f.tag) AS INTEGER) AS rank, f.fault_type, f.tag, f.frequency,
    f.sample_task_ids, {case_map('f.fault_type', fixed.TRAINABILITY, 'CAST(0.5 AS DOUBLE)')} AS trainability,
    coalesce(t.root_cause, 'Grouped by ' || f.fault_type || '/' || f.tag
      || ' (verification_status=passed; verification_level=self_check)') AS root_cause,
    coalesce(t.cliff, f.tag || ' remains after canonical clustering.') AS cliff
  FROM final_clusters f LEFT JOIN told t USING (fault_type, tag)
)"""
