"""Contracts by template, default and fallback specs, spec table."""

from pyspark.sql import functions as F

from catalog import sqltext as s
from catalog.aggregation import diagnoses
from catalog.planning import EVIDENCE_SQL, TOP, report
from catalog.registry import query
from catalog.texts import (
    EVIDENCE_TEXT, REFERENCE_SQL, SUMMARY_SQL, TARGET_SQL, dedupe_sql, entry_points_sql, language_sql, names_sql,
)
from catalog.views import SPECS_SQL, specs
from weakspot import fixed_values as fixed
from weakspot.functions import contracts as ct
from weakspot.functions import language as lg
from weakspot.functions import names as nm
from weakspot.functions.text import distinct_notes
from weakspot.operators import slots as sl
from weakspot.operators import specs as sp
from weakspot.plans.synthesize import synthesize

_SOURCE = "array_to_string(string_split(cover_text, ';'), ' ') || ' ' || cause || ' ' || cliff"


def view(spark, sf):
    """Synthesis view over the spec texts: every row stands for a slot."""
    rows = specs(spark, sf).select(
        "seq", "fault_type", "sub_tags", F.col("tag").alias("key"), "difficulty", "cover", "avoid", "trap", "solution_hint",
        "evidence", F.struct(F.lit("theme").alias("narrative_theme"), F.lit("array").alias("data_structure"),
                             F.col("scale").alias("constraint_scale")).alias("diversity_tags"),
        F.array(F.concat(F.lit("avoid duplicates of spec-"), F.col("seq").cast("string"))).alias("notes"),
        F.struct(F.col("cause").alias("refined_root_cause"), F.col("cliff").alias("capability_cliff")).alias("collective_diagnosis"),
    )
    return sp.synthesis_view(rows)


def _augmented_sql():
    name = f"{names_sql(_SOURCE)}[-1]"
    lines = []
    for tag, note in fixed.AUGMENTED_COVER.items():
        line = s.lit(note)
        if "%s" in note:
            before, after = note.split("%s")
            generic = fixed.AUGMENTED_COVER_GENERIC.get(tag, note % fixed.GENERIC_ENTRYPOINT)
            line = f"coalesce({s.lit(before)} || {name} || {s.lit(after)}, {s.lit(generic)})"
        lines.append(f"WHEN {s.lit(tag)} THEN {line}")
    cover = f"CASE tag {' '.join(lines)} END"
    avoid = s.case_map("tag", fixed.AUGMENTED_AVOID, "NULL")
    return cover, avoid


_COVER_NOTE, _AVOID_NOTE = _augmented_sql()


def _with_note(items, note):
    known = f"list_contains(list_transform({items}, lambda i: lower({s.strip('i')})), lower({note}))"
    return f"CASE WHEN {note} IS NULL OR {known} THEN {items} ELSE list_append({items}, {note}) END"


@query(f"""WITH {SPECS_SQL}, n AS (SELECT seq, string_split(cover_text, ';') AS cover, string_split(avoid_text, ';') AS avoid,
  {_COVER_NOTE} AS cover_note, {_AVOID_NOTE} AS avoid_note FROM specs)
SELECT seq, array_to_string({_with_note('cover', 'cover_note')}, '|') AS cover,
  array_to_string({_with_note('avoid', 'avoid_note')}, '|') AS avoid FROM n""")
def augmented_notes(spark, sf):
    rows = specs(spark, sf)
    cover = ct.augment_cover(F.col("sub_tags"), F.col("cover"), F.col("cause"), F.col("cliff"))
    avoid = ct.augment_avoid(F.col("sub_tags"), F.col("avoid"))
    return rows.select("seq", F.array_join(cover, "|").alias("cover"), F.array_join(avoid, "|").alias("avoid"))


_KEPT_AVOID = dedupe_sql(
    "list_filter(list_transform(string_split(avoid_text, ';'), lambda i: " + s.strip("i") + "), lambda i: NOT ("
    + " OR ".join(f"starts_with(lower(i), {s.lit(p)})" for p in fixed.PROCESS_NOTE_PREFIXES) + "))"
)
_KEPT_COVER = dedupe_sql("list_transform(string_split(cover_text, ';'), lambda i: " + s.strip("i") + ")")
_CODE = "'executable ' || " + s.case_map("language", {k: v + " " for k, v in fixed.LANGUAGE_NAME.items()}, "''") + " || 'code'"
_TARGET_KIND, _TARGET_NAME = "split_part(target, ':', 1)", "split_part(target, ':', 2)"


def _by_kind(side):
    whens = []
    for kind, lines in fixed.TARGET_CONTRACT.items():
        before, _, after = lines[side].partition("%s")
        whens.append(f"WHEN {s.lit(kind)} THEN {s.lit(before) + ' || ' + _TARGET_NAME + ' || ' + s.lit(after) if '%s' in lines[side] else s.lit(lines[side])}")
    return f"CASE {_TARGET_KIND} {' '.join(whens)} ELSE {s.lit(fixed.NO_TARGET_CONTRACT[side])} END"


_CONTRACT_COVER = f"""CASE tag
  WHEN 'function_name_mismatch' THEN {_by_kind(0)}
  WHEN 'missing_code_block' THEN 'Require ' || {_CODE} || ' output.|' || CASE WHEN name IS NULL THEN 'Require exactly one callable solution entry point.'
    WHEN language = 'java' THEN 'Require exactly one callable solution method named ' || name || '.'
    ELSE 'Require exactly one callable solution entry point named ' || name || '.' END
  WHEN 'markdown_formatting' THEN 'Require raw executable code output.'
  WHEN 'syntax_error' THEN 'Require syntactically complete ' || {_CODE} || '.' || coalesce('|Require a valid callable definition for ' || name || '.', '')
  WHEN 'logic_error' THEN 'Require the exact output semantics specified by the task.'
  WHEN 'non_executable_code' THEN 'Require runnable code output.'
  ELSE array_to_string({_KEPT_COVER}, '|') END"""
_CONTRACT_AVOID = f"""CASE tag
  WHEN 'function_name_mismatch' THEN {_by_kind(1)}
  WHEN 'missing_code_block' THEN 'Do not return explanation-only or prose-only output.'
  WHEN 'markdown_formatting' THEN 'Do not wrap the final answer in markdown fences, backticks, or fenced code blocks.'
  WHEN 'syntax_error' THEN CASE WHEN language = 'java' THEN {s.lit(fixed.MALFORMED_AVOID_JAVA)}
    WHEN language IN {s.among(fixed.PUNCTUATED_LANGUAGES)} THEN {s.lit(fixed.MALFORMED_AVOID_PUNCTUATED)} ELSE {s.lit(fixed.MALFORMED_AVOID)} END
  WHEN 'logic_error' THEN 'Do not transform the required result into a different structure, type, or semantic form.'
  WHEN 'non_executable_code' THEN 'Do not return non-executable prose, translation, or prompt echo instead of code.'
  ELSE array_to_string({_KEPT_AVOID}, '|') END"""
_LANGUAGE = "CASE WHEN " + language_sql(EVIDENCE_TEXT) + " = 'unknown' THEN 'python' ELSE " + language_sql(EVIDENCE_TEXT) + " END"


@query(f"""WITH {SPECS_SQL}, n AS (SELECT seq, tag, cover_text, avoid_text, {_LANGUAGE} AS language,
  {entry_points_sql("array_to_string(string_split(cover_text, ';'), ' ') || ' ' || trap", False)}[1] AS name, {TARGET_SQL} AS target FROM specs)
SELECT seq, {_CONTRACT_COVER} AS cover, {_CONTRACT_AVOID} AS avoid FROM n""")
def template_contracts(spark, sf):
    """Cover and avoid lists by tag, language, entry point and target."""
    items = F.concat("cover", F.array("trap"))
    rows = view(spark, sf).withColumns(
        {
            "name": F.when(ct.names_entry_point(F.col("sub_tags")), ct.entry_point(items)),
            "target": F.when(
                ct.has_tag(F.col("sub_tags"), "function_name_mismatch"), nm.resolve_target(F.col("evidence"), items)
            ),
        }
    )
    contract = ct.normalized_contract(
        F.col("sub_tags"), F.col("cover"), F.col("avoid"), F.col("name"), F.col("target"),
        F.col("inferred_languages.target_languages")[0],
    )
    return rows.select("seq", contract.alias("c")).select(
        "seq", F.array_join("c.cover", "|").alias("cover"), F.array_join("c.avoid", "|").alias("avoid")
    )


_SPEC_WORDS = "trap || ' ' || array_to_string(string_split(cover_text, ';'), ' ') || ' ' || solution_hint"
_EVIDENCE_WORDS = "wrong_line || ' ' || correct_approach || ' ' || failed_test"


@query(f"""WITH {SPECS_SQL}, n AS (SELECT seq, {names_sql(_SPEC_WORDS)} AS used, {names_sql(_EVIDENCE_WORDS)} AS known FROM specs)
SELECT seq, array_to_string(list_sort(list_filter(used, lambda u: NOT list_contains(known, u)
  AND u NOT IN {s.among(fixed.UNGROUNDED_NAMES_ALLOWED)})), ',') AS names FROM n""")
def ungrounded_names(spark, sf):
    rows = specs(spark, sf)
    used = F.concat_ws(" ", "trap", F.array_join("cover", " "), "solution_hint")
    known = F.concat_ws(" ", "wrong_line", "correct_approach", "failed_test")
    return rows.select("seq", F.array_join(nm.ungrounded_names(used, known), ",").alias("names"))


_DECLARED = "CASE seq % 4 WHEN 0 THEN 'java,python' WHEN 1 THEN 'go' WHEN 2 THEN '' ELSE 'python' END"


@query(f"""WITH {SPECS_SQL}, n AS (SELECT seq, {language_sql(EVIDENCE_TEXT)} AS inferred, {_DECLARED} AS declared FROM specs)
SELECT seq, CASE WHEN inferred = 'unknown' OR list_contains(string_split(declared, ','), inferred) THEN declared ELSE inferred END AS languages,
  CASE WHEN inferred = 'unknown' OR list_contains(string_split(declared, ','), inferred) THEN seq % 2 = 1 ELSE true END AS language_specific FROM n""")
def resolved_languages(spark, sf):
    listed = F.filter(F.split(F.expr(_DECLARED), ","), lambda x: x != "")
    declared = F.struct(listed.alias("target_languages"), (F.col("seq") % 2 == 1).alias("language_specific"))
    out = view(spark, sf).withColumn("l", lg.resolve_languages(declared, F.col("inferred_languages")))
    return out.select("seq", F.array_join("l.target_languages", ",").alias("languages"), "l.language_specific")


_SCALE = {k: v for k, v in fixed.LIMITS_OF_SCALE.items()}


@query(f"""WITH {SPECS_SQL} SELECT seq, {s.case_map('fault_type', fixed.ALGORITHM_OF_FAULT, s.lit(fixed.DEFAULT_ALGORITHM))} AS algorithm_type,
  {s.case_map('scale', {k: str(v[0][1]) for k, v in _SCALE.items()}, "'10000'")} AS n_max,
  {s.case_map('scale', {k: str(v[1][1]) for k, v in _SCALE.items()}, "'1000000'")} AS value_max,
  {s.case_map('scale', {k: v[2] for k, v in _SCALE.items()}, "'1s'")} AS time_limit,
  {s.case_map('scale', {k: v[3] for k, v in _SCALE.items()}, "'256MB'")} AS memory_limit,
  'Reference the original evidence: ' || wrong_line AS key_trap, tag || '|' || correct_approach AS must_cover,
  'verbatim reuse of prior tasks|avoid duplicates of spec-' || CAST(seq AS VARCHAR) AS must_avoid,
  CAST(CASE difficulty WHEN 'medium' THEN 4 ELSE 5 END AS INTEGER) AS min_test_cases, failed_test AS edge_case,
  {_LANGUAGE} AS language, {language_sql(EVIDENCE_TEXT)} <> 'unknown' AS language_specific
FROM specs""")
def default_spec_answers(spark, sf):
    rows = view(spark, sf).withColumn("a", sp.default_answer())
    return rows.select(
        "seq", "a.algorithm_type", F.col("a.constraints.n_range")[1].cast("string").alias("n_max"),
        F.col("a.constraints.value_range")[1].cast("string").alias("value_max"), "a.constraints.time_limit",
        "a.constraints.memory_limit", "a.key_trap", F.array_join("a.must_cover", "|").alias("must_cover"),
        F.array_join("a.must_avoid", "|").alias("must_avoid"), "a.verification_spec.min_test_cases",
        F.col("a.verification_spec.must_include_edge_cases")[0].alias("edge_case"),
        F.col("a.language_constraint.target_languages")[0].alias("language"), "a.language_constraint.language_specific",
    )


_WRONG = f"coalesce({names_sql('wrong_line', False)}[1], 'the wrong callable')"
_AIM = (
    f"coalesce({names_sql('correct_approach', False)}[-1], {names_sql('failed_test', False)}[-1], "
    f"{names_sql('wrong_line', False)}[-1], 'the requested entry point')"
)
_NOUN = s.case_map("language", {k: v + " code" for k, v in fixed.LANGUAGE_NAME.items()}, "'code'")
_CLAUSE = """CASE WHEN aim = 'the requested entry point' THEN 'the requested executable implementation'
  WHEN language = 'java' THEN 'the requested `' || aim || '` method' ELSE 'the requested `' || aim || '` entry point' END"""
_T = fixed.FALLBACK_TEXT
_SYNTAX_AVOID = f"""CASE WHEN language = 'java' THEN 'incomplete code|missing braces|malformed method headers'
  WHEN language IN {s.among(fixed.PUNCTUATED_LANGUAGES)} THEN 'incomplete code|missing required punctuation|malformed code structure'
  ELSE 'incomplete code|missing colons|malformed function headers' END"""


@query(f"""WITH {SPECS_SQL}, b AS (SELECT seq, tag, difficulty, {_WRONG} AS wrong, {_AIM} AS aim, {REFERENCE_SQL} AS ref, {_LANGUAGE} AS language FROM specs),
c AS (SELECT *, {_NOUN} AS noun, {_CLAUSE} AS clause FROM b)
SELECT seq, difficulty, language, CASE tag
    WHEN 'function_name_mismatch' THEN 'The trap reproduces the original wrong callable `' || wrong || '` instead of the exact `' || aim || '` entry point required by the harness.'
    WHEN 'markdown_formatting' THEN 'The trap reproduces the original evidence `' || ref || '` with markdown fences instead of raw executable ' || noun || '.'
    WHEN 'missing_code_block' THEN 'The trap fails when the solver explains the approach instead of returning ' || clause || '.'
    WHEN 'syntax_error' THEN 'The trap reproduces the original incomplete syntax fragment `' || ref || '` instead of executable code that parses cleanly.'
    WHEN 'non_executable_code' THEN {s.lit(_T['non_executable_code']['trap'])} END AS key_trap,
  CASE tag
    WHEN 'function_name_mismatch' THEN 'exact callable entry point ' || aim || '|single exact public function contract'
    WHEN 'markdown_formatting' THEN 'raw executable ' || noun || ' output'
    WHEN 'missing_code_block' THEN CASE WHEN language = 'java' THEN 'executable Java code output with ' ELSE 'executable code output with ' END || clause
    WHEN 'syntax_error' THEN CASE WHEN language = 'java' THEN 'syntactically complete executable Java code that compiles cleanly' ELSE 'syntactically complete executable code' END
    WHEN 'non_executable_code' THEN 'runnable code output with the requested executable implementation present' END AS must_cover,
  CASE tag
    WHEN 'function_name_mismatch' THEN 'alternate public function names|renaming the public entry point to ' || wrong || ' or other helper wrappers'
    WHEN 'markdown_formatting' THEN 'fenced code blocks|wrapping delimiters'
    WHEN 'missing_code_block' THEN 'explanation-only answers|prose-only final responses'
    WHEN 'syntax_error' THEN {_SYNTAX_AVOID}
    WHEN 'non_executable_code' THEN 'explanation-only responses|translation-only output|prompt echo instead of executable code|prose-only final responses' END AS must_avoid,
  CASE tag
    WHEN 'function_name_mismatch' THEN 'Implement the exact ' || aim || ' entry point expected by the harness.'
    WHEN 'markdown_formatting' THEN 'Return raw executable ' || noun || ' only.'
    WHEN 'missing_code_block' THEN 'Return ' || clause || CASE WHEN language = 'java' THEN ' directly as executable Java code.' ELSE ' directly as executable code.' END
    WHEN 'syntax_error' THEN CASE WHEN language = 'java' THEN 'Return syntactically valid executable Java code.' ELSE 'Return syntactically valid executable code.' END
    WHEN 'non_executable_code' THEN {s.lit(_T['non_executable_code']['solution'])} END AS solution_approach,
  CASE tag
    WHEN 'function_name_mismatch' THEN 'Expose ' || wrong || ' instead of ' || aim || '.'
    WHEN 'markdown_formatting' THEN 'Wrap the answer in markdown fences.'
    WHEN 'missing_code_block' THEN 'Explain the intended code without emitting it.'
    WHEN 'syntax_error' THEN 'Repeat the incomplete syntax from `' || ref || '`.'
    WHEN 'non_executable_code' THEN {s.lit(_T['non_executable_code']['wrong'])} END AS common_wrong_approach,
  CASE tag
    WHEN 'function_name_mismatch' THEN 'Call ' || aim || ' directly and reject any alternate public function name.'
    WHEN 'markdown_formatting' THEN 'Reject output if it contains ``` or stray backticks.'
    WHEN 'missing_code_block' THEN 'Check that ' || clause || ' exists as runnable code.'
    WHEN 'syntax_error' THEN CASE WHEN language = 'java' THEN 'Compile the final Java code before execution.' ELSE 'Parse the final code before execution.' END
    WHEN 'non_executable_code' THEN {s.lit(_T['non_executable_code']['test'])} END AS distinguishing_test
FROM c WHERE tag NOT IN ('logic_error', 'state_tracking')""")
def fallback_spec_answers(spark, sf):
    rows = sp.with_fallback_answer(view(spark, sf)).filter("answer IS NOT NULL")
    return rows.select(
        "seq", "difficulty", F.col("answer.language_constraint.target_languages")[0].alias("language"), "answer.key_trap",
        F.array_join("answer.must_cover", "|").alias("must_cover"), F.array_join("answer.must_avoid", "|").alias("must_avoid"),
        "answer.generation_hints.*",
    )


@query(f"""WITH {EVIDENCE_SQL}, p AS (SELECT t.key, t.fault_type, t.frequency, array_to_string(b.sample_task_ids, ',') AS sample_ids,
  s.pos, s.wrong_line, s.correct_approach, s.failed_test FROM top t JOIN best b USING (key) JOIN first_three s ON s.key = t.key)
SELECT key, fault_type, frequency, sample_ids, pos, {SUMMARY_SQL} AS summary, {language_sql(EVIDENCE_TEXT)} AS language FROM p""")
def synthesis_view(spark, sf):
    """Top weaknesses with summary and language of each piece of evidence."""
    from catalog.planning import evidence_samples

    found = report(spark, sf)
    top = sl.top_weaknesses(found.weaknesses, TOP.top_n)
    rows = sp.synthesis_view(top.join(evidence_samples(spark, sf, found), "key"))
    return rows.select(
        "key", "fault_type", "frequency", F.array_join(F.col("sample_task_ids").cast("array<string>"), ",").alias("sample_ids"),
        F.col("pos").cast("bigint").alias("pos"), F.col("canonical_summary").alias("summary"),
        F.col("primary_language").alias("language"),
    )


def made(spark, sf):
    return synthesize(report(spark, sf), diagnoses(spark, sf), settings=TOP)


@query()
def spec_table(spark, sf):
    """The synthesize stage: accepted specs with their numbers."""
    rows = made(spark, sf).specs
    listed = lambda c: F.array_join(c, "|")
    return rows.select(
        "spec_id", F.col("target_weakness.root_cause").alias("key"), "problem_spec.difficulty", "diversity_tags.*",
        "problem_spec.key_trap", listed("problem_spec.must_cover").alias("must_cover"),
        listed("problem_spec.must_avoid").alias("must_avoid"), "generation_hints.solution_approach",
        F.col("target_weakness.capability_cliff").alias("summary"),
        listed("language_constraint.target_languages").alias("languages"),
    )


@query()
def spec_events(spark, sf):
    return made(spark, sf).events.select("weakness", "error_type", "event_type", "message")


@query(f"""WITH {SPECS_SQL}, ok AS (SELECT seq FROM specs WHERE difficulty = 'hard')
SELECT seq, 'spec-' || CASE WHEN n < 10000 THEN lpad(CAST(n AS VARCHAR), 4, '0') ELSE CAST(n AS VARCHAR) END AS spec_id
FROM (SELECT seq, row_number() OVER (ORDER BY seq) AS n FROM ok)""")
def spec_numbers(spark, sf):
    """Dense numbers over the accepted rows, here the hard ones."""
    rows = specs(spark, sf).filter("difficulty = 'hard'").select(F.col("seq").alias("rank"), F.lit(0).alias("slot"))
    return sp.numbered(rows).select(F.col("rank").alias("seq"), "spec_id")


@query(f"""WITH {SPECS_SQL} SELECT seq, array_to_string({dedupe_sql("list_concat(string_split(avoid_text, ';'), ['avoid duplicates of spec-' || CAST(seq AS VARCHAR)])")}, '|') AS notes FROM specs""")
def duplicate_notes(spark, sf):
    return view(spark, sf).select("seq", F.array_join(distinct_notes(F.concat("avoid", "notes")), "|").alias("notes"))
