"""Column jobs over evidence, specs, pages, documents and answers."""

from pyspark.sql import functions as F

from catalog import sqltext as s
from catalog.registry import query, table
from catalog.views import LOG_SQL, NUM, SPECS_SQL, UID, log, specs
from weakspot import fixed_values as fixed
from weakspot.functions import contracts as ct
from weakspot.functions import language as lg
from weakspot.functions import names as nm
from weakspot.functions import responses as rs
from weakspot.functions.evidence import is_grounded, reference_line, summary
from weakspot.functions.text import distinct_notes, unwrap_json
from weakspot.operators.regenerate import diversity_hint, retry_hint

EVIDENCE_TEXT = "wrong_line || chr(10) || correct_approach || chr(10) || failed_test"


def _end(pattern: str) -> str:
    """The end of a text may be followed by one line end."""
    return pattern[:-1] + r"\n?$" if pattern.endswith("$") else pattern


def _guarded(pattern: str) -> str:
    """Word boundaries that know letters outside ASCII."""
    return r"(?:^|[^\p{L}\p{N}_])" + pattern.replace(r"\b", "") + r"(?:$|[^\p{L}\p{N}_])"


def language_sql(text: str, guarded: bool = False) -> str:
    fence = (
        f"list_filter(list_transform({s.all_of(text, fixed.FENCE_TAG)}, lambda f: "
        f"{s.case_map('lower(f)', fixed.LANGUAGE_OF_FENCE, 'NULL')}), lambda f: f IS NOT NULL)[1]"
    )
    whens = []
    for language, patterns in fixed.LANGUAGE_SYNTAX:
        tests = [s.hit(text, p if flags else _end(p), flags) for flags, p in patterns]
        whens.append(f"WHEN {' OR '.join(tests)} THEN {s.lit(language)}")
    for language, pattern in fixed.LANGUAGE_MENTION:
        # a boundary after a plus sign asks for a word character, so c++ alone never counts
        plain = pattern if not guarded else "|".join(_guarded(p) for p in pattern.split("|") if "+" not in p)
        whens.append(f"WHEN {s.hit(text, plain, 'i')} THEN {s.lit(language)}")
    return f"coalesce({fence}, CASE {' '.join(whens)} END, 'unknown')"


@query(f"WITH {LOG_SQL} SELECT task_id, {language_sql(EVIDENCE_TEXT)} AS language FROM log")
def language_of_evidence(spark, sf):
    rows = log(spark, sf).withColumn("t", lg.evidence_text(F.col("evidence")))
    return rows.select("task_id", lg.primary_language(F.col("t")).alias("language"))


@query(f"""SELECT 'page' AS kind, page_id AS id, {language_sql('html', True)} AS language FROM pages
UNION ALL SELECT 'document', doc_id, {language_sql('text', True)} FROM documents""")
def language_of_texts(spark, sf):
    """Whole pages and documents."""
    pages = table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("t"))
    docs = table(spark, sf, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("t"))
    return pages.union(docs).select("kind", "id", lg.primary_language(F.col("t")).alias("language"))


_LOWER = "lower(wrong_line || ' ' || correct_approach || ' ' || failed_test)"
SUMMARY_SQL = "CASE WHEN key = 'logic_error' THEN CASE " + " ".join(
    f"WHEN {s.any_phrase(_LOWER, phrases)} THEN {s.lit(line)}" for phrases, line in fixed.LOGIC_SUMMARY
) + f" ELSE {s.lit(fixed.DEFAULT_SUMMARY)} END ELSE {s.case_map('key', fixed.TAG_SUMMARY, s.lit(fixed.DEFAULT_SUMMARY))} END"


@query(f"""WITH {SPECS_SQL} SELECT seq, {SUMMARY_SQL} AS summary FROM (
  SELECT *, CASE WHEN tag = 'state_tracking' THEN 'logic_error' WHEN seq % 16 = 4 THEN 'state_tracking' ELSE tag END AS key FROM specs)""")
def weakness_summaries(spark, sf):
    key = F.when(F.col("tag") == "state_tracking", "logic_error").when(F.col("seq") % 16 == 4, "state_tracking").otherwise(F.col("tag"))
    return specs(spark, sf).select("seq", summary(key, F.col("evidence")).alias("summary"))


_COVER = "lower(replace(cover_text, ';', ' '))"
_AVOID = "lower(replace(avoid_text, ';', ' '))"


def _signal(name):
    side, phrases = next((f, p) for n, f, p in fixed.CONTRACT_SIGNALS if n == name)
    text = _COVER if side == "cover" else _AVOID
    return "CASE " + " ".join(f"WHEN contains({text}, {s.lit(p)}) THEN {s.lit(p)} END" if n == len(phrases) - 1
                              else f"WHEN contains({text}, {s.lit(p)}) THEN {s.lit(p)}" for n, p in enumerate(phrases))


_SIGNALS = [name for name, _, _ in fixed.CONTRACT_SIGNALS]


@query(f"""WITH {SPECS_SQL}, found AS (SELECT seq, {', '.join(f'{_signal(n)} AS {n}' for n in _SIGNALS)} FROM specs)
SELECT seq, {', '.join(f'{n} IS NOT NULL AS {n}' for n in _SIGNALS)},
  array_to_string(list_filter([{', '.join(_SIGNALS)}], lambda p: p IS NOT NULL), '|') AS matched_phrases FROM found""")
def contract_signals(spark, sf):
    found = ct.signal_phrases(F.col("c"), F.col("a"))
    rows = specs(spark, sf).withColumns({"c": ct.note_text(F.col("cover")), "a": ct.note_text(F.col("avoid"))})
    return rows.select(
        "seq", *[column.isNotNull().alias(name) for name, column in found.items()],
        F.array_join(F.array(*found.values()), "|").alias("matched_phrases"),
    )


def _tokens(x):
    return f"list_filter({s.all_of(f'lower({x})', fixed.EVIDENCE_TOKEN, 0)}, lambda w: w NOT IN {s.among(fixed.GROUNDING_STOP_WORDS)})"


def _named(cand, spans):
    return f"len(list_filter({spans}, lambda q: {s.strip('lower(q)')} <> '' AND contains({cand}, {s.strip('lower(q)')}))) > 0"


def grounded_sql(text, wrong="wrong_line", correct="correct_approach"):
    cand = f"lower({text})"
    idents = (
        f"list_transform(list_concat({s.all_of(wrong, fixed.DEFINED_NAME)}, "
        f"list_filter({s.all_of(wrong, fixed.IDENTIFIER, 0)}, lambda i: contains(i, '_'))), lambda i: lower(i))"
    )
    phrases = " OR ".join(
        f"(contains(lower({wrong}), {s.lit(p)}) AND contains({cand}, {s.lit(p)}))" for p in fixed.GROUNDING_PHRASES
    )
    return f"""({_named(cand, s.all_of(wrong, fixed.QUOTED_SPAN))} OR {_named(cand, s.all_of(correct, fixed.QUOTED_SPAN))}
      OR len(list_filter({idents}, lambda i: len(i) >= 4 AND i NOT IN {s.among(fixed.GROUNDING_IDENTIFIER_EXCEPTIONS)} AND contains({cand}, i))) > 0
      OR {phrases}
      OR (contains(lower({wrong}), {s.lit(fixed.MISSING_BLOCK_PHRASE)}) AND {s.any_phrase(cand, fixed.MISSING_BLOCK_CAUSES)}
        AND {s.any_phrase(cand, fixed.MISSING_BLOCK_TARGETS)})
      OR {_named(cand, s.all_of(wrong, fixed.RETURN_EXPRESSION))}
      OR (len(list_filter({_tokens(wrong)}, lambda w: contains({cand}, w))) > 0
        AND len(list_filter({_tokens(correct)}, lambda w: contains({cand}, w))) > 0))"""


@query(f"WITH {SPECS_SQL} SELECT seq, {grounded_sql('trap')} AS grounded FROM specs")
def evidence_grounding(spark, sf):
    return specs(spark, sf).select(
        "seq", is_grounded(F.col("trap"), F.col("wrong_line"), F.col("correct_approach")).alias("grounded")
    )


_MISSING = "list_filter([" + ", ".join(
    f"CASE WHEN tag = {s.lit(tag)} AND {name} IS NULL THEN {s.lit(name)} END"
    for tag, *names in fixed.REQUIRED_SIGNALS for name in names
) + "], lambda g: g IS NOT NULL)"
_PAIRS = {tag: names for tag, *names in fixed.REQUIRED_SIGNALS}
_REASON = f"CASE WHEN NOT grounded THEN {s.lit(fixed.UNGROUNDED_TRAP_REASON)} " + " ".join(
    f"WHEN tag = {s.lit(tag)} AND ({_PAIRS[tag][0]} IS NULL OR {_PAIRS[tag][1]} IS NULL) THEN {s.lit(reason)}"
    for tag, reason in fixed.LINT_REASONS
) + " END"


@query(f"""WITH {SPECS_SQL}, found AS (SELECT seq, tag, {grounded_sql('trap')} AS grounded,
    {', '.join(f'{_signal(n)} AS {n}' for n in _SIGNALS)} FROM specs),
judged AS (SELECT seq, {_REASON} AS why, {_MISSING} AS gaps, grounded FROM found)
SELECT seq, why IS NULL AS accepted, coalesce(why, {s.lit(fixed.LINT_ACCEPTED_REASON)}) AS reason,
  CASE WHEN why IS NOT NULL AND grounded THEN array_to_string(gaps, ',') ELSE '' END AS missing_contracts FROM judged""")
def spec_lint(spark, sf):
    from weakspot.operators.specs import linted

    shaped = specs(spark, sf).select(
        "seq", "evidence", F.struct("sub_tags").alias("target_weakness"),
        F.struct(F.col("trap").alias("key_trap"), F.col("cover").alias("must_cover"), F.col("avoid").alias("must_avoid"))
        .alias("problem_spec"),
    )
    return linted(shaped).select("seq", "accepted", "reason", F.array_join("missing_contracts", ",").alias("missing_contracts"))


def names_sql(text, quoted=True):
    patterns = [p for p in fixed.NAME_PATTERNS if quoted or p != fixed.QUOTED_NAME_PATTERN]
    every = s.distinct(f"list_concat({', '.join(s.all_of(text, p) for p in patterns)})")
    return f"list_filter({every}, lambda n: n NOT IN {s.among(fixed.STOP_NAMES)})"


@query(f"""WITH {LOG_SQL}, n AS (SELECT task_id, {names_sql('wrong_line', False)} AS w, {names_sql('correct_approach', False)} AS c,
  {names_sql('failed_test', False)} AS f FROM log)
SELECT task_id, coalesce(w[1], 'the wrong callable') AS wrong, coalesce(c[-1], f[-1], w[-1], 'the requested entry point') AS target FROM n""")
def evidence_entry_points(spark, sf):
    return log(spark, sf).select("task_id", nm.evidence_entry_points(F.col("evidence")).alias("p")).select("task_id", "p.*")


_ASCII = "[^\\x00-\\x7F]"


@query(f"""SELECT page_id, array_to_string({names_sql('t')}, ',') AS names
FROM (SELECT page_id, regexp_replace(html, '{_ASCII}', 'x', 'g') AS t FROM pages)""")
def names_in_pages(spark, sf):
    """Names called or defined in whole pages (letters outside ASCII as x)."""
    text = F.regexp_replace("html", _ASCII, "x")
    return table(spark, sf, "pages").select("page_id", F.array_join(nm.function_names(text), ",").alias("names"))


def _all(text, patterns, flags=""):
    return s.distinct(f"list_concat({', '.join(s.all_of(text, p, 1, flags) for p in patterns)})")


def entry_points_sql(text, errors=True):
    patterns = [p for p in fixed.ENTRYPOINT_PATTERNS if errors or p != fixed.NAME_ERROR_PATTERN]
    return f"list_filter({_all(text, patterns)}, lambda n: lower(n) NOT IN {s.among(fixed.ENTRYPOINT_STOP_WORDS)})"


def targets_sql(text):
    kind = (
        f"CASE WHEN {s.any_phrase(f'lower({text})', fixed.METHOD_MARKERS)} THEN 'method' "
        f"WHEN {s.any_phrase(f'lower({text})', fixed.FUNCTION_MARKERS)} THEN 'function' ELSE 'symbol' END"
    )
    return (
        f"list_concat(list_transform({_all(text, fixed.EXPECTED_DOTTED_PATTERNS, 'i')}, lambda d: 'attribute:' || d), "
        f"list_transform({_all(text, fixed.EXPECTED_IDENTIFIER_PATTERNS, 'i')}, lambda d: {kind} || ':' || d), "
        f"list_transform({entry_points_sql(text)}, lambda d: 'function:' || d))"
    )


TARGET_SQL = (
    f"coalesce({targets_sql('correct_approach')}[1], {targets_sql('failed_test')}[1], "
    f"{targets_sql(s.strip('string_split(cover_text, chr(59))[1]'))}[1], "
    f"{targets_sql(s.strip('string_split(cover_text, chr(59))[2]'))}[1], {targets_sql(s.strip('trap'))}[1], {targets_sql('wrong_line')}[1])"
)
_WRONG_TARGET = f"""CASE
  WHEN len({_all('wrong_line', fixed.EXPECTED_DOTTED_PATTERNS, 'i')}) > 0 THEN 'the wrong public attribute `' || {_all('wrong_line', fixed.EXPECTED_DOTTED_PATTERNS, 'i')}[1] || '`'
  WHEN len({entry_points_sql('wrong_line')}) > 0 THEN 'the wrong public function `' || {entry_points_sql('wrong_line')}[1] || '`'
  WHEN len({_all('wrong_line', fixed.EXPECTED_IDENTIFIER_PATTERNS, 'i')}) > 0 THEN 'the wrong public symbol `' || {_all('wrong_line', fixed.EXPECTED_IDENTIFIER_PATTERNS, 'i')}[1] || '`'
  WHEN {s.strip('wrong_line')} <> '' THEN 'the wrong public output shape from `' || {s.strip('wrong_line')}[1:80] || '`'
  ELSE 'the wrong public contract' END"""
TARGET_PHRASE = """CASE WHEN target IS NULL THEN 'the exact public entry point expected by the harness'
  ELSE 'the exact public ' || split_part(target, ':', 1) || ' `' || split_part(target, ':', 2) || '`' END"""


@query(f"""WITH {SPECS_SQL}, t AS (SELECT seq, wrong_line, {TARGET_SQL} AS target FROM specs)
SELECT seq, {TARGET_PHRASE} AS target, {_WRONG_TARGET} AS wrong FROM t""")
def contract_targets(spark, sf):
    items = F.concat("cover", F.array("trap"))
    return specs(spark, sf).select(
        "seq", nm.target_phrase(nm.resolve_target(F.col("evidence"), items)).alias("target"),
        nm.wrong_target_phrase(F.col("wrong_line")).alias("wrong"),
    )


@query(f"""WITH {SPECS_SQL}, t AS (SELECT seq, trap, wrong_line, {TARGET_SQL} AS target FROM specs WHERE tag = 'function_name_mismatch'),
p AS (SELECT seq, trap, {TARGET_PHRASE} AS wanted, {_WRONG_TARGET} AS wrong FROM t)
SELECT seq, {s.strip('trap')} || ' The task must enforce ' || wanted || ' and reject ' || wrong || '.' AS trap,
  'Implement ' || wanted || '.' AS solution_approach,
  'Expose a different public function name or public output shape than ' || wanted || '.' AS common_wrong_approach,
  'Call only ' || wanted || ' and reject alternate public names or output shapes.' AS distinguishing_test FROM p""")
def mismatch_narratives(spark, sf):
    rows = specs(spark, sf).filter("tag = 'function_name_mismatch'")
    items = F.concat("cover", F.array("trap"))
    phrases = rows.select(
        "seq", "trap", nm.target_phrase(nm.resolve_target(F.col("evidence"), items)).alias("wanted"),
        nm.wrong_target_phrase(F.col("wrong_line")).alias("wrong"),
    )
    return phrases.select(
        "seq", F.format_string(fixed.NARRATIVE_TRAP_FORMAT, F.trim("trap"), "wanted", "wrong").alias("trap"),
        *[F.format_string(form, "wanted").alias(name) for name, form in fixed.NARRATIVE_HINT_FORMATS.items()],
    )


def dedupe_sql(items):
    """Items that are not blank and not equal to an earlier one without case and outer space."""
    keys = f"list_transform({items}, lambda k: lower({s.strip('k')}))"
    return f"list_filter({items}, lambda k, ki: lower({s.strip('k')}) <> '' AND list_position({keys}, lower({s.strip('k')})) = ki)"


_ITEMS = "string_split(cover_text || ';' || avoid_text || ';' || upper(cover_text), ';')"


@query(f"WITH {SPECS_SQL} SELECT seq, array_to_string({dedupe_sql(_ITEMS)}, '|') AS notes FROM specs")
def distinct_spec_notes(spark, sf):
    items = F.concat("cover", "avoid", F.split(F.upper("cover_text"), ";"))
    return specs(spark, sf).select("seq", F.array_join(distinct_notes(items), "|").alias("notes"))


_REF_LINES = (
    "list_filter(list_transform(list_filter(string_split(wrong_line, chr(10)), lambda l: NOT starts_with("
    + s.strip("l") + ", '```')), lambda l: " + s.strip("trim(l, '` ')") + "), lambda l: l <> '')"
)
REFERENCE_SQL = f"coalesce({_REF_LINES}[1][1:120], CASE WHEN wrong_line <> '' THEN wrong_line[1:120] END, 'original failing output')"


@query(f"WITH {LOG_SQL} SELECT task_id, {REFERENCE_SQL} AS reference FROM log")
def evidence_reference_lines(spark, sf):
    return log(spark, sf).select("task_id", reference_line(F.col("evidence.wrong_line")).alias("reference"))


_REASONS = "CASE seq % 7 " + " ".join(f"WHEN {n} THEN {s.lit(reason)}" for n, (_, reason) in enumerate(fixed.LINT_REASONS)) \
    + " WHEN 5 THEN trap ELSE 'Candidate diversity tags overlap above threshold with spec-' || tag END"


def _mode(x, modes, default):
    return "CASE " + " ".join(f"WHEN {s.any_phrase(f'lower({x})', p)} THEN {s.lit(m)}" for m, p in modes) + f" ELSE {s.lit(default)} END"


@query(f"""WITH {SPECS_SQL}, r AS (SELECT {_REASONS} AS reason FROM specs)
SELECT reason, {_mode('reason', fixed.FEASIBILITY_RETRY_MODES, fixed.FEASIBILITY_RETRY_DEFAULT)} AS mode,
  {_mode('reason', fixed.DIVERSITY_RETRY_MODES, fixed.DIVERSITY_RETRY_DEFAULT)} AS diversity_mode, count(*) AS specs FROM r GROUP BY ALL""")
def retry_hints(spark, sf):
    reasons = specs(spark, sf).withColumn("reason", F.expr(_REASONS))
    return reasons.groupBy(
        "reason", retry_hint(F.col("reason")).alias("mode"), diversity_hint(F.col("reason")).alias("diversity_mode")
    ).agg(F.count(F.lit(1)).alias("specs"))


# --- answers as JSON text ------------------------------------------------------

_LIMITS = f"""CASE event_id % 4 WHEN 0 THEN '{{"n_range": [1, ' || {NUM} || '], "value_range": [0, 9], "time_limit": "1s", "memory_limit": "64MB"}}'
  WHEN 1 THEN '"n from 1 to ' || {NUM} || ', values 5 to 70, within 2 s and 512 mb"' WHEN 2 THEN '"fast"' ELSE 'null' END"""
_COVERS = f"""CASE event_id % 5 WHEN 0 THEN '["a ' || {UID} || '", " ", 7, true]' WHEN 1 THEN '"x; y,z|w"' WHEN 2 THEN '[]' WHEN 3 THEN '12' ELSE '[" b "]' END"""
_CHECKING = f"""CASE event_id % 3 WHEN 0 THEN '"At least ' || {UID} || ' tests, edge case: empty list ' || {NUM} || '. Brute force yes in O(n^3)"'
  WHEN 1 THEN '{{"min_test_cases": 3, "must_include_edge_cases": ["e"], "brute_force_verifiable": false, "brute_force_complexity_limit": "O(n)"}}' ELSE '"none"' END"""
_HINTING = f"""CASE event_id % 3 WHEN 0 THEN '"Solution approach: sort ' || {UID} || ' Common wrong approach: skip Distinguishing test: big"'
  WHEN 1 THEN '{{"solution_approach": "s", "common_wrong_approach": "c", "distinguishing_test": "t"}}' ELSE '" only text ' || {NUM} || ' "' END"""
_SPEAKING = """CASE event_id % 6 WHEN 0 THEN '"Java or JavaScript"' WHEN 1 THEN '"any"' WHEN 2 THEN '"C++ (cpp) only"' WHEN 3 THEN '"Go, rust and R"'
  WHEN 4 THEN '{"target_languages": ["go"], "language_specific": true}' ELSE '"python"' END"""
ANSWERS = {
    "seq": "event_id",
    "raw": f"""CASE WHEN event_id % 11 = 0 THEN '```json' || chr(10) WHEN event_id % 11 = 1 THEN '  ```' ELSE '' END
    || '{{"algorithm_type": "dp", "difficulty": "hard", "narrative_theme": "ports", "extra": 1, "key_trap": "trap ' || {NUM} || '"'
    || ', "constraints": ' || {_LIMITS} || ', "must_cover": ' || {_COVERS} || ', "must_avoid": ' || {_COVERS}
    || ', "verification_spec": ' || {_CHECKING} || ', "generation_hints": ' || {_HINTING}
    || CASE WHEN event_id % 13 = 0 THEN '' ELSE ', "language_constraint": ' || {_SPEAKING} END || '}}'
    || CASE WHEN event_id % 11 IN (0, 1) THEN chr(10) || '``` ' ELSE '' END""",
}
ANSWERS_SQL = "answers AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in ANSWERS.items()) + " FROM events)"
# unwrapped by regular expression here, by position in Spark
UNWRAP_SQL = (
    f"CASE WHEN regexp_full_match({s.strip('raw')}, '(?s)```(?:json)?\\s*(.*?)\\s*```') "
    f"THEN regexp_extract({s.strip('raw')}, '(?s)^```(?:json)?\\s*(.*?)\\s*```$', 1) ELSE {s.strip('raw')} END"
)


def answers(spark, sf):
    return table(spark, sf, "events").selectExpr(*[f"{e} AS {n}" for n, e in ANSWERS.items()])


@query(f"WITH {ANSWERS_SQL} SELECT seq, {UNWRAP_SQL} AS body FROM answers")
def unwrapped_answers(spark, sf):
    return answers(spark, sf).select("seq", unwrap_json(F.col("raw")).alias("body"))


def _list_sql(name):
    return f"""CASE json_type(j, '$.{name}') WHEN 'ARRAY' THEN list_filter(list_transform(CAST(json_extract(j, '$.{name}') AS JSON[]),
      lambda e: {s.strip("CASE json_type(e) WHEN 'BOOLEAN' THEN CASE e->>'$' WHEN 'true' THEN 'True' ELSE 'False' END ELSE e->>'$' END")}), lambda e: e <> '')
    WHEN 'VARCHAR' THEN list_filter(list_transform(regexp_split_to_array(j->>'$.{name}', {s.lit(fixed.LIST_DELIMITERS)}), lambda e: {s.strip('e')}), lambda e: e <> '')
    ELSE [] END"""


def _found(text, pattern, default):
    return f"coalesce(nullif(regexp_extract({text}, {s.lit(pattern)}, 1), ''), {default})"


_C, _V, _H, _L = (f"j->>'$.{n}'" for n in ["constraints", "verification_spec", "generation_hints", "language_constraint"])
_NUMBERS = f"regexp_extract_all({_C}, '\\d+')"


def _is(name, kind):
    return f"json_type(j, '$.{name}') = '{kind}'"


def _hint_sql(label, name):
    # the lookahead of the pattern has no counterpart here: cut at the next label instead
    rest = f"regexp_replace({_H}, '(?is)^.*?{label}:\\s*', '')"
    cut = f"regexp_replace({rest}, '(?is)(solution approach|common wrong approach|distinguishing test):.*$', '')"
    return (
        f"CASE WHEN {_is('generation_hints', 'OBJECT')} THEN j->>'$.generation_hints.{name}' "
        f"WHEN regexp_matches({_H}, '(?i){label}:') THEN {s.strip(cut)} ELSE {s.strip(_H)} END"
    )


_MENTIONS = "list_filter([" + ", ".join(
    f"CASE WHEN {s.hit(f'lower({_L})', p)} THEN {s.lit(n)} END" for n, p in fixed.CONSTRAINT_MENTION
) + "], lambda l: l IS NOT NULL)"


@query(f"""WITH {ANSWERS_SQL}, p AS (SELECT seq, CAST({UNWRAP_SQL} AS JSON) AS j FROM answers)
SELECT seq, j->>'$.key_trap' AS key_trap,
  array_to_string({_list_sql('must_cover')}, '|') AS must_cover,
  CASE WHEN {_is('constraints', 'OBJECT')} THEN replace(replace(replace(CAST(json_extract(j, '$.constraints.n_range') AS VARCHAR), '[', ''), ']', ''), ' ', '')
       WHEN {_is('constraints', 'VARCHAR')} THEN CASE WHEN len({_NUMBERS}) >= 2 THEN {_NUMBERS}[1] || ',' || {_NUMBERS}[2] ELSE '1,10000' END END AS n_range,
  CASE WHEN {_is('constraints', 'OBJECT')} THEN '0,9'
       WHEN {_is('constraints', 'VARCHAR')} THEN CASE WHEN len({_NUMBERS}) >= 4 THEN {_NUMBERS}[3] || ',' || {_NUMBERS}[4] ELSE '0,1000000' END END AS value_range,
  CASE WHEN {_is('constraints', 'OBJECT')} THEN j->>'$.constraints.time_limit' WHEN {_is('constraints', 'VARCHAR')}
    THEN replace({_found(_C, '(?i)' + fixed.TIME_LIMIT_PATTERN, "'1s'")}, ' ', '') END AS time_limit,
  CASE WHEN {_is('constraints', 'OBJECT')} THEN j->>'$.constraints.memory_limit' WHEN {_is('constraints', 'VARCHAR')}
    THEN upper(replace({_found(_C, '(?i)' + fixed.MEMORY_LIMIT_PATTERN, "'256MB'")}, ' ', '')) END AS memory_limit,
  CASE WHEN {_is('verification_spec', 'OBJECT')} THEN 3 ELSE CAST({_found(_V, '(?i)' + fixed.MIN_TESTS_PATTERN, "'4'")} AS INTEGER) END AS min_test_cases,
  CASE WHEN {_is('verification_spec', 'OBJECT')} THEN 'e' ELSE {s.strip(f"regexp_extract({_V}, {s.lit('(?i)' + fixed.EDGE_CASE_PATTERN)}, 1)")} END AS edge_cases,
  CASE WHEN {_is('verification_spec', 'OBJECT')} THEN false ELSE contains(lower({_V}), 'yes') OR contains(lower({_V}), 'true') END AS verifiable,
  CASE WHEN {_is('verification_spec', 'OBJECT')} THEN 'O(n)' ELSE {_found(_V, fixed.COMPLEXITY_PATTERN, "'O(n^2)'")} END AS complexity,
  {_hint_sql('solution approach', 'solution_approach')} AS solution_approach,
  {_hint_sql('common wrong approach', 'common_wrong_approach')} AS common_wrong_approach,
  {_hint_sql('distinguishing test', 'distinguishing_test')} AS distinguishing_test,
  CASE WHEN {_is('language_constraint', 'OBJECT')} THEN 'go' WHEN {_is('language_constraint', 'VARCHAR')}
    THEN CASE WHEN len({_MENTIONS}) = 0 THEN 'python' ELSE array_to_string({_MENTIONS}, ',') END END AS languages,
  CASE WHEN {_is('language_constraint', 'OBJECT')} THEN true WHEN {_is('language_constraint', 'VARCHAR')} THEN len({_MENTIONS}) = 1 END AS language_specific
FROM p""")
def cleaned_spec_answers(spark, sf):
    typed = answers(spark, sf).select("seq", rs.parsed(F.col("raw")).alias("v")).select("seq", rs.clean_response(F.col("v")).alias("a"))
    pair = lambda name: F.array_join(F.col(f"a.constraints.{name}").cast("array<string>"), ",").alias(name)
    return typed.select(
        "seq", "a.key_trap", F.array_join("a.must_cover", "|").alias("must_cover"), pair("n_range"), pair("value_range"),
        "a.constraints.time_limit", "a.constraints.memory_limit", "a.verification_spec.min_test_cases",
        F.array_join("a.verification_spec.must_include_edge_cases", "|").alias("edge_cases"),
        F.col("a.verification_spec.brute_force_verifiable").alias("verifiable"),
        F.col("a.verification_spec.brute_force_complexity_limit").alias("complexity"), "a.generation_hints.*",
        F.array_join("a.language_constraint.target_languages", ",").alias("languages"),
        "a.language_constraint.language_specific",
    )


@query(f"""WITH {ANSWERS_SQL} SELECT seq, array_to_string(list_filter([
  CASE WHEN seq % 4 = 3 THEN 'constraints.time_limit' END, CASE WHEN seq % 4 = 3 THEN 'constraints.memory_limit' END,
  CASE WHEN seq % 13 = 0 THEN 'language_constraint.target_languages' END,
  CASE WHEN seq % 13 = 0 THEN 'language_constraint.language_specific' END,
  CASE WHEN seq % 4 = 3 THEN 'constraints.n_range' END, CASE WHEN seq % 4 = 3 THEN 'constraints.value_range' END,
  CASE WHEN seq % 3 = 0 AND CAST((SELECT user_id FROM events WHERE event_id = seq) AS BIGINT) = 0 THEN 'verification_spec.min_test_cases' END
], lambda g: g IS NOT NULL), ',') AS gaps FROM answers""")
def answer_gaps(spark, sf):
    typed = answers(spark, sf).select("seq", rs.clean_response(rs.parsed(F.col("raw"))).alias("a"))
    return typed.select("seq", F.array_join(rs.response_gaps(F.col("a")), ",").alias("gaps"))


_IDS = f"""CASE event_id % 4 WHEN 0 THEN '[1, "2", " 3 ", "x", 4.9, true, null]' WHEN 1 THEN '[' || {NUM} || ']' WHEN 2 THEN 'null' ELSE '["1_000", -5]' END"""
_OK = """CASE event_id % 7 WHEN 0 THEN 'true' WHEN 1 THEN '" Yes "' WHEN 2 THEN '0' WHEN 3 THEN '"no"' WHEN 4 THEN '2' WHEN 5 THEN 'null' ELSE 'false' END"""
_FIXES = f"""CASE event_id % 3 WHEN 0 THEN '{{"a": 1, "b": "t' || {UID} || '"}}' ELSE '{{}}' END"""
GROUP_ANSWER = f"""'{{"refined_root_cause": "r ' || {NUM} || '"' || CASE WHEN event_id % 5 = 0 THEN '' ELSE ', "capability_cliff": "c"' END
  || ', "misdiagnosed_ids": ' || {_IDS} || ', "misdiagnosis_corrections": ' || {_FIXES} || ', "cluster_coherence": '
  || CASE event_id % 6 WHEN 0 THEN '1.5' WHEN 1 THEN '"0.5"' ELSE '0.25' END
  || ', "semantic_merges": [{{"source_tag": "s' || {UID} || '", "target_tag": "t", "confirmed": ' || {_OK} || '}}, 5, {{"source_tag": "only"}}]}}'"""
GROUP_SQL = f"raws AS (SELECT event_id AS seq, {GROUP_ANSWER} AS raw, {NUM} AS num, {UID} AS uid FROM events)"


@query(f"""WITH {GROUP_SQL} SELECT seq, 'r ' || num AS refined_root_cause,
  CASE seq % 4 WHEN 0 THEN '1,2,3,4,1' WHEN 1 THEN num WHEN 2 THEN '' ELSE '1000,-5' END AS ids,
  CASE WHEN seq % 3 = 0 THEN 'a=1;b=t' || uid ELSE '' END AS corrections,
  CAST(CASE seq % 6 WHEN 0 THEN 1.5 WHEN 1 THEN 0.5 ELSE 0.25 END AS DOUBLE) AS coherence,
  's' || uid || '>t:' || CASE WHEN seq % 7 IN (0, 1, 4) THEN 'true' ELSE 'false' END || ';only>:false' AS merges,
  CASE WHEN seq % 5 = 0 THEN 'capability_cliff is missing' WHEN seq % 6 = 0 THEN 'cluster_coherence is outside 0..1' END AS problem
FROM raws""")
def cleaned_group_answers(spark, sf):
    raws = table(spark, sf, "events").selectExpr("event_id AS seq", f"{GROUP_ANSWER} AS raw")
    typed = raws.withColumn("a", rs.clean_collective(rs.parsed(F.col("raw"))))
    pairs = F.transform(F.map_entries("a.misdiagnosis_corrections"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    merges = F.transform(
        "a.semantic_merges",
        lambda m: F.concat(m["source_tag"], F.lit(">"), m["target_tag"], F.lit(":"), m["confirmed"].cast("string")),
    )
    return typed.select(
        "seq", "a.refined_root_cause", F.array_join(F.col("a.misdiagnosed_ids").cast("array<string>"), ",").alias("ids"),
        F.array_join(F.array_sort(pairs), ";").alias("corrections"), F.col("a.cluster_coherence").alias("coherence"),
        F.array_join(merges, ";").alias("merges"), rs.collective_gap(F.col("raw"), F.col("a")).alias("problem"),
    )
