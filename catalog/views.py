"""Task and log views derived from the driver tables.

The expressions are read by Spark and by DuckDB alike: they use no backslash,
no double quotes and only functions both engines know.  Every row of a table
becomes a row of its view.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import table
from weakspot.schemas import TASK

UID = "CAST(user_id AS STRING)"
NUM = "CAST(CAST(floor(value) AS BIGINT) AS STRING)"
LINE = "chr(10)"
QUOTE = "chr(39)"


def _pick(count: int, *choices: str) -> str:
    assert len(choices) == count
    whens = " ".join(f"WHEN {n} THEN {c}" for n, c in enumerate(choices[:-1]))
    return f"CASE event_id % {count} {whens} ELSE {choices[-1]} END"


COMPLETION = _pick(
    19,
    f"'Execution hit a Time  Limit Exceeded after ' || {NUM} || ' ms'",
    f"'RecursionError: maximum recursion depth exceeded in f_' || {UID}",
    f"'main.cpp:' || {NUM} || ': error: missing brace'",
    f"'  SyntaxError: invalid syntax near ' || {NUM}",
    f"'NameError: name ' || {QUOTE} || 'g_' || {UID} || {QUOTE} || ' is not defined'",
    f"'ModuleNotFoundError: No module named lib' || {UID}",
    f"'TypeError: f_' || {UID} || '() takes 1 positional argument but ' || {NUM} || ' were given'",
    f"'The program printed no output for case ' || {NUM}",
    f"'ZeroDivisionError: division by zero at step ' || {NUM}",
    f"'IndexError: list index out of range in f_' || {UID}",
    f"'presentation error on line ' || {NUM}",
    f"'AssertionError: f_' || {UID} || '(3) returned ' || {NUM}",
    f"'```python' || {LINE} || 'def f_' || {UID} || '(xs):' || {LINE} || '    return sum(xs)' || {LINE} || '```'",
    f"'def f_' || {UID} || '(xs):' || {LINE} || '    return ' || {NUM}",
    f"'I explain the approach instead of code, final code block is missing for ' || {UID}",
    f"'A subtle title without any word of a rule, case ' || {NUM}",
    "''",
    "'N/A'",
    f"'public static int f_' || {UID} || '(int x) {{ return x; }}'",
)

TEST_CODE = _pick(
    5,
    f"'assert f_' || {UID} || '([1, 2]) == ' || {NUM}",
    "''",
    f"'import unittest' || {LINE} || 'x = ' || {NUM} || {LINE} || '#<INSERT>' || {LINE} || 'check(f_' || {UID} || ')'",
    f"'System.out.println(f_' || {UID} || '(3));'",
    "'N/A'",
)

LABELS = _pick(
    4,
    "'programming_language=python;fewshot=1'",
    "'Status = Correct_Solution;locale=en'",
    "'test_result=PASS'",
    "'functional_correctness=false;verification_level=exec_api;verification_status=passed'",
)

TASKS = {
    "task_id": "event_id",
    "content": _pick(
        7,
        f"'Write a function named ' || {QUOTE} || 'f_' || {UID} || {QUOTE} || ' that returns the sum of a list.'",
        f"'Implement entry point f_' || {UID} || '(xs). Return only the sorted list.'",
        f"'Wrap the answer in a markdown code block. Define f_' || {UID}",
        f"'Use markdown ```text``` around f_' || {UID}",
        f"'Solve task ' || {NUM} || ' in Java with a static method f_' || {UID}",
        f"'Markdown is allowed.' || {LINE} || 'Keep the code block format for ' || {NUM}",
        "''",
    ),
    "canonical_solution": f"'def f_' || {UID} || '(xs): return sum(xs) + ' || {NUM}",
    "completion": COMPLETION,
    "test_code": TEST_CODE,
    "labels_text": LABELS,
    "accepted": "event_type <> 'error'",
    "props": "props",
}

LOG = {
    "task_id": "event_id",
    "fault_type": _pick(5, "'comprehension'", "'modeling'", "'implementation'", "'edge_handling'", "'surface'"),
    "tags_text": _pick(
        13, "'Off-By-One'", "'Wrong Function Name'", "'markdown code fence'", "'missing_colon;Logic Error'",
        "'pass'", "'correct_output;correct execution'", "'pass;No Code Provided'", "' syntax_error '",
        "'function_name_mismatch'", "'logic_error'", "'state_tracking'", "''", "'non-executable-code'",
    ),
    "severity": _pick(3, "'low'", "'medium'", "'high'"),
    "description": f"'case ' || {NUM}",
    "wrong_line": COMPLETION,
    "correct_approach": _pick(
        8,
        f"'Define exactly one public function named `f_' || {UID} || '` and return the sum.'",
        f"'expected callable f_' || {UID}",
        "'Return only the required sorted list.'",
        f"'Handle the empty input and the boundary ' || {NUM}",
        f"'Expected the exact public identifier `Solver.f_' || {UID} || '`'",
        "'Use a flat list instead of a nested dict.'",
        "'Emit raw Python code without fences.'",
        f"'The test imports only run_' || {UID}",
    ),
    "failed_test": TEST_CODE,
    "labels_text": LABELS,
    "confidence": "value / 500",
    "diagnosis_source": _pick(
        6, "'non_failure'", "'rule_only'", "'rule_confirmed_by_model'", "'model_deep'", "'model_deep'", "'model_deep'"
    ),
}


def _cte(name: str, columns: dict[str, str], source: str) -> str:
    listed = ",\n  ".join(f"{expr} AS {alias}" for alias, expr in columns.items())
    return f"{name} AS (SELECT\n  {listed}\nFROM {source})"


TASKS_SQL = _cte("tasks", TASKS, "events")
LOG_SQL = _cte("log", LOG, "events")


def _view(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*[f"{expr} AS {alias}" for alias, expr in columns.items()])


def _labels() -> Column:
    return F.map_filter(F.str_to_map("labels_text", F.lit(";"), F.lit("=")), lambda k, v: v.isNotNull())


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task table made from ``events``."""
    view = _view(spark, sf_dir, TASKS).withColumns({"labels": _labels(), "metrics": F.col("props"), "extra": F.lit("{}")})
    return view.select(*TASK.fieldNames())


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnosis log as analyzers word it, made from ``events``; tags are not normalised."""
    return _view(spark, sf_dir, LOG).select(
        "task_id", "fault_type", F.split("tags_text", ";").alias("sub_tags"), "severity", "description",
        F.struct("wrong_line", "correct_approach", "failed_test").alias("evidence"),
        _labels().alias("enriched_labels"), "confidence", "diagnosis_source", F.lit("v1").alias("prompt_version"),
    )


# specs as generators word them, one per event
SPECS = {
    "seq": "event_id",
    "tag": _pick(
        8, "'function_name_mismatch'", "'missing_code_block'", "'markdown_formatting'", "'syntax_error'",
        "'logic_error'", "'non_executable_code'", "'state_tracking'", "'syntax_error'",
    ),
    "cover_text": _pick(
        9,
        f"'exact callable entry point f_' || {UID} || '(x);single exact public function contract'",
        f"'Require executable Java code output with the `f_' || {UID} || '` method'",
        "'Raw executable code output; raw executable code output ;Return the sum'",
        "'Require syntactically complete executable code.'",
        f"'Require runnable code output;public static int run_' || {UID} || '(int x)'",
        "'logic_error;Return only the sorted list'",
        "'Harness entry point solve(x)'",
        "'plain executable code; ;PLAIN executable code'",
        "''",
    ),
    "avoid_text": _pick(
        7,
        "'alternate public function names'",
        "'explanation-only answers;prose-only final responses'",
        "'Do not wrap in markdown fences, backticks or code fences'",
        "'incomplete code;missing colons'",
        "'avoid duplicates of spec-0001;Do not rename the public callable'",
        "'repair feasibility issue: no code; KEEP this ;keep this;Repair diversity issue: near'",
        "''",
    ),
    "trap": _pick(
        5,
        f"'Reference the original evidence: ' || {COMPLETION}",
        "'An explanation replaces the callable solve function'",
        f"'The case fails for f_' || {UID} || ' with an empty input'",
        f"'Case ' || {NUM}",
        "'Return only a flat list, the program must not print numpy output'",
    ),
    "solution_hint": _pick(3, f"'Call g_' || {UID} || '(x) first'", "'Sort the list'", f"'Use f_' || {UID} || '(x)'"),
    "wrong_line": COMPLETION,
    "correct_approach": LOG["correct_approach"],
    "failed_test": TEST_CODE,
    "difficulty": _pick(2, "'medium'", "'hard'"),
    "scale": _pick(3, "'small'", "'medium'", "'large'"),
    "fault_type": LOG["fault_type"],
    "cause": f"'Grouped by x/y for ' || {NUM}",
    "cliff": "'stays unstable under repeated similar tasks.'",
}
SPECS_SQL = _cte("specs", SPECS, "events")


def specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spec texts made from ``events``; lists are split from their text."""
    view = _view(spark, sf_dir, SPECS)
    return view.withColumns(
        {
            "cover": F.split("cover_text", ";"),
            "avoid": F.split("avoid_text", ";"),
            "sub_tags": F.array("tag"),
            "evidence": F.struct("wrong_line", "correct_approach", "failed_test"),
        }
    )
