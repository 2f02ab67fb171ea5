import re

import pytest
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.text import norm, strip, token_count
from weakspot.operators import rules as ru

TEXTS = [
    "TLE", "Timed  out", "time limit\texceeded", "TİMEOUT", "StackOverflowError", "stack overflow", "maximum recursion depth",
    "error: x", "a.cpp:3: error: y", "cannot find symbol", "expected ';'", "undefined reference", "compilation failed",
    "compile error", "javac", "g++", "gcc", "go: bad", "syntax error: unexpected", "TabError", "unexpected indent",
    "invalid syntax", "IndentationError", "undefined variable", "not defined", "cannot find name", "NameError",
    "ImportError", "ModuleNotFoundError", "no module named", "package a.b does not exist", "TypeError: f() takes 1",
    "TypeError: keyword", "argument mismatch", "wrong number of arguments", "missing 2 required positional argument",
    "takes 2 positional arguments", "empty output", "no output", "missing return", "NoneType", "returned None",
    "division by zero", "divide by zero", "ArithmeticException: / by zero", "math domain error", "ZeroDivisionError",
    "IndexError", "KeyError", "ArrayIndexOutOfBoundsException", "NoSuchElementException", "index out of range",
    "key not found", "output format mismatch", "presentation error", "wrong format", "formatting issue", "AssertionError",
    "assertion failed", "assert failed", "a ſtack overflow", "gcC", "KeyError", "TypeError:\nargument", "subtle title",
    "étle", "nothing here", "", "line\r\nerror: z",
]


def python_hits(text):
    return [r[0] for r in fixed.RULES if re.search(r[1], text, re.IGNORECASE | re.MULTILINE)]


def test_screen_agrees_with_plain_search(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    got = {r["text"]: r["rule_id"] for r in ru.with_first_hit(rows, "text").select("text", "rule.rule_id").collect()}
    assert got == {t: next(iter(python_hits(t)), None) for t in TEXTS}
    every = [(r["text"], r["rule_id"]) for r in ru.hits(rows, "text").collect()]
    assert sorted(every) == sorted((t, rule) for t in TEXTS for rule in python_hits(t))


def test_every_pattern_is_covered_by_a_text():
    assert {rule for t in TEXTS for rule in python_hits(t)} == {r[0] for r in fixed.RULES}


def test_composition(spark):
    custom = [{"name": " X1 ", "pattern": "x", "fault_type": "surface", "sub_tag": "xx", "severity": "low"}]
    rules = ru.compose_rules(custom, disabled=["R001"], severities={"xx": "high", "X1": "medium"}, order=["X1", "R010"])
    assert [r.rule_id for r in rules[:3]] == ["X1", "R010", "R007"] and rules[0].severity == "medium"
    assert [r.priority for r in rules] == list(range(1, 13))


@pytest.mark.parametrize("settings, message", [
    ({"custom": [{"name": " "}]}, "must not be empty"),
    ({"custom": [{"name": "A"}, {"name": "A "}]}, "duplicate custom rule name: A"),
    ({"custom": [{"name": "R001"}]}, "collides"),
    ({"order": ["R001", "R001"]}, "duplicate rule_priority ID: R001"),
    ({"order": ["R001"], "disabled": ["R001"]}, "unknown rule_priority ID: R001"),
])
def test_bad_rule_settings(spark, settings, message):
    base = {"pattern": "p", "fault_type": "surface", "sub_tag": "s", "severity": "low"}
    settings["custom"] = [{**base, **c} for c in settings.get("custom", [])]
    with pytest.raises(ValueError, match=message):
        ru.compose_rules(**settings)


def test_text_helpers_agree_with_python(spark):
    texts = ["", "  ", "a", " a\tb\n", "\x1ca\x1db", " x y　", "É È", "a​b"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", strip(F.col("t")).alias("s"), norm(F.col("t")).alias("n"), token_count(F.col("t")).alias("c")).collect():
        assert (r["s"], r["n"], r["c"]) == (r["t"].strip(), r["t"].strip().lower(), len(r["t"].split()))
