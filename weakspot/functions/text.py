"""Whitespace, token and regular-expression helpers."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed

# characters the logs' producers count as whitespace (Unicode spaces and the
# four ASCII separators), which is more than Spark's trim removes by default
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACES = r"(?U)[\s\x1c-\x1f]+"


def pattern(regex: str, flags: str = "") -> Column:
    """Literal pattern with Unicode classes and ``\\n`` as the only line end."""
    return F.lit(f"(?{flags}dU){regex}")


def matches(text: Column, regex: str, flags: str = "") -> Column:
    return F.rlike(text, pattern(regex, flags))


def extract_all(text: Column, regex: str, flags: str = "", group: int = 1) -> Column:
    return F.regexp_extract_all(text, pattern(regex, flags), F.lit(group))


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def norm(text: Column) -> Column:
    """Stripped and lower case: the form in which tags and notes are compared."""
    return F.lower(strip(text))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def pinned(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add or replace a costly column so that it is computed once per row.

    Filters and projections on it would otherwise be rewritten down to its
    inputs and repeat the work; a one-element explode keeps them above it and
    stays inside generated code.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))


def first(array: Column) -> Column:
    return F.try_element_at(array, F.lit(1))


def last(array: Column) -> Column:
    return F.try_element_at(array, F.lit(-1))


def quoted(value: str) -> str:
    """SQL literal of a string."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strings(values) -> Column:
    """Array literal; typed even when empty."""
    values = list(values)
    if not values:
        return F.array().cast("array<string>")
    return F.expr(f"array({', '.join(map(quoted, values))})")


def lookup(key: Column, table: dict, default=None) -> Column:
    """Value of ``key`` in a fixed table."""
    entries = ", ".join(
        f"{quoted(k)}, {quoted(v) if isinstance(v, str) else f'{v}D' if isinstance(v, float) else v}"
        for k, v in table.items()
    )
    found = F.try_element_at(F.expr(f"map({entries})"), key)
    return found if default is None else F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def one_of(value: Column, values) -> Column:
    """The value is in a fixed list."""
    return F.array_contains(strings(values), value)


def contains_any(text: Column, phrases) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in phrases])


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda t: t != "")


def token_count(text: Column) -> Column:
    """Whitespace-separated tokens; 0 for blank and for null."""
    return F.coalesce(
        F.when(strip(text) == "", F.lit(0)).otherwise(F.size(F.split(strip(text), SPACES))), F.lit(0)
    )


def join_tokens(array: Column) -> Column:
    return F.array_join(array, " ")


def has_outer_fence(text: Column) -> Column:
    """The stripped text is one fenced block: it opens and closes with a fence."""
    body = strip(text)
    return (
        F.startswith(body, F.lit("```")) & F.endswith(body, F.lit("```")) & (F.length(body) >= 6)
    )


def unwrap_json(text: Column) -> Column:
    """Drop one fence around a JSON answer."""
    body = strip(text)
    inner = F.substring(body, F.lit(4), F.length(body) - 6)
    return F.when(has_outer_fence(text), strip(F.regexp_replace(inner, "^json", ""))).otherwise(body)


def requests_wrapper(prompt: Column) -> Column:
    """The prompt itself asks for a markdown wrapper."""
    lowered = F.lower(prompt)
    return F.contains(lowered, F.lit("markdown")) & (
        F.contains(prompt, F.lit("```")) | matches(lowered, fixed.WRAPPER_REQUEST)
    )


def distinct_notes(items: Column) -> Column:
    """Drop blank items and later repeats, comparing without case and outer space."""
    keyed = F.filter(
        F.transform(items, lambda item: F.struct(norm(item).alias("k"), item.alias("v"))),
        lambda e: e["k"] != "",
    )

    def keep_first(seen, entry):
        known = F.exists(seen, lambda s: s["k"] == entry["k"])
        return F.when(known, seen).otherwise(F.array_append(seen, entry))

    return F.aggregate(
        keyed,
        F.array().cast("array<struct<k:string,v:string>>"),
        keep_first,
        lambda seen: F.transform(seen, lambda e: e["v"]),
    )


def append_missing(items: Column, note: Column) -> Column:
    """Append ``note`` unless an item equals it without case and outer space."""
    known = F.exists(items, lambda item: norm(item) == norm(note))
    return F.when(known, items).otherwise(F.array_append(items, note))
