"""Function names and public contract targets mentioned in texts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.text import (
    contains_any, extract_all, first, last, let, one_of, strings, strip,
)


def _all_groups(text: Column, patterns, flags: str = "") -> Column:
    return F.array_distinct(F.concat(*[extract_all(text, regex, flags) for regex in patterns]))


def function_names(text: Column, quoted: bool = True) -> Column:
    """Names defined, called or announced in a text, by kind of mention."""
    patterns = [p for p in fixed.NAME_PATTERNS if quoted or p != fixed.QUOTED_NAME_PATTERN]
    return F.array_except(_all_groups(text, patterns), strings(fixed.STOP_NAMES))


def entry_points(text: Column, errors: bool = True) -> Column:
    """Callables a text presents as entry points; ``errors`` also reads NameErrors."""
    patterns = [p for p in fixed.ENTRYPOINT_PATTERNS if errors or p != fixed.NAME_ERROR_PATTERN]
    return F.filter(
        _all_groups(text, patterns), lambda n: ~one_of(F.lower(n), fixed.ENTRYPOINT_STOP_WORDS)
    )


def evidence_entry_points(evidence: Column) -> Column:
    """Struct of the wrong callable and the target one named by an evidence row."""
    names = {
        field: function_names(F.coalesce(evidence[field], F.lit("")), quoted=False)
        for field in ["wrong_line", "correct_approach", "failed_test"]
    }
    return F.struct(
        F.coalesce(first(names["wrong_line"]), F.lit(fixed.FALLBACK_WRONG_NAME)).alias("wrong"),
        F.coalesce(
            last(names["correct_approach"]),
            last(names["failed_test"]),
            last(names["wrong_line"]),
            F.lit(fixed.FALLBACK_TARGET_NAME),
        ).alias("target"),
    )


def _dotted(text: Column) -> Column:
    return _all_groups(text, fixed.EXPECTED_DOTTED_PATTERNS, "i")


def _identifiers(text: Column) -> Column:
    return _all_groups(text, fixed.EXPECTED_IDENTIFIER_PATTERNS, "i")


def _target(kind: Column, name: Column) -> Column:
    return F.struct(kind.alias("kind"), name.alias("name"))


def contract_targets(text: Column) -> Column:
    """Public targets a text asks for: attributes, then identifiers, then callables."""
    lowered = F.lower(text)
    kind = (
        F.when(contains_any(lowered, fixed.METHOD_MARKERS), F.lit("method"))
        .when(contains_any(lowered, fixed.FUNCTION_MARKERS), F.lit("function"))
        .otherwise(F.lit("symbol"))
    )
    return F.array_distinct(
        F.concat(
            F.transform(_dotted(text), lambda n: _target(F.lit("attribute"), n)),
            F.transform(_identifiers(text), lambda n: _target(kind, n)),
            F.transform(entry_points(text), lambda n: _target(F.lit("function"), n)),
        )
    )


def first_targets(evidence: Column, items: Column) -> Column:
    """First target of each text (null without one): expected texts, items, then the wrong line."""
    field = lambda name: F.coalesce(evidence[name], F.lit(""))
    texts = F.concat(
        F.array(field("correct_approach"), field("failed_test")),
        F.transform(items, strip),
        F.array(field("wrong_line")),
    )
    return F.transform(texts, lambda text: first(contract_targets(text)))


def resolve_target(evidence: Column, items: Column) -> Column:
    """Target the evidence asks for, else the first one of the items, else the wrong line's."""
    return first(F.array_compact(first_targets(evidence, items)))


def target_phrase(target: Column) -> Column:
    return let(
        target,
        lambda t: F.when(
            t.isNotNull(), F.format_string(fixed.TARGET_FORMAT, t["kind"], t["name"])
        ).otherwise(F.lit(fixed.NO_TARGET)),
    )


def wrong_target_phrase(wrong_line: Column) -> Column:
    """What the wrong line exposes instead of the target."""
    text = F.coalesce(wrong_line, F.lit(""))

    def named(kind, names):
        return let(
            first(names),
            lambda name: F.when(
                name.isNotNull(), F.format_string(fixed.WRONG_TARGET_FORMAT, F.lit(kind), name)
            ),
        )

    fragment = F.substring(strip(text), 1, 80)
    return F.coalesce(
        named("attribute", _dotted(text)),
        named("function", entry_points(text)),
        named("symbol", _identifiers(text)),
        F.when(fragment != "", F.format_string(fixed.WRONG_SHAPE_FORMAT, fragment)),
        F.lit(fixed.NO_WRONG_TARGET),
    )


def ungrounded_names(spec_text: Column, evidence_text: Column) -> Column:
    """Names a spec text uses that its evidence does not, sorted."""
    allowed = F.concat(let(evidence_text, lambda t: function_names(t)), strings(fixed.UNGROUNDED_NAMES_ALLOWED))
    return F.array_sort(F.array_except(let(spec_text, lambda t: function_names(t)), allowed))
