"""Cleaning of analyzer answers kept as JSON text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.contracts import limits_struct
from weakspot.functions.text import extract_all, let, matches, norm, strings, strip, unwrap_json
from weakspot.schemas import HINTS, LANGUAGE, LIMITS, RESPONSE, VERIFICATION


def parsed(raw: Column) -> Column:
    """Variant of an answer, null when it is not JSON."""
    return F.try_parse_json(unwrap_json(raw))


def field(answer: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(answer, f"$.{name}", kind)


def kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def _is(value: Column, name: str) -> Column:
    return F.startswith(kind(value), F.lit(name))


def item_text(value: Column) -> Column:
    """Text of a list item, booleans and nulls capitalised as the answers' producers print them."""
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(_is(value, "BOOLEAN"), F.initcap(text))
        .when(_is(value, "VOID"), F.lit("None"))
        .otherwise(text)
    )


def text_or_empty(value: Column) -> Column:
    """Text of a field, empty when the key is missing."""
    return F.when(value.isNull(), F.lit("")).otherwise(item_text(value))


def string_list(value: Column) -> Column:
    """A list, or text with delimiters, as stripped non-blank strings."""
    items = F.transform(F.try_variant_get(value, "$", "array<variant>"), item_text)
    parts = F.split(F.try_variant_get(value, "$", "string"), fixed.LIST_DELIMITERS)
    raw = (
        F.when(_is(value, "ARRAY"), items)
        .when(_is(value, "STRING"), parts)
        .otherwise(strings([]))
    )
    return F.filter(F.transform(raw, strip), lambda s: s != "")


def _search(text: Column, regex: str, flags: str = "") -> Column:
    """First group of the first hit, null without one."""
    return F.when(
        matches(text, regex, flags), F.regexp_extract(text, f"(?{flags}dU){regex}", 1)
    )


def parse_limits(text: Column) -> Column:
    """Ranges and limits read from free text."""
    n_default, value_default, time_default, memory_default = fixed.PARSED_LIMIT_DEFAULTS
    longs = lambda pair: F.array(*[F.lit(v).cast("bigint") for v in pair])
    numbers = extract_all(text, r"\d+", group=0).cast("array<bigint>")
    time = _search(text, fixed.TIME_LIMIT_PATTERN, "i")
    memory = _search(text, fixed.MEMORY_LIMIT_PATTERN, "i")
    return limits_struct(
        F.when(F.size(numbers) >= 2, F.slice(numbers, 1, 2)).otherwise(longs(n_default)),
        F.when(F.size(numbers) >= 4, F.slice(numbers, 3, 2)).otherwise(longs(value_default)),
        F.coalesce(F.replace(time, F.lit(" "), F.lit("")), F.lit(time_default)),
        F.coalesce(F.upper(F.replace(memory, F.lit(" "), F.lit(""))), F.lit(memory_default)),
    )


def parse_verification(text: Column) -> Column:
    lowered = F.lower(text)
    edge = strip(_search(text, fixed.EDGE_CASE_PATTERN, "i"))
    return F.struct(
        F.coalesce(_search(text, fixed.MIN_TESTS_PATTERN, "i").cast("int"), F.lit(4)).alias("min_test_cases"),
        F.when(F.coalesce(edge, F.lit("")) != "", F.array(edge))
        .otherwise(strings([])).alias("must_include_edge_cases"),
        (F.contains(lowered, F.lit("yes")) | F.contains(lowered, F.lit("true"))).alias("brute_force_verifiable"),
        F.coalesce(_search(text, fixed.COMPLEXITY_PATTERN), F.lit(fixed.BRUTE_FORCE_LIMIT))
        .alias("brute_force_complexity_limit"),
    )


def parse_hints(text: Column) -> Column:
    """Labelled segments of a hint text; the whole text where a label is missing."""
    parts = []
    for label, name in zip(
        fixed.HINT_LABELS, ["solution_approach", "common_wrong_approach", "distinguishing_test"]
    ):
        segment = strip(_search(text, fixed.HINT_SEGMENT_FORMAT % label, "is"))
        parts.append(F.coalesce(F.nullif(segment, F.lit("")), strip(text)).alias(name))
    return F.struct(*parts)


def parse_languages(text: Column) -> Column:
    lowered = F.lower(text)
    named = F.array_compact(
        F.array(*[
            F.when(matches(lowered, regex), F.lit(language))
            for language, regex in fixed.CONSTRAINT_MENTION
        ])
    )
    return let(
        named,
        lambda n: F.struct(
            F.when(F.size(n) > 0, n).otherwise(strings(["python"])).alias("target_languages"),
            (F.size(n) == 1).alias("language_specific"),
        ),
    )


def _object_or_text(value: Column, ddl: str, parse) -> Column:
    return (
        F.when(_is(value, "OBJECT"), F.try_variant_get(value, "$", ddl))
        .when(_is(value, "STRING"), parse(F.try_variant_get(value, "$", "string")))
    )


def clean_response(answer: Column) -> Column:
    """Typed spec answer from a variant; parts that cannot be read are null."""
    text = lambda name: F.when(
        _is(field(answer, name), "STRING"), field(answer, name, "string")
    ).alias(name)
    return F.struct(
        text("algorithm_type"),
        text("difficulty"),
        text("narrative_theme"),
        _object_or_text(field(answer, "constraints"), LIMITS, parse_limits).alias("constraints"),
        text("key_trap"),
        string_list(field(answer, "must_cover")).alias("must_cover"),
        string_list(field(answer, "must_avoid")).alias("must_avoid"),
        _object_or_text(field(answer, "verification_spec"), VERIFICATION, parse_verification)
        .alias("verification_spec"),
        _object_or_text(field(answer, "generation_hints"), HINTS, parse_hints).alias("generation_hints"),
        _object_or_text(field(answer, "language_constraint"), LANGUAGE, parse_languages)
        .alias("language_constraint"),
    ).cast(RESPONSE)


def response_gaps(response: Column) -> Column:
    """Fields of a cleaned answer that break its schema."""
    required = [
        "algorithm_type", "difficulty", "narrative_theme", "key_trap",
        "constraints.time_limit", "constraints.memory_limit",
        "verification_spec.min_test_cases", "verification_spec.must_include_edge_cases",
        "verification_spec.brute_force_verifiable", "verification_spec.brute_force_complexity_limit",
        "generation_hints.solution_approach", "generation_hints.common_wrong_approach",
        "generation_hints.distinguishing_test",
        "language_constraint.target_languages", "language_constraint.language_specific",
    ]

    def at(path):
        column = response
        for part in path.split("."):
            column = column[part]
        return column

    gaps = [F.when(at(path).isNull(), F.lit(path)) for path in required]
    for name in ["n_range", "value_range"]:
        pair = response["constraints"][name]
        bad = pair.isNull() | (F.size(pair) != 2) | F.exists(pair, lambda v: v.isNull())
        gaps.append(F.when(bad, F.lit(f"constraints.{name}")))
    gaps.append(
        F.when(response["verification_spec"]["min_test_cases"] <= 0, F.lit("verification_spec.min_test_cases"))
    )
    return F.array_compact(F.array(*gaps))


def int_list(value: Column) -> Column:
    """Items of a list that read as integers, the others dropped."""

    def as_int(item):
        text = F.try_variant_get(item, "$", "string")
        return (
            F.when(_is(item, "BOOLEAN"), F.try_variant_get(item, "$", "boolean").cast("bigint"))
            .when(
                _is(item, "STRING"),
                F.when(
                    matches(strip(text), r"^[+-]?\d+(_\d+)*$"),
                    F.replace(strip(text), F.lit("_"), F.lit("")).try_cast("bigint"),
                ),
            )
            .when(_is(item, "BIGINT"), F.try_variant_get(item, "$", "bigint"))
            .when(
                _is(item, "DECIMAL") | _is(item, "DOUBLE"),
                F.try_variant_get(item, "$", "double").try_cast("bigint"),
            )
        )

    whole = F.transform(F.try_variant_get(value, "$", "array<variant>"), as_int)
    return F.coalesce(F.array_compact(whole), F.array().cast("array<bigint>"))


def as_bool(value: Column) -> Column:
    """Booleans, the words for true, and non-zero numbers."""
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(_is(value, "BOOLEAN"), F.try_variant_get(value, "$", "boolean"))
        .when(_is(value, "STRING"), norm(text).isin("true", "1", "yes"))
        .when(_is(value, "VOID"), F.lit(False))
        .otherwise(F.coalesce(F.try_variant_get(value, "$", "double") != 0, text.isNotNull()))
    )


def clean_collective(answer: Column) -> Column:
    """Typed cluster answer from a variant."""
    corrections = F.try_variant_get(field(answer, "misdiagnosis_corrections"), "$", "map<string,variant>")
    merges = F.filter(
        F.coalesce(
            F.try_variant_get(field(answer, "semantic_merges"), "$", "array<variant>"),
            F.array().cast("array<variant>"),
        ),
        lambda m: _is(m, "OBJECT"),
    )
    return F.struct(
        field(answer, "refined_root_cause", "string").alias("refined_root_cause"),
        field(answer, "capability_cliff", "string").alias("capability_cliff"),
        int_list(field(answer, "misdiagnosed_ids")).alias("misdiagnosed_ids"),
        F.coalesce(
            F.transform_values(corrections, lambda _, v: item_text(v)),
            F.create_map().cast("map<string,string>"),
        ).alias("misdiagnosis_corrections"),
        F.coalesce(field(answer, "cluster_coherence", "double"), F.lit(0.0)).alias("cluster_coherence"),
        F.transform(
            merges,
            lambda m: F.struct(
                text_or_empty(field(m, "source_tag")).alias("source_tag"),
                text_or_empty(field(m, "target_tag")).alias("target_tag"),
                F.coalesce(as_bool(field(m, "confirmed")), F.lit(False)).alias("confirmed"),
            ),
        ).alias("semantic_merges"),
    )


def collective_gap(raw: Column, cleaned: Column) -> Column:
    """Why a cluster answer cannot be used, null when it can."""
    return (
        F.when(parsed(raw).isNull(), F.lit("answer is not JSON"))
        .when(cleaned["refined_root_cause"].isNull(), F.lit("refined_root_cause is missing"))
        .when(cleaned["capability_cliff"].isNull(), F.lit("capability_cliff is missing"))
        .when(~cleaned["cluster_coherence"].between(0.0, 1.0), F.lit("cluster_coherence is outside 0..1"))
    )
