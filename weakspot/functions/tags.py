"""Tag vocabularies: normalisation, canonical names, failure tests."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.text import first, let, lookup, norm, one_of, strings, strip


def clean_tag(tag: Column) -> Column:
    return F.translate(norm(tag), "- ", "__")


def diagnosis_tag(tag: Column) -> Column:
    return lookup(tag, fixed.DIAGNOSIS_TAG_ALIASES, tag)


def report_tag(tag: Column) -> Column:
    """One of the six canonical tags; anything unknown is a logic error."""
    known = lookup(strip(tag), fixed.REPORT_TAG_ALIASES, strip(tag))
    return F.when(one_of(known, fixed.CANONICAL_TAGS), known).otherwise(F.lit("logic_error"))


def primary_tags(tags: Column) -> Column:
    """Tags of a diagnosis: the first failure tag, else all success tags, else unknown."""
    cleaned = F.filter(F.transform(tags, clean_tag), lambda t: t != "")
    return let(
        F.array_distinct(F.transform(cleaned, diagnosis_tag)),
        lambda known: let(
            F.filter(known, lambda t: ~one_of(t, fixed.SUCCESS_TAGS)),
            lambda failing: F.when(F.size(failing) > 0, F.slice(failing, 1, 1))
            .when(F.size(known) > 0, known)
            .otherwise(strings(["unknown"])),
        ),
    )


def only_success(tags: Column) -> Column:
    return (F.size(tags) > 0) & F.forall(tags, lambda t: one_of(t, fixed.SUCCESS_TAGS))


def taxonomy_error(source: Column, tags: Column) -> Column:
    """Null when the tags stay inside the allowed sets, else what is wrong."""
    outside = F.filter(
        tags, lambda t: ~one_of(t, fixed.CANONICAL_TAGS) & ~one_of(t, fixed.SUCCESS_TAGS)
    )
    listed = F.concat(
        F.lit("["),
        F.array_join(F.transform(outside, lambda t: F.concat(F.lit("'"), t, F.lit("'"))), ", "),
        F.lit("]"),
    )
    return (
        F.when(source == "non_failure", F.lit(None).cast("string"))
        .when(F.size(tags) == 0, F.lit("Diagnosis must include at least one sub_tag."))
        .when(
            ~one_of(first(tags), fixed.CANONICAL_TAGS),
            F.format_string("Primary sub_tag '%s' is outside the allowed taxonomy.", first(tags)),
        )
        .when(
            F.size(outside) > 0,
            F.concat(F.lit("Sub_tags "), listed, F.lit(" are outside the allowed taxonomy.")),
        )
    )


def label_value(labels: Column, name: str) -> Column:
    """Value under ``name``, comparing names without case and outer space; the last one wins."""
    hits = F.filter(F.map_entries(labels), lambda e: norm(e["key"]) == name)
    return F.try_element_at(hits, F.lit(-1))["value"]


def is_failure(source: Column, tags: Column, labels: Column, evidence: Column) -> Column:
    """Ordered failure test of a diagnosis row."""
    normalized = F.transform(tags, norm)
    absent = lambda field: F.upper(strip(evidence[field])) == "N/A"
    labelled = lambda name, value: F.coalesce(
        norm(label_value(labels, name)) == value, F.lit(False)
    )
    return (
        F.when(source == "non_failure", F.lit(False))
        .when(F.exists(normalized, lambda t: ~one_of(t, fixed.SUCCESS_TAGS)), F.lit(True))
        .when(F.size(tags) > 0, F.lit(False))
        .when(labelled("status", "correct_solution"), F.lit(False))
        .when(labelled("test_result", "pass"), F.lit(False))
        .when(labelled("functional_correctness", "true"), F.lit(False))
        .when(absent("wrong_line") & absent("failed_test"), F.lit(False))
        .otherwise(F.lit(True))
    )


def mapped_tags(tags: Column, tag_map: Column) -> Column:
    """Report tags of a row through a tag map (a map column), first ones kept."""
    named = F.transform(tags, lambda t: report_tag(F.coalesce(F.try_element_at(tag_map, t), t)))
    return F.when(F.size(tags) == 0, strings(["unknown"])).otherwise(F.array_distinct(named))
