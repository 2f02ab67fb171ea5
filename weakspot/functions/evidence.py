"""Grounding of spec texts in the evidence they were made from."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.text import contains_any, extract_all, let, lookup, norm, one_of, strip

# what ends a line of a multi-line answer
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def _mentions(candidate: Column, spans: Column) -> Column:
    wanted = F.filter(F.transform(spans, norm), lambda s: s != "")
    return F.exists(wanted, lambda s: F.contains(candidate, s))


def _identifiers(evidence: Column) -> Column:
    words = F.filter(extract_all(evidence, fixed.IDENTIFIER, group=0), lambda w: F.contains(w, F.lit("_")))
    names = F.transform(F.concat(extract_all(evidence, fixed.DEFINED_NAME), words), F.lower)
    return F.filter(
        names,
        lambda n: (F.length(n) >= 4) & ~one_of(n, fixed.GROUNDING_IDENTIFIER_EXCEPTIONS),
    )


def _shares_phrase(candidate: Column, evidence: Column) -> Column:
    lowered = F.lower(evidence)
    shared = F.lit(False)
    for phrase in fixed.GROUNDING_PHRASES:
        shared = shared | (F.contains(lowered, F.lit(phrase)) & F.contains(candidate, F.lit(phrase)))
    paraphrased = (
        F.contains(lowered, F.lit(fixed.MISSING_BLOCK_PHRASE))
        & contains_any(candidate, fixed.MISSING_BLOCK_CAUSES)
        & contains_any(candidate, fixed.MISSING_BLOCK_TARGETS)
    )
    return shared | paraphrased


def _shares_token(candidate: Column, evidence: Column) -> Column:
    words = F.filter(
        extract_all(F.lower(evidence), fixed.EVIDENCE_TOKEN, group=0),
        lambda w: ~one_of(w, fixed.GROUNDING_STOP_WORDS),
    )
    return F.exists(words, lambda w: F.contains(candidate, w))


def is_grounded(text: Column, wrong_line: Column, correct_approach: Column) -> Column:
    """The text refers to something concrete in the evidence."""
    candidate = F.lower(text)
    wrong = F.coalesce(wrong_line, F.lit(""))
    correct = F.coalesce(correct_approach, F.lit(""))
    return (
        _mentions(candidate, extract_all(wrong, fixed.QUOTED_SPAN))
        | _mentions(candidate, extract_all(correct, fixed.QUOTED_SPAN))
        | F.exists(_identifiers(wrong), lambda n: F.contains(candidate, n))
        | _shares_phrase(candidate, wrong)
        | _mentions(candidate, extract_all(wrong, fixed.RETURN_EXPRESSION))
        | (_shares_token(candidate, wrong) & _shares_token(candidate, correct))
    )


def summary(key: Column, evidence: Column) -> Column:
    """Fixed summary of a weakness; logic errors are told apart by their evidence."""
    fields = ["wrong_line", "correct_approach", "failed_test"]
    text = F.lower(F.concat_ws(" ", *[F.coalesce(evidence[f], F.lit("")) for f in fields]))
    logic = F
    for phrases, line in fixed.LOGIC_SUMMARY:
        logic = logic.when(contains_any(text, phrases), F.lit(line))
    return (
        F.when(key == "logic_error", logic.otherwise(F.lit(fixed.DEFAULT_SUMMARY)))
        .otherwise(lookup(key, fixed.TAG_SUMMARY, fixed.DEFAULT_SUMMARY))
    )


def reference_line(wrong_line: Column) -> Column:
    """First line of the wrong output that is not a fence, without backticks, cut short."""
    text = F.coalesce(wrong_line, F.lit(""))
    lines = F.filter(
        F.split(text, LINE_ENDS),
        lambda line: ~F.startswith(strip(line), F.lit("```")),
    )
    bare = F.filter(
        F.transform(lines, lambda line: strip(F.trim(line, F.lit("` ")))), lambda line: line != ""
    )
    size = fixed.FALLBACK_REFERENCE_CHARS
    return let(
        F.try_element_at(bare, F.lit(1)),
        lambda found: F.when(found.isNotNull(), F.substring(found, 1, size))
        .when(text != "", F.substring(text, 1, size))
        .otherwise(F.lit(fixed.FALLBACK_REFERENCE)),
    )
