"""Programming-language profile of evidence texts."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.text import contains_any, extract_all, first, lookup, matches, strings


def _from_fence(text: Column) -> Column:
    known = F.transform(
        extract_all(text, fixed.FENCE_TAG), lambda tag: lookup(F.lower(tag), fixed.LANGUAGE_OF_FENCE)
    )
    return first(F.array_compact(known))


# what every text that matches a pattern contains, pattern by pattern: one phrase of each group
SYNTAX_HINTS = {
    "python": ["def (", "import"],
    "r": ["<- function (", "function ( )"],
    "java": ["public static (", "System.out.println ("],
    "typescript": ["function ( :", "const|let : =", "interface"],
    "javascript": ["import from '|\"", "function (", "console.log (", "const|let = ("],
    "cpp": ["#include < >", "std::"],
    "go": ["func (", "package"],
    "rust": ["fn (", "let mut"],
}
# the mention patterns in one, with their common word boundaries outside: hits where one of them does
ANY_MENTION = r"\b(?:%s)\b" % "|".join(
    word.removeprefix(r"\b").removesuffix(r"\b") for _, regex in fixed.LANGUAGE_MENTION for word in regex.split("|")
)


def _hinted(text: Column, hint: str) -> Column:
    return reduce(lambda a, b: a & b, [contains_any(text, group.split("|")) for group in hint.split()])


def _syntax(text: Column) -> Column:
    chain = F
    for language, patterns in fixed.LANGUAGE_SYNTAX:
        hits = [
            _hinted(text, hint) & matches(text, regex, flags)
            for hint, (flags, regex) in zip(SYNTAX_HINTS[language], patterns, strict=True)
        ]
        chain = chain.when(reduce(lambda a, b: a | b, hits), F.lit(language))
    return chain.otherwise(F.lit(None).cast("string"))


def _mention(text: Column) -> Column:
    """First language of the list that is mentioned; a text without any is passed over once."""
    chain = F.when(~matches(text, ANY_MENTION, "i"), F.lit(None).cast("string"))
    for language, regex in fixed.LANGUAGE_MENTION:
        chain = chain.when(matches(text, regex, "i"), F.lit(language))
    return chain


def primary_language(text: Column) -> Column:
    """Fence tag, else syntax family, else a mention by name, else ``unknown``."""
    return F.coalesce(
        F.when(F.contains(text, F.lit("```")), _from_fence(text)),
        _syntax(text),
        _mention(text),
        F.lit("unknown"),
    )


def evidence_text(evidence: Column) -> Column:
    fields = ["wrong_line", "correct_approach", "failed_test"]
    return F.concat_ws("\n", *[F.coalesce(evidence[f], F.lit("")) for f in fields])


def declared_languages(language: Column) -> Column:
    """Language constraint of a profile; Python, not specific, when nothing is known."""
    unknown = language == "unknown"
    return F.struct(
        F.when(unknown, strings(["python"])).otherwise(F.array(language)).alias("target_languages"),
        (~unknown).alias("language_specific"),
    )


def resolve_languages(declared: Column, inferred: Column) -> Column:
    """Keep the declared constraint unless it leaves out an inferred language."""
    open_default = (inferred["target_languages"] == strings(["python"])) & ~inferred["language_specific"]
    covered = (F.size(declared["target_languages"]) > 0) & (
        F.size(F.array_except(inferred["target_languages"], declared["target_languages"])) == 0
    )
    return F.when(open_default | covered, declared).otherwise(inferred)


def code_phrase(language: Column) -> Column:
    name = lookup(language, fixed.LANGUAGE_NAME)
    return F.when(name.isNotNull(), F.format_string(fixed.CODE_PHRASE, name)).otherwise(
        F.lit(fixed.PLAIN_CODE_PHRASE)
    )


def code_noun(language: Column) -> Column:
    name = lookup(language, fixed.LANGUAGE_NAME)
    return F.when(name.isNotNull(), F.concat(name, F.lit(" code"))).otherwise(F.lit("code"))
