"""What a spec must cover and avoid: signals, lint, templates."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.language import code_phrase
from weakspot.functions.names import entry_points, function_names
from weakspot.functions.text import (
    append_missing, contains_any, distinct_notes, first, last, let, lookup, one_of, strings, strip,
)


def note_text(notes: Column) -> Column:
    """Notes as the one text in which phrases are looked for."""
    return F.lower(F.array_join(notes, " "))


def signal_phrases(cover_text: Column, avoid_text: Column) -> dict[str, Column]:
    """First phrase found for each contract signal, null when there is none."""
    text = {"cover": cover_text, "avoid": avoid_text}
    return {
        name: F.coalesce(*[F.when(F.contains(text[side], F.lit(p)), F.lit(p)) for p in phrases])
        for name, side, phrases in fixed.CONTRACT_SIGNALS
    }


def has_tag(tags: Column, tag: str) -> Column:
    return F.array_contains(tags, F.lit(tag))


def missing_signals(tags: Column, signals: dict[str, Column]) -> Column:
    """Signals the tags require that are not there (a signal may be listed per tag)."""
    gaps = [
        F.when(has_tag(tags, tag) & signals[name].isNull(), F.lit(name))
        for tag, *names in fixed.REQUIRED_SIGNALS
        for name in names
    ]
    return F.array_compact(F.array(*gaps))


def lint_reason(tags: Column, signals: dict[str, Column], grounded: Column) -> Column:
    """First reason to reject a spec, null when it passes."""
    chain = F.when(~grounded, F.lit(fixed.UNGROUNDED_TRAP_REASON))
    pairs = {tag: names for tag, *names in fixed.REQUIRED_SIGNALS}
    for tag, reason in fixed.LINT_REASONS:
        requires, forbids = pairs[tag]
        broken = has_tag(tags, tag) & (signals[requires].isNull() | signals[forbids].isNull())
        chain = chain.when(broken, F.lit(reason))
    return chain


def retry_mode(reason: Column, modes, default: str) -> Column:
    lowered = F.lower(reason)
    chain = F
    for mode, phrases in modes:
        chain = chain.when(contains_any(lowered, phrases), F.lit(mode))
    return chain.otherwise(F.lit(default))


def _named_note(tag: str, name: Column) -> Column:
    """The cover note of a tag that mentions the entry point."""
    note = fixed.AUGMENTED_COVER[tag]
    generic = fixed.AUGMENTED_COVER_GENERIC.get(tag, note % fixed.GENERIC_ENTRYPOINT)
    return F.when(name.isNull(), F.lit(generic)).otherwise(F.format_string(note, name))


def augment_cover(tags: Column, cover: Column, cause: Column, cliff: Column) -> Column:
    """Add the note each tag calls for; names come from the notes so far."""

    def step(tag, note):
        def grow(notes):
            if "%s" not in note:
                grown = append_missing(notes, F.lit(note))
            else:
                text = F.concat_ws(" ", F.array_join(notes, " "), cause, cliff)
                grown = let(
                    last(let(text, lambda t: function_names(t))),
                    lambda name: let(_named_note(tag, name), lambda line: append_missing(notes, line)),
                )
            return F.when(has_tag(tags, tag), grown).otherwise(notes)
        return grow

    for tag, note in fixed.AUGMENTED_COVER.items():
        cover = let(cover, step(tag, note))
    return cover


def augment_avoid(tags: Column, avoid: Column) -> Column:
    def step(tag, note):
        return lambda notes: F.when(
            has_tag(tags, tag), append_missing(notes, F.lit(note))
        ).otherwise(notes)

    for tag, note in fixed.AUGMENTED_AVOID.items():
        avoid = let(avoid, step(tag, note))
    return avoid


def without_process_notes(items: Column) -> Column:
    def is_note(item):
        hit = F.lit(False)
        for prefix in fixed.PROCESS_NOTE_PREFIXES:
            hit = hit | F.startswith(F.lower(item), F.lit(prefix))
        return hit

    stripped = F.transform(items, strip)
    return distinct_notes(F.filter(stripped, lambda item: ~is_note(item)))


def entry_point(items: Column) -> Column:
    """Callable the notes and hints name first, by kind of mention."""
    return first(let(F.array_join(items, " "), lambda text: entry_points(text, errors=False)))


def names_entry_point(tags: Column) -> Column:
    """Tags whose contract names the entry point."""
    return one_of(first(tags), ["missing_code_block", "syntax_error"])


def target_contract(target: Column, side: int) -> Column:
    chain = F
    for kind, lines in fixed.TARGET_CONTRACT.items():
        line = lines[side]
        text = F.format_string(line, target["name"]) if "%s" in line else F.lit(line)
        chain = chain.when(target["kind"] == kind, text)
    return chain.otherwise(F.lit(fixed.NO_TARGET_CONTRACT[side]))


def normalized_contract(
    tags: Column, cover: Column, avoid: Column, name: Column, target: Column, language: Column
) -> Column:
    """Cover and avoid lists by tag, language, entry point and public target.

    Rows of another tag keep their own notes, minus the ones about the process.
    ``name`` and ``target`` are used in several branches: pass columns.
    """
    key = F.coalesce(first(tags), F.lit(""))
    phrase = code_phrase(language)

    solution = (
        F.when(name.isNull(), F.lit(fixed.SOLUTION_UNNAMED_COVER))
        .when(language == "java", F.format_string(fixed.SOLUTION_METHOD_COVER, name))
        .otherwise(F.format_string(fixed.SOLUTION_ENTRYPOINT_COVER, name))
    )
    complete = F.format_string(
        fixed.COMPLETE_CODE_COVER,
        F.when(language == "python", F.lit(fixed.PLAIN_CODE_PHRASE)).otherwise(phrase),
    )
    definition = F.when(name.isNotNull(), F.format_string(fixed.VALID_DEFINITION_COVER, name))
    malformed = (
        F.when(language == "java", F.lit(fixed.MALFORMED_AVOID_JAVA))
        .when(one_of(language, fixed.PUNCTUATED_LANGUAGES), F.lit(fixed.MALFORMED_AVOID_PUNCTUATED))
        .otherwise(F.lit(fixed.MALFORMED_AVOID))
    )
    by_tag = {
        "function_name_mismatch": (
            F.array(target_contract(target, 0)), F.array(target_contract(target, 1))),
        "missing_code_block": (
            F.array(F.format_string(fixed.CODE_OUTPUT_COVER, phrase), solution),
            strings([fixed.NO_EXPLANATION_AVOID])),
        "markdown_formatting": tuple(strings([line]) for line in fixed.RAW_OUTPUT_CONTRACT),
        "syntax_error": (F.array_compact(F.array(complete, definition)), F.array(malformed)),
        "logic_error": tuple(strings([line]) for line in fixed.LOGIC_CONTRACT),
        "non_executable_code": tuple(strings([line]) for line in fixed.RUNNABLE_CONTRACT),
    }
    chains = []
    for side, own in enumerate([cover, avoid]):
        chain = F
        for tag, lists in by_tag.items():
            chain = chain.when(key == tag, lists[side])
        chains.append(chain.otherwise(without_process_notes(own)))
    return F.struct(chains[0].alias("cover"), chains[1].alias("avoid"))


def algorithm(fault_type: Column) -> Column:
    return lookup(fault_type, fixed.ALGORITHM_OF_FAULT, fixed.DEFAULT_ALGORITHM)


def limits_struct(n_range: Column, value_range: Column, time: Column, memory: Column) -> Column:
    return F.struct(
        n_range.alias("n_range"), value_range.alias("value_range"),
        time.alias("time_limit"), memory.alias("memory_limit"),
    )


def limits(values) -> Column:
    n_range, value_range, time, memory = values
    longs = lambda pair: F.array(*[F.lit(v).cast("bigint") for v in pair])
    return limits_struct(longs(n_range), longs(value_range), F.lit(time), F.lit(memory))


def limits_of_scale(scale: Column) -> Column:
    chain = F
    for name, values in fixed.LIMITS_OF_SCALE.items():
        chain = chain.when(scale == name, limits(values))
    return chain.otherwise(limits(fixed.LIMITS_OF_SCALE[fixed.DEFAULT_SCALE]))
