"""Spec rows from slots: default and fallback answers, assembly, lint."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions import contracts as ct
from weakspot.functions import language as lg
from weakspot.functions import names as nm
from weakspot.functions.evidence import is_grounded, reference_line, summary
from weakspot.functions.responses import response_gaps
from weakspot.functions.text import distinct_notes, first, lookup, one_of, pinned, strings, strip
from weakspot.schemas import RESPONSE, SPEC


def synthesis_view(slots: DataFrame) -> DataFrame:
    """Slots with the language and the summary of their evidence."""
    texts = slots.withColumn("_text", lg.evidence_text(F.col("evidence")))
    found = pinned(texts, "primary_language", lg.primary_language(F.col("_text"))).drop("_text")
    return found.withColumns(
        {
            "canonical_summary": summary(F.col("key"), F.col("evidence")),
            "inferred_languages": lg.declared_languages(F.col("primary_language")),
        }
    )


def _verification(cases: Column, edge: Column) -> Column:
    return F.struct(
        cases.cast("int").alias("min_test_cases"),
        F.array(edge).alias("must_include_edge_cases"),
        F.lit(True).alias("brute_force_verifiable"),
        F.lit(fixed.BRUTE_FORCE_LIMIT).alias("brute_force_complexity_limit"),
    )


def _hints(solution: Column, wrong: Column, test: Column) -> Column:
    return F.struct(
        solution.alias("solution_approach"), wrong.alias("common_wrong_approach"),
        test.alias("distinguishing_test"),
    )


def default_answer() -> Column:
    """Deterministic answer for a slot of the synthesis view (columns ``evidence``, ``notes``)."""
    wrong, correct, test = (
        F.col(f"evidence.{name}") for name in ["wrong_line", "correct_approach", "failed_test"]
    )
    return F.struct(
        ct.algorithm(F.col("fault_type")).alias("algorithm_type"),
        F.col("difficulty").alias("difficulty"),
        F.col("diversity_tags.narrative_theme").alias("narrative_theme"),
        ct.limits_of_scale(F.col("diversity_tags.constraint_scale")).alias("constraints"),
        F.format_string(fixed.TRAP_FORMAT, wrong).alias("key_trap"),
        F.array(F.col("key"), correct).alias("must_cover"),
        F.concat(strings([fixed.REUSE_NOTE]), F.col("notes")).alias("must_avoid"),
        _verification(lookup(F.col("difficulty"), fixed.TEST_CASES_OF_DIFFICULTY), test)
        .alias("verification_spec"),
        _hints(correct, wrong, test).alias("generation_hints"),
        F.col("inferred_languages").alias("language_constraint"),
    ).cast(RESPONSE)


def _fallback_parts(key: str, language: Column) -> dict:
    """Text parts of a tag's fallback as columns."""
    text = fixed.FALLBACK_TEXT[key]
    java = language == "java"

    def worded(name, *args):
        def say(form):
            return F.format_string(form, *args) if args and "%s" in form else F.lit(form)
        own = say(text[name])
        return F.when(java, say(text[f"{name}_java"])).otherwise(own) if f"{name}_java" in text else own

    def listed(name, *args):
        def say(forms):
            return F.array(*[F.format_string(f, *args) if "%s" in f else F.lit(f) for f in forms])
        chain = F.when(F.lit(False), say(text[name]))
        if f"{name}_java" in text:
            chain = chain.when(java, say(text[f"{name}_java"]))
        if f"{name}_punctuated" in text:
            chain = chain.when(one_of(language, fixed.PUNCTUATED_LANGUAGES), say(text[f"{name}_punctuated"]))
        return chain.otherwise(say(text[name]))

    points = F.col("_points")
    wrong, target, reference = points["wrong"], points["target"], F.col("_reference")
    if key == "function_name_mismatch":
        return {
            "trap": worded("trap", wrong, target), "cover": listed("cover", target),
            "avoid": listed("avoid", wrong), "solution": worded("solution", target),
            "wrong": worded("wrong", wrong, target), "test": worded("test", target),
        }
    if key == "markdown_formatting":
        noun = lg.code_noun(language)
        return {
            "trap": worded("trap", reference, noun), "cover": listed("cover", noun),
            "avoid": listed("avoid"), "solution": worded("solution", noun),
            "wrong": worded("wrong"), "test": worded("test"),
        }
    if key == "missing_code_block":
        clause = F.when(target == fixed.FALLBACK_TARGET_NAME, F.lit(text["unnamed_entrypoint"])).otherwise(
            worded("entrypoint", target)
        )
        return {
            "trap": worded("trap", clause), "cover": listed("cover", clause), "avoid": listed("avoid"),
            "solution": worded("solution", clause), "wrong": worded("wrong"), "test": worded("test", clause),
        }
    if key == "syntax_error":
        return {
            "trap": worded("trap", reference), "cover": listed("cover"), "avoid": listed("avoid"),
            "solution": worded("solution"), "wrong": worded("wrong", reference), "test": worded("test"),
        }
    return {
        "trap": worded("trap"), "cover": listed("cover"), "avoid": listed("avoid"),
        "solution": worded("solution"), "wrong": worded("wrong"), "test": worded("test"),
    }


def with_fallback_answer(view: DataFrame) -> DataFrame:
    """Template answer for the five tags that have one, null for others."""
    language = F.col("inferred_languages.target_languages")[0]
    df = view.withColumns(
        {
            "_points": nm.evidence_entry_points(F.col("evidence")),
            "_reference": reference_line(F.col("evidence.wrong_line")),
        }
    )
    chain = F
    for key in fixed.FALLBACK_TEXT:
        part = _fallback_parts(key, language)
        answer = F.struct(
            F.lit(fixed.FALLBACK_ALGORITHM).alias("algorithm_type"),
            F.col("difficulty").alias("difficulty"),
            F.col("diversity_tags.narrative_theme").alias("narrative_theme"),
            ct.limits(fixed.FALLBACK_LIMITS).alias("constraints"),
            part["trap"].alias("key_trap"),
            part["cover"].alias("must_cover"),
            part["avoid"].alias("must_avoid"),
            _verification(F.lit(fixed.FALLBACK_TEST_CASES), F.lit(fixed.FALLBACK_EDGE_CASE))
            .alias("verification_spec"),
            _hints(part["solution"], part["wrong"], part["test"]).alias("generation_hints"),
            F.col("inferred_languages").alias("language_constraint"),
        ).cast(RESPONSE)
        chain = chain.when(F.col("key") == key, answer)
    return df.withColumn("answer", chain.otherwise(F.lit(None).cast(RESPONSE))).drop("_points", "_reference")


def assembled(answered: DataFrame) -> DataFrame:
    """Spec columns from cleaned answers, with ``error`` where an answer cannot be used.

    Needs the synthesis view with ``answer``, ``notes`` and ``diversity_tags``.
    """
    answer = F.col("answer")
    tags = F.col("sub_tags")
    cause = F.col("collective_diagnosis.refined_root_cause")
    cliff = F.col("collective_diagnosis.capability_cliff")
    mismatch = ct.has_tag(tags, "function_name_mismatch")
    hint = lambda name: F.col(f"answer.generation_hints.{name}")
    context = [F.col("answer.key_trap")] + [
        hint(n) for n in ["solution_approach", "common_wrong_approach", "distinguishing_test"]
    ]
    df = answered.withColumns(
        {
            "_gaps": response_gaps(answer),
            "_languages": lg.resolve_languages(answer["language_constraint"], F.col("inferred_languages")),
            "_cover": distinct_notes(ct.augment_cover(tags, answer["must_cover"], cause, cliff)),
            "_avoid": distinct_notes(ct.augment_avoid(tags, answer["must_avoid"])),
            "_grounded": is_grounded(
                answer["key_trap"], F.col("evidence.wrong_line"), F.col("evidence.correct_approach")
            ),
        }
    )
    own_words = [F.col("answer.key_trap"), F.array_join("_cover", " "), F.array_join("_avoid", " "), *context[1:]]
    evidence_words = [F.col(f"evidence.{n}") for n in ["wrong_line", "correct_approach", "failed_test"]]
    named = F.concat("_cover", F.array(*context))
    df = df.withColumns(
        {
            "_strange": F.when(
                mismatch, nm.ungrounded_names(F.concat_ws(" ", *own_words), F.concat_ws(" ", *evidence_words))
            ).otherwise(strings([])),
            "_name": F.when(
                ct.names_entry_point(tags), ct.entry_point(F.concat(named, F.array(cause, cliff)))
            ),
            "_targets": F.when(
                mismatch, nm.first_targets(F.col("evidence"), F.concat(named, F.array(cause, cliff)))
            ),
            "_unwanted": nm.wrong_target_phrase(F.col("evidence.wrong_line")),
            "_all_avoid": distinct_notes(F.concat("_avoid", "notes")),
        }
    )
    # the narrative is told without the cause and the cliff, the last two items
    told_from = F.concat(F.slice("_targets", F.lit(1), F.size("_targets") - 3), F.slice("_targets", -1, 1))
    df = df.withColumns(
        {
            "_target": first(F.array_compact("_targets")),
            "_wanted": nm.target_phrase(first(F.array_compact(told_from))),
        }
    )
    quoted = F.array_join(F.transform("_strange", lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", ")
    error = (
        F.when(answer.isNull() | (F.size("_gaps") > 0), F.lit(fixed.ERROR_RESPONSE_SCHEMA))
        .when(~F.col("_grounded"), F.lit(fixed.ERROR_UNGROUNDED_TRAP))
        .when(F.size("_strange") > 0, F.format_string(fixed.ERROR_UNGROUNDED_NAMES_FORMAT, quoted))
    )
    contract = ct.normalized_contract(
        tags, F.col("_cover"), F.col("_all_avoid"), F.col("_name"), F.col("_target"),
        F.col("_languages.target_languages")[0],
    )
    trap = strip(F.format_string(fixed.NARRATIVE_TRAP_FORMAT, strip(answer["key_trap"]), F.col("_wanted"), F.col("_unwanted")))
    told = F.struct(
        *[F.format_string(form, F.col("_wanted")).alias(name) for name, form in fixed.NARRATIVE_HINT_FORMATS.items()]
    )
    df = df.withColumn("error", error).withColumn("_contract", contract)
    return df.withColumns(
        {
            "target_weakness": F.struct(
                "fault_type", "sub_tags", F.col("key").alias("root_cause"),
                F.col("canonical_summary").alias("capability_cliff"),
            ),
            "problem_spec": F.struct(
                F.col("answer.algorithm_type").alias("algorithm_type"),
                F.coalesce("difficulty", "answer.difficulty").alias("difficulty"),
                F.col("diversity_tags.narrative_theme").alias("narrative_theme"),
                F.col("answer.constraints").alias("constraints"),
                F.when(mismatch, trap).otherwise(answer["key_trap"]).alias("key_trap"),
                F.col("_contract.cover").alias("must_cover"),
                F.col("_contract.avoid").alias("must_avoid"),
            ),
            "verification_spec": F.col("answer.verification_spec"),
            "generation_hints": F.when(mismatch, told).otherwise(answer["generation_hints"]),
            "language_constraint": F.col("_languages"),
            "prompt_version": F.lit(fixed.SPEC_VERSION),
        }
    ).drop(
        "_gaps", "_languages", "_cover", "_avoid", "_grounded", "_contract", "_strange", "_name", "_target",
        "_wanted", "_unwanted", "_all_avoid", "_targets",
    )


def linted(specs: DataFrame) -> DataFrame:
    """Specs with ``accepted``, ``reason`` and ``missing_contracts`` of the local checks."""
    tags = F.col("target_weakness.sub_tags")
    texts = specs.withColumns(
        {
            "_cover_text": ct.note_text(F.col("problem_spec.must_cover")),
            "_avoid_text": ct.note_text(F.col("problem_spec.must_avoid")),
        }
    )
    found = F.struct(*[c.alias(n) for n, c in ct.signal_phrases(F.col("_cover_text"), F.col("_avoid_text")).items()])
    specs = texts.withColumn("_signals", found).drop("_cover_text", "_avoid_text")
    signals = {name: F.col(f"_signals.{name}") for name, _, _ in fixed.CONTRACT_SIGNALS}
    grounded = is_grounded(
        F.col("problem_spec.key_trap"), F.col("evidence.wrong_line"), F.col("evidence.correct_approach")
    )
    rejected = ct.lint_reason(tags, signals, grounded)
    return (
        specs.withColumn("_reason", rejected)
        .withColumn(
            "missing_contracts",
            F.when(
                F.col("_reason").isNotNull() & (F.col("_reason") != fixed.UNGROUNDED_TRAP_REASON),
                ct.missing_signals(tags, signals),
            ).otherwise(strings([])),
        )
        .withColumn("accepted", F.col("_reason").isNull())
        .withColumn("reason", F.coalesce("_reason", F.lit(fixed.LINT_ACCEPTED_REASON)))
        .drop("_reason", "_signals")
    )


def without_extra_syntax_notes(fallbacks: DataFrame) -> DataFrame:
    """Fallbacks for syntax errors outside Python list their own avoid notes and the duplicates."""
    language = F.col("language_constraint.target_languages")[0]
    own = fixed.FALLBACK_TEXT["syntax_error"]
    listed = (
        F.when(language == "java", strings(own["avoid_java"]))
        .when(one_of(language, fixed.PUNCTUATED_LANGUAGES), strings(own["avoid_punctuated"]))
        .otherwise(strings(own["avoid"]))
    )
    rewritten = F.col("problem_spec").withField("must_avoid", F.concat(listed, F.col("notes")))
    return fallbacks.withColumn(
        "problem_spec",
        F.when((F.col("key") == "syntax_error") & (language != "python"), rewritten)
        .otherwise(F.col("problem_spec")),
    )


def numbered(accepted: DataFrame, span: int = 4096) -> DataFrame:
    """Number the accepted slots densely in slot order.

    Rows are numbered within spans of ranks; only one count per span is put in order
    as a whole.
    """
    parts = accepted.withColumn("_span", F.floor(F.col("rank") / span))
    sizes = parts.groupBy("_span").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_span", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_span").orderBy("rank", "slot")) + F.col("_before")
    return parts.join(offsets, "_span").withColumn("spec_id", F.format_string("spec-%04d", place)).drop("_span", "_before")


def spec_rows(df: DataFrame) -> DataFrame:
    return df.select(*SPEC.fieldNames()).to(SPEC)


def spec_key(specs: DataFrame) -> Column:
    return F.coalesce(first(specs["target_weakness.sub_tags"]), F.lit("unknown"))
