"""Synthesize stage."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.operators import diversity as dv
from weakspot.operators import regenerate as rg
from weakspot.operators import slots as sl
from weakspot.operators import specs as sp
from weakspot.plans.aggregate import Report
from weakspot.sources.artifacts import written


class Settings(NamedTuple):
    specs_per_weakness: int = 3
    max_per_weakness: int = 8
    top_n: int = 10
    difficulty_distribution: str = "balanced"
    overlap_threshold: float = 0.5
    max_regeneration_attempts: int = 2
    generic_themes: tuple = ()
    domain_adaptive: bool = True
    data_structures: tuple = tuple(fixed.DATA_STRUCTURES)


class Synthesis(NamedTuple):
    specs: DataFrame
    events: DataFrame
    slots: DataFrame


def allocated(report: Report, settings: Settings) -> DataFrame:
    top = sl.top_weaknesses(report.weaknesses, settings.top_n)
    return sl.with_allocation(
        sl.with_root_flag(top, report.chains), settings.specs_per_weakness, settings.max_per_weakness
    )


def prior_tags(specs: DataFrame) -> DataFrame:
    """Key, dimensions, order and id of earlier specs."""
    return specs.select(
        sp.spec_key(specs).alias("key"), "diversity_tags.*",
        F.xxhash64("spec_id").alias("seq"), "spec_id",
    )


def planned_slots(report: Report, diagnoses: DataFrame, prior: DataFrame | None, settings: Settings) -> DataFrame:
    """One row per slot with its diversity tags and evidence; fails when the plan is short."""
    rows = allocated(report, settings)
    slot_rows = sl.slots(rows, settings.difficulty_distribution)
    empty = report.weaknesses.sparkSession.createDataFrame(
        [], "key string, narrative_theme string, data_structure string, constraint_scale string, "
            "seq bigint, spec_id string"
    )
    tags = dv.plan(
        rows, empty if prior is None else prior_tags(prior), list(settings.generic_themes),
        settings.domain_adaptive, list(settings.data_structures), settings.overlap_threshold,
    )
    short = F.raise_error(F.format_string("Unable to assign diversity slots for weakness %s", F.col("key")))
    filled = slot_rows.join(tags, ["key", "slot"], "left").withColumn(
        "diversity_tags", F.coalesce("diversity_tags", short.cast(tags.schema["diversity_tags"].dataType))
    )
    samples = sl.sample_evidence(report.weaknesses, diagnoses, report.tag_map)
    return sl.with_slot_evidence(filled, samples)


def with_notes(slot_rows: DataFrame, prior: DataFrame | None) -> DataFrame:
    """Slots with the notes that name the specs they must not repeat.

    Those are the run's own earlier specs (a run holds at most top_n times
    max_per_weakness) and the ones its earlier slots are expected to become.
    """
    ahead = sp.numbered(slot_rows).withColumn("_n", F.substring("spec_id", 6, 10).cast("int"))
    own = F.transform(
        F.when(F.col("_n") > 1, F.sequence(F.lit(1), F.col("_n") - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.format_string("spec-%04d", i),
    )
    df, ids = ahead, own
    if prior is not None:
        listed = prior.agg(F.array_sort(F.collect_list("spec_id")).alias("_prior"), F.lit(1).alias("_one"))
        df = ahead.withColumn("_one", F.lit(1)).join(listed, "_one").drop("_one")
        ids = F.concat("_prior", own)
    notes = F.array_distinct(F.transform(ids, lambda i: F.format_string(fixed.DUPLICATE_NOTE_FORMAT, i)))
    return df.withColumn("notes", notes).drop("_n", "_prior", "spec_id")


def synthesize(
    report: Report,
    diagnoses: DataFrame,
    prior: DataFrame | None = None,
    settings: Settings = Settings(),
    generate: Callable | None = None,
    check: Callable | None = None,
) -> Synthesis:
    """Spec rows for the top weaknesses, and the events of their making."""
    slot_rows = with_notes(planned_slots(report, diagnoses, prior, settings), prior)
    named = slot_rows.withColumn("slot_key", F.concat_ws("#", "key", F.col("slot").cast("string")))
    view = written(sp.synthesis_view(named), "slots")
    rows, events = rg.generated(view, generate, check, settings.max_regeneration_attempts + 1)
    return Synthesis(sp.spec_rows(sp.numbered(rows)), events, view)
