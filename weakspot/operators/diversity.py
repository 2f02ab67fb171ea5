"""Diversity of specs: conflicts with earlier ones and plans of new tags."""

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.text import strings

DIMENSIONS = ["narrative_theme", "data_structure", "constraint_scale"]


def needed_matches(threshold: float) -> int:
    """Smallest number of equal dimensions (of three) that is above the threshold."""
    return next((m for m in range(4) if m / 3 > threshold), 4)


def _agreements(size: int) -> list[tuple[str, ...]]:
    return list(combinations(DIMENSIONS, size)) if size <= len(DIMENSIONS) else []


def earliest_by_agreement(existing: DataFrame, size: int) -> list[tuple[tuple[str, ...], DataFrame]]:
    """For every choice of ``size`` dimensions, the earliest spec per key and values."""
    rows = existing.select("key", *DIMENSIONS, "seq", "spec_id")
    return [
        (dims, rows.groupBy("key", *dims).agg(F.min_by(F.struct("seq", "spec_id", *DIMENSIONS), "seq").alias("hit")))
        for dims in _agreements(size)
    ]


def _null_hit(rows: DataFrame) -> Column:
    fields = [f"seq:{rows.schema['seq'].dataType.simpleString()}", "spec_id:string"]
    fields += [f"{d}:string" for d in DIMENSIONS]
    return F.lit(None).cast(f"struct<{','.join(fields)}>")


def first_agreement(candidates: DataFrame, existing: DataFrame, size: int, earlier_only: bool) -> DataFrame:
    """Candidates with the earliest existing spec of their key that agrees on ``size`` dimensions.

    A spec agrees on at least ``size`` dimensions exactly when it falls into the
    candidate's group for one choice of them, and the earliest of a group stands
    for all.  So the existing specs are reduced per group (combined before the
    shuffle) and looked up by equality; no two specs are paired up.
    """
    df = candidates.withColumn("_hit", _null_hit(existing))
    for n, (dims, groups) in enumerate(earliest_by_agreement(existing, size)):
        df = df.join(groups.withColumnRenamed("hit", f"_h{n}"), ["key", *dims], "left")
        found = F.col(f"_h{n}")
        if earlier_only:
            found = F.when(found["seq"] < F.col("seq"), found)
        # least() ignores nulls; structs compare by seq first
        df = df.withColumn("_hit", F.least(F.col("_hit"), found)).drop(f"_h{n}")
    return df.withColumnRenamed("_hit", f"agrees_{size}").select(*candidates.columns, f"agrees_{size}")


def overlap(a, b) -> Column:
    """Share of equal dimensions of two structs or rows."""
    equal = [F.when(a[d] == b[d], F.lit(1)).otherwise(F.lit(0)) for d in DIMENSIONS]
    return (equal[0] + equal[1] + equal[2]) / F.lit(3.0)


def assigned(
    candidates: DataFrame, existing: DataFrame, threshold: float = 0.5, earlier_only: bool = False
) -> DataFrame:
    """Candidates with ``accepted``, ``overlap_score`` and ``reason``.

    Both tables carry key, the three dimensions and ``seq`` (order); existing
    ones also a ``spec_id``.  ``earlier_only`` checks a corpus against its own past.
    """
    need = needed_matches(threshold)
    if need == 0:
        raise ValueError("a negative threshold rejects everything")
    df = candidates
    conflict = _null_hit(existing)
    if need <= 3:
        df = first_agreement(df, existing, need, earlier_only)
        conflict = F.col(f"agrees_{need}")
    highest = F.lit(0.0)
    for size in range(1, need):
        if size <= 3:
            df = first_agreement(df, existing, size, earlier_only)
            highest = F.when(F.col(f"agrees_{size}").isNotNull(), F.lit(size / 3.0)).otherwise(highest)
    here = F.struct(*DIMENSIONS)
    clash = conflict["spec_id"].isNotNull()
    return df.select(
        *candidates.columns,
        (~clash).alias("accepted"),
        F.when(clash, overlap(conflict, here)).otherwise(highest).alias("overlap_score"),
        F.when(clash, F.format_string(fixed.DIVERSITY_REJECTED_FORMAT, conflict["spec_id"]))
        .otherwise(F.lit(fixed.DIVERSITY_ACCEPTED_REASON)).alias("reason"),
    )


def candidate_themes(key: Column, count: Column, generic: list[str], adaptive: bool = True) -> Column:
    """Configured themes, then the key with a running number."""
    own = F.transform(
        F.sequence(F.lit(1), F.greatest(count * 3, F.lit(6))),
        lambda i: F.when(i == 1, key).otherwise(F.concat_ws("_", key, i.cast("string"))),
    )
    listed = strings(generic)
    return F.array_distinct(F.concat(listed, own) if adaptive or not generic else listed)


def candidate_space(rows: DataFrame, structures: list[str] | None = None) -> DataFrame:
    """Every theme, structure and scale of a row (column ``themes``), numbered in that nesting."""
    structures = fixed.DATA_STRUCTURES if structures is None else structures
    inner = len(structures) * len(fixed.CONSTRAINT_SCALES)
    nested = rows.select(*rows.columns, F.posexplode("themes").alias("_t", "narrative_theme"))
    nested = nested.select(*nested.columns, F.posexplode(strings(structures)).alias("_s", "data_structure"))
    nested = nested.select(*nested.columns, F.posexplode(strings(fixed.CONSTRAINT_SCALES)).alias("_c", "constraint_scale"))
    place = F.col("_t") * inner + F.col("_s") * len(fixed.CONSTRAINT_SCALES) + F.col("_c")
    return nested.withColumn("seq", place.cast("bigint")).drop("_t", "_s", "_c", "themes")


def plan(
    allocated: DataFrame,
    existing: DataFrame,
    generic: list[str] = (),
    adaptive: bool = True,
    structures: list[str] | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """Diversity tags per slot: (key, slot, diversity_tags), or fewer when the space runs out.

    Candidates that clash with existing specs of the key drop out by lookup.
    The rest of a key (themes x structures x scales, set by the configuration)
    is walked in order by one fold, which takes a candidate when it does not
    clash with those taken so far.
    """
    themes = candidate_themes(F.col("key"), F.col("n_slots"), list(generic), adaptive)
    space = candidate_space(allocated.select("key", "n_slots", themes.alias("themes")), structures)
    free = assigned(space, existing, threshold).filter("accepted") if threshold < 1 else space
    entry = F.struct("seq", *DIMENSIONS)
    walked = free.groupBy("key", "n_slots").agg(F.array_sort(F.collect_list(entry)).alias("_all"))

    def take(taken, candidate):
        clash = F.exists(taken, lambda t: overlap(t, candidate) > threshold)
        full = F.size(taken) >= F.col("n_slots")
        return F.when(full | clash, taken).otherwise(F.array_append(taken, candidate))

    empty = F.array().cast(f"array<struct<seq:bigint,{','.join(d + ':string' for d in DIMENSIONS)}>>")
    chosen = walked.select("key", F.aggregate("_all", empty, take).alias("_taken"))
    return chosen.select("key", F.posexplode("_taken").alias("slot", "_d")).select(
        "key", "slot", F.struct(*[F.col(f"_d.{d}").alias(d) for d in DIMENSIONS]).alias("diversity_tags")
    )


def unfilled(allocated: DataFrame, planned: DataFrame) -> DataFrame:
    """Keys whose plan has fewer tags than slots."""
    filled = planned.groupBy("key").agg(F.count(F.lit(1)).alias("planned"))
    return (
        allocated.select("key", "n_slots").join(filled, "key", "left")
        .withColumn("planned", F.coalesce("planned", F.lit(0))).filter("planned < n_slots")
    )


def relevant_specs(specs: DataFrame, weaknesses: DataFrame) -> DataFrame:
    """Specs whose first tag is the key of a weakness."""
    return specs.join(weaknesses.select("key").distinct(), "key", "left_semi")
