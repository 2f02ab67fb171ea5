"""Which weaknesses get specs, how many, and from what evidence."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.operators.report import weakness_key
from weakspot.sources.artifacts import written

EVIDENCE_FIELDS = ["wrong_line", "correct_approach", "failed_test"]
EVIDENCE_ROWS = 3


def keyed(weaknesses: DataFrame) -> DataFrame:
    return weaknesses.withColumn(
        "key", weakness_key(F.col("sub_tags"), F.col("fault_type"), F.col("rank"))
    )


def first_per_key(weaknesses: DataFrame) -> DataFrame:
    """Of the weaknesses sharing a key, the one of lowest rank."""
    rows = keyed(weaknesses)
    best = rows.groupBy("key").agg(F.min_by(F.struct(*rows.columns), "rank").alias("w"))
    return best.select("w.*")


def top_weaknesses(weaknesses: DataFrame, top_n: int) -> DataFrame:
    return first_per_key(weaknesses).orderBy("rank").limit(max(top_n, 0))


def with_root_flag(rows: DataFrame, chains: DataFrame) -> DataFrame:
    roots = chains.select(F.col("root").alias("key")).distinct().withColumn("_root", F.lit(True))
    return rows.join(roots, "key", "left").withColumn(
        "is_root", F.coalesce("_root", F.lit(False))
    ).drop("_root")


def with_allocation(rows: DataFrame, base: int = 3, cap: int = 8) -> DataFrame:
    """Slots per weakness: a base, more for chain roots and trainable ones, capped."""
    extra = F.when(F.col("is_root"), 2).otherwise(0) + F.when(F.col("trainability") >= 0.8, 1).otherwise(0)
    return rows.withColumn("n_slots", F.least(F.lit(base) + extra, F.lit(cap)))


def difficulty(slot: Column, count: Column, distribution: str) -> Column:
    if distribution == "weighted_hard":
        medium = slot % 3 == 1
    else:
        medium = slot * 2 < count
    return F.when(medium, F.lit("medium")).otherwise(F.lit("hard"))


def slots(allocated: DataFrame, distribution: str = "balanced") -> DataFrame:
    """One row per slot, numbered from 0 within its weakness."""
    numbered = allocated.filter("n_slots > 0").withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("n_slots") - 1)))
    return numbered.withColumn("difficulty", difficulty(F.col("slot"), F.col("n_slots"), distribution))


def sample_evidence(weaknesses: DataFrame, diagnoses: DataFrame, tag_map: DataFrame) -> DataFrame:
    """Up to three evidence rows per key: (key, pos, evidence).

    The sampled tasks in their listed order; a key none of whose samples has a
    diagnosis takes the first diagnoses carrying one of its tags.  The tag map is cut
    to the tags that lead to such a key before the diagnoses meet it, so that only
    their rows go on; where no key is left, the second scan falls away.
    """
    best = first_per_key(weaknesses)
    wanted = best.select("key", F.posexplode("sample_task_ids").alias("at", "task_id"))
    columns = ["key", "at", "task_id", "evidence"]
    # at most three rows per sampled task and weakness, read twice below
    own = written(
        _first_three(diagnoses.select("task_id", "evidence").join(wanted, "task_id").select(*columns), ["at", "task_id"]),
        "samples",
    )
    missing = best.select("key").join(own.select("key"), "key", "left_anti")
    leading = tag_map.select(F.col("source").alias("tag"), F.coalesce("target", "source").alias("key"))
    asked = leading.join(missing, "key", "left_semi").unionByName(
        missing.join(leading, missing["key"] == leading["tag"], "left_anti").select(F.col("key").alias("tag"), "key")
    )
    tags = diagnoses.select("task_id", "evidence", F.posexplode("sub_tags").alias("at", "tag"))
    other = tags.join(asked, "tag").select(*columns)
    return own.unionByName(_first_three(other, ["task_id", "at"]))


def _first_three(rows: DataFrame, order: list[str]) -> DataFrame:
    number = F.row_number().over(Window.partitionBy("key").orderBy(*order))
    return (
        rows.withColumn("_n", number).filter(F.col("_n") <= EVIDENCE_ROWS)
        .select("key", (F.col("_n") - 1).alias("pos"), "evidence")
    )


def merged_evidence(samples: DataFrame) -> DataFrame:
    """Evidence of a key as one struct: distinct values per field in order, joined."""
    rows = samples.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("pos", "evidence"))).alias("_rows")
    )
    return rows.select(
        "key",
        F.struct(
            *[
                F.array_join(
                    F.array_distinct(F.transform("_rows", lambda r: r["evidence"][name])), " | "
                ).alias(name)
                for name in EVIDENCE_FIELDS
            ]
        ).alias("evidence"),
    )


def template_evidence(key: Column) -> Column:
    return F.struct(
        *[F.format_string(form, key).alias(name) for name, form in fixed.MISSING_EVIDENCE_FORMATS.items()]
    )


def with_slot_evidence(slot_rows: DataFrame, samples: DataFrame) -> DataFrame:
    """Slots take the samples of their key in turn; without any, the template."""
    counts = samples.groupBy("key").agg(F.count(F.lit(1)).alias("_samples"))
    chosen = slot_rows.join(counts, "key", "left").withColumn(
        "pos", F.pmod(F.col("slot"), F.col("_samples"))
    )
    return (
        chosen.join(samples, ["key", "pos"], "left")
        .withColumn("evidence", F.coalesce("evidence", template_evidence(F.col("key"))))
        .drop("_samples", "pos")
    )

