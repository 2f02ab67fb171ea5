"""Clusters of failure rows.

A cluster is a (fault type, first tag) pair.  The fact table is reduced once to
two small tables of partials per pair: counts with the distinct verification
labels (hash aggregate, combined before the shuffle) and the three smallest
task ids (a per-partition top three before the shuffle).  Every later regrouping
works on these partials, and no step gathers the rows of a cluster.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.tags import report_tag
from weakspot.functions.text import first

SAMPLES = 3
KEY = ["fault_type", "tag"]


class Partials(NamedTuple):
    """Counts and sample rows per key; a null tag stands for an empty tag list."""

    counts: DataFrame
    samples: DataFrame


def keyed(diagnoses: DataFrame) -> DataFrame:
    """The narrow columns clusters are made from."""
    label = lambda name: F.nullif(F.try_element_at(F.col("enriched_labels"), F.lit(name)), F.lit(""))
    return diagnoses.select(
        "task_id", "fault_type", first(F.col("sub_tags")).alias("tag"),
        label("verification_status").alias("status"), label("verification_level").alias("level"),
    )


def smallest_ids(rows: DataFrame, key: list[str], n: int = SAMPLES) -> DataFrame:
    """Rows of the n smallest ids per key.

    The row-number limit is pushed below the shuffle, so a hot key sends n rows
    per partition whatever its size.
    """
    order = Window.partitionBy(*key).orderBy("task_id")
    return (
        rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")
    )


def partials(rows: DataFrame) -> Partials:
    """Partials of keyed rows."""
    counts = rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("frequency"),
        F.min("task_id").alias("min_task_id"),
        F.collect_set("status").alias("statuses"),
        F.collect_set("level").alias("levels"),
    )
    return Partials(counts, smallest_ids(rows.select(*KEY, "task_id"), KEY))


def regrouped(parts: Partials, tag: Column) -> Partials:
    """Partials under another tag: counts add up, label sets and samples merge."""
    retag = lambda df: df.withColumn("tag", tag)
    # label sets hold a handful of levels and statuses; distinct labels are
    # merged as rows, not by gathering the sets of a key
    labels = lambda name: F.array_distinct(F.flatten(F.collect_set(name)))
    counts = retag(parts.counts).groupBy(*KEY).agg(
        F.sum("frequency").alias("frequency"),
        F.min("min_task_id").alias("min_task_id"),
        labels("statuses").alias("statuses"),
        labels("levels").alias("levels"),
    )
    return Partials(counts, smallest_ids(retag(parts.samples), KEY))


def clusters(parts: Partials) -> DataFrame:
    """One row per key with its count, smallest ids and sorted labels."""
    ids = parts.samples.groupBy(*KEY).agg(F.array_sort(F.collect_list("task_id")).alias("sample_task_ids"))
    same = [parts.counts[c].eqNullSafe(ids[c]) for c in KEY]
    return parts.counts.join(ids, same, "left").select(
        parts.counts["fault_type"], parts.counts["tag"], "frequency", "min_task_id", "sample_task_ids",
        F.array_sort("statuses").alias("statuses"), F.array_sort("levels").alias("levels"),
    )


def named(parts: Partials) -> Partials:
    """First clustering: an empty tag list counts as ``unknown``."""
    return regrouped(parts, F.coalesce(F.col("tag"), F.lit("unknown")))


def mapped_tag(tag_map: DataFrame | None, df: DataFrame) -> tuple[DataFrame, Column]:
    """Join a tag map (source, target) and give the mapped tag, itself by default."""
    if tag_map is None:
        return df, F.col("tag")
    joined = df.join(tag_map, df["tag"] == tag_map["source"], "left").drop("source")
    return joined, F.coalesce(F.col("target"), F.col("tag"))


def remapped(parts: Partials, tag_map: DataFrame | None) -> Partials:
    """Partials under mapped tags."""
    sides = []
    for side in parts:
        joined, tag = mapped_tag(tag_map, side)
        sides.append(joined.withColumn("tag", tag).drop("target"))
    return Partials(*sides)


def final(parts: Partials, tag_map: DataFrame | None) -> Partials:
    """Second clustering: mapped tags under their canonical names.

    Rows without any tag stay ``unknown``; a literal ``unknown`` tag does not.
    """
    tag = F.when(F.col("tag").isNull(), F.lit("unknown")).otherwise(report_tag(F.col("tag")))
    return regrouped(remapped(parts, tag_map), tag)


def joined_labels(labels: Column) -> Column:
    return F.when(F.size(labels) == 0, F.lit("unknown")).otherwise(F.array_join(labels, ","))


def root_cause() -> Column:
    return F.format_string(
        fixed.ROOT_CAUSE_FORMAT, F.col("fault_type"), F.col("tag"),
        joined_labels(F.col("statuses")), joined_labels(F.col("levels")),
    )


def narrative(cliff_format: str) -> Column:
    """Default collective diagnosis of a cluster row."""
    return F.struct(
        root_cause().alias("refined_root_cause"),
        F.format_string(cliff_format, F.col("tag")).alias("capability_cliff"),
        F.array().cast("array<bigint>").alias("misdiagnosed_ids"),
        F.create_map().cast("map<string,string>").alias("misdiagnosis_corrections"),
        F.lit(1.0).alias("cluster_coherence"),
    )


def narratives_by_key(groups: DataFrame) -> DataFrame:
    """Narrative per canonical key; of several groups the one starting last wins."""
    return (
        groups.withColumn("tag", report_tag(F.col("tag")))
        .groupBy(*KEY)
        .agg(F.max_by("narrative", "min_task_id").alias("narrative"))
    )


def with_siblings(groups: DataFrame) -> DataFrame:
    """Clusters with the other tags of their fault type.

    The tags of a fault type are listed once and shared by its clusters, so
    nothing is paired cluster by cluster.
    """
    listed = groups.groupBy("fault_type").agg(
        F.array_sort(F.collect_list(F.struct("min_task_id", "tag"))).alias("_all")
    )
    return groups.join(listed, "fault_type").withColumn(
        "siblings",
        F.transform(F.filter("_all", lambda s: s["tag"] != F.col("tag")), lambda s: s["tag"]),
    ).drop("_all")
