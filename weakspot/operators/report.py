"""Weakness table, rankings and causal chains.

These work on the weakness table: at most one row per fault type and canonical
tag, 35 in all, so ordering it as a whole is cheap.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.text import first, lookup
from weakspot.operators.clusters import KEY, narrative


def trainability(fault_type: Column) -> Column:
    return lookup(fault_type, fixed.TRAINABILITY, fixed.DEFAULT_TRAINABILITY)


def weakness_key(tags: Column, fault_type: Column, rank: Column) -> Column:
    return F.coalesce(first(tags), F.concat_ws("_", fault_type, rank.cast("string")))


def ranked(clusters: DataFrame) -> DataFrame:
    """Rank is the position in (fault type, tag) order."""
    return clusters.withColumn("rank", F.row_number().over(Window.orderBy(*KEY)))


def weaknesses(final_clusters: DataFrame, narratives: DataFrame) -> DataFrame:
    """Weakness rows with the narrative of their key, or a generated one."""
    joined = final_clusters.join(narratives, KEY, "left")
    plain = narrative(fixed.PLAIN_CLIFF_FORMAT)
    return ranked(joined).select(
        "rank",
        "fault_type",
        F.array("tag").alias("sub_tags"),
        "frequency",
        "sample_task_ids",
        trainability(F.col("fault_type")).alias("trainability"),
        F.coalesce(F.col("narrative"), plain).alias("collective_diagnosis"),
    )


def _ranks_by(score: Column) -> Column:
    """Ranks in falling order of a score, ties by rank."""
    ordered = F.array_sort(F.collect_list(F.struct((-score).alias("s"), F.col("rank").alias("r"))))
    return F.transform(ordered, lambda e: e["r"])


def rankings(rows: DataFrame) -> DataFrame:
    """One row with the ranks by frequency, difficulty and trainability."""
    return rows.agg(
        _ranks_by(F.col("frequency")).alias("by_frequency"),
        _ranks_by(lookup(F.col("fault_type"), fixed.DIFFICULTY_SCORE)).alias("by_difficulty"),
        _ranks_by(F.col("trainability")).alias("by_trainability"),
    )


def default_chains(rows: DataFrame) -> DataFrame:
    """One chain: the most trainable, most frequent weakness leads to all others."""
    line = F.array_sort(
        F.collect_list(
            F.struct(
                (-F.col("trainability")).alias("a"),
                (-F.col("frequency")).alias("b"),
                F.col("rank").alias("c"),
                first(F.col("sub_tags")).alias("tag"),
            )
        )
    )
    tags = rows.agg(F.transform(line, lambda e: e["tag"]).alias("tags")).filter(F.size("tags") > 0)
    return tags.select(
        F.col("tags")[0].alias("root"),
        F.slice("tags", F.lit(2), F.size("tags")).alias("downstream"),
        F.col("tags")[0].alias("training_priority"),
    )


def as_document(rows: DataFrame, ranks: DataFrame, chains: DataFrame, tag_map: DataFrame) -> DataFrame:
    """The whole report as one nested row."""
    listed = rows.agg(F.array_sort(F.collect_list(F.struct(*rows.columns)), _by_rank).alias("weaknesses"))
    rank_row = ranks.select(F.struct(*ranks.columns).alias("rankings"))
    chain_row = chains.agg(F.collect_list(F.struct("root", "downstream", "training_priority")).alias("causal_chains"))
    map_row = tag_map.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "target")))).alias("tag_mappings")
    )
    one = F.lit(1).alias("_one")
    document = listed.select("*", one)
    for part in [rank_row, chain_row, map_row]:
        document = document.join(part.select("*", one), "_one")
    return document.drop("_one")


def _by_rank(a: Column, b: Column) -> Column:
    return a["rank"] - b["rank"]


def from_document(document: DataFrame) -> dict[str, DataFrame]:
    """Tables of a nested report."""
    return {
        "weaknesses": document.select(F.inline("weaknesses")),
        "rankings": document.select("rankings.*"),
        "chains": document.select(F.inline("causal_chains")),
        "tag_map": document.select(F.explode("tag_mappings").alias("source", "target")),
    }
