"""Group analyzers plugged into the aggregate stage.

An analyzer maps pandas batches with the columns ``cluster_key`` and ``payload``
to batches with ``cluster_key`` and ``answer``, both JSON text.  It sees a
cluster through its counts, labels, siblings and all of its diagnoses, which large
clusters deal out over several payloads.
"""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.responses import clean_collective, collective_gap, parsed
from weakspot.functions.tags import report_tag
from weakspot.functions.text import first
from weakspot.operators.clusters import KEY, mapped_tag, narrative, with_siblings
from weakspot.schemas import EVIDENCE
from weakspot.sources.artifacts import written

CHUNK_ROWS = 200


def chunks(clusters: DataFrame, rows: DataFrame, tag_map: DataFrame | None) -> DataFrame:
    """Every diagnosis of every cluster, dealt out in arrays of about `CHUNK_ROWS` by a hash of its task."""
    keyed = rows.select(
        "task_id", "fault_type", F.coalesce(first(F.col("sub_tags")), F.lit("unknown")).alias("tag"),
        "severity", "description", "evidence", "enriched_labels", "confidence",
    )
    joined, tag = mapped_tag(tag_map, keyed)
    fields = [c for c in keyed.columns if c not in KEY]
    entry = F.struct("task_id", F.to_json(F.struct(*fields)).alias("json"))
    sizes = clusters.select(*KEY, F.ceil(F.col("frequency") / CHUNK_ROWS).cast("int").alias("chunks"))
    dealt = joined.withColumn("tag", tag).drop("target").join(sizes, KEY)
    return (
        dealt.withColumn("chunk", F.pmod(F.xxhash64("task_id"), F.col("chunks")).cast("int"))
        .groupBy(*KEY, "chunk").agg(F.array_sort(F.collect_list(entry)).alias("diagnoses"), F.count(F.lit(1)).alias("rows_seen"))
    )


def payloads(clusters: DataFrame, rows: DataFrame, tag_map: DataFrame | None) -> DataFrame:
    """(cluster key, chunk, rows_seen, payload): the JSON an analyzer receives for each chunk of a cluster."""
    fields = F.from_json(
        F.concat(F.lit("["), F.array_join(F.transform("diagnoses", lambda d: d["json"]), ","), F.lit("]")),
        "array<struct<task_id: bigint, severity: string, description: string, "
        f"evidence: {EVIDENCE}, enriched_labels: map<string,string>, confidence: double>>",
    )
    payload = F.to_json(
        F.struct(
            "fault_type", F.array("tag").alias("sub_tags"), "frequency", "sample_task_ids",
            "statuses", "levels", "siblings", fields.alias("diagnoses"),
        )
    )
    return (
        with_siblings(clusters).join(chunks(clusters, rows, tag_map), KEY)
        .select(*KEY, "chunk", "rows_seen", payload.alias("payload"))
    )


def _ask(questions: DataFrame, analyze: Callable) -> DataFrame:
    """One row per question: its cleaned answer, and what is wrong with it if anything is."""
    answers = questions.mapInPandas(analyze, "cluster_key string, answer string")
    single = answers.groupBy("cluster_key").agg(F.min("answer").alias("answer"), (F.min("answer") != F.max("answer")).alias("several"))
    met = questions.select("cluster_key").join(single, "cluster_key", "left")
    cleaned = met.withColumn("clean", clean_collective(parsed(F.col("answer"))))
    wrong = F.when(F.col("answer").isNull(), F.lit("not answered")).when(F.col("several"), F.lit("answered in several ways"))
    return written(
        cleaned.withColumn("problem", F.coalesce(wrong, collective_gap(F.col("answer"), F.col("clean")))), "answers"
    )


class Analysis(NamedTuple):
    """What analyzers said: one row per cluster, and everything listed as rows of its own.

    ``clusters`` carry the narrative (without lists), ``rows_seen`` and the first
    ``problem``; ``proposals`` are merges with their position; ``details`` hold ids told
    to be misdiagnosed (``task_id``) and corrections (``about``, ``correction``).
    """

    clusters: DataFrame
    proposals: DataFrame
    details: DataFrame


def joined_answers(answered: DataFrame) -> DataFrame:
    """One answer per cluster from those to its chunks, by mergeable aggregates.

    Texts are those of the first chunk with a usable answer, coherence is the mean by
    rows, ``problem`` is that of the first chunk that has one.  However many chunks a
    cluster has, each task sends one row of it.
    """
    usable = F.col("problem").isNull()
    seen = F.when(usable, F.col("rows_seen"))
    gathered = answered.groupBy(*KEY).agg(
        F.min_by(F.struct("clean.refined_root_cause", "clean.capability_cliff"), F.when(usable, F.col("chunk"))).alias("texts"),
        F.sum(seen * F.col("clean.cluster_coherence")).alias("weighed"), F.sum(seen).alias("told"),
        F.min_by("problem", F.when(~usable, F.col("chunk"))).alias("problem"), F.sum("rows_seen").alias("rows_seen"),
    )
    narrative_of = F.struct(
        F.col("texts.refined_root_cause").alias("refined_root_cause"), F.col("texts.capability_cliff").alias("capability_cliff"),
        F.array().cast("array<bigint>").alias("misdiagnosed_ids"), F.create_map().cast("map<string,string>").alias("misdiagnosis_corrections"),
        (F.col("weighed") / F.col("told")).alias("cluster_coherence"),
    )
    return gathered.select(*KEY, F.when(F.col("told") > 0, narrative_of).alias("answer"), "rows_seen", "problem")


def told_details(answered: DataFrame) -> DataFrame:
    """Distinct misdiagnosed ids and corrections of each cluster, as rows; the earliest chunk's correction counts."""
    usable = answered.filter("problem IS NULL")
    none = F.lit(None).cast("string")
    ids = usable.select(*KEY, F.explode("clean.misdiagnosed_ids").alias("task_id")).distinct().select(
        *KEY, "task_id", none.alias("about"), none.alias("correction")
    )
    corrections = (
        usable.select(*KEY, "chunk", F.explode("clean.misdiagnosis_corrections").alias("about", "text"))
        .groupBy(*KEY, "about").agg(F.min_by("text", "chunk").alias("correction"))
        .select(*KEY, F.lit(None).cast("bigint").alias("task_id"), "about", "correction")
    )
    return ids.unionByName(corrections)


def told_proposals(answered: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row per distinct merge that an analysis proposes, with its cluster and first position."""
    listed = answered.filter("problem IS NULL").select(*KEY, "chunk", F.posexplode("clean.semantic_merges").alias("at", "m"))
    place = F.col("chunk").cast("bigint") * 2**31 + F.col("at")
    told = listed.groupBy(*KEY, "m").agg(F.min(place).alias("position"))
    return told.join(clusters.select(*KEY, "min_task_id"), KEY).select(
        *KEY, "min_task_id", "position", "m.source_tag", "m.target_tag", "m.confirmed"
    )


def analyzed(clusters: DataFrame, rows: DataFrame, tag_map: DataFrame | None, analyze: Callable) -> Analysis:
    """Clusters with the narrative of their analysis, and its lists.

    An analyzer is asked once per chunk, and once for equal payloads.  A missing,
    ambiguous or bad answer is asked for once more; a second such one is kept in
    ``problem``, and a cluster without any usable answer gets the default narrative.
    """
    asked = written(
        payloads(clusters, rows, tag_map).withColumn("cluster_key", F.sha2("payload", 256)), "payloads"
    )
    questions = asked.dropDuplicates(["cluster_key"]).select("cluster_key", "payload")
    once = _ask(questions, analyze)
    bad = once.filter("problem IS NOT NULL").select("cluster_key")
    twice = _ask(questions.join(bad, "cluster_key", "left_semi"), analyze)
    answers = once.filter("problem IS NULL").unionByName(twice).select("cluster_key", "clean", "problem")
    answered = asked.drop("payload").join(answers, "cluster_key", "left")
    told = (
        clusters.join(joined_answers(answered), KEY, "left")
        .withColumn("narrative", F.coalesce("answer", narrative(fixed.MERGED_CLIFF_FORMAT)))
        .drop("answer")
    )
    return Analysis(told, told_proposals(answered, clusters), told_details(answered))


def with_lists(narratives: DataFrame, analysis: Analysis) -> DataFrame:
    """Narratives by canonical key with the lists of the group that told them.

    This is where lists become fields: the report has at most 35 narratives.
    """
    told_by = analysis.clusters.withColumn("canonical", report_tag(F.col("tag"))).groupBy("fault_type", "canonical").agg(
        F.max_by("tag", "min_task_id").alias("tag")
    )
    pair = F.when(F.col("about").isNotNull(), F.struct("about", "correction"))
    lists = analysis.details.join(told_by, KEY).groupBy("fault_type", F.col("canonical").alias("tag")).agg(
        F.array_sort(F.collect_list("task_id")).alias("_ids"), F.map_from_entries(F.array_sort(F.collect_list(pair))).alias("_pairs"),
    )
    told = F.col("narrative").withField("misdiagnosed_ids", F.coalesce("_ids", F.col("narrative.misdiagnosed_ids"))).withField(
        "misdiagnosis_corrections", F.coalesce("_pairs", F.col("narrative.misdiagnosis_corrections"))
    )
    return narratives.join(lists, KEY, "left").withColumn("narrative", told).drop("_ids", "_pairs")


def failure_events(analyzed_clusters: DataFrame) -> DataFrame:
    """Log rows for analyses replaced by the default."""
    return analyzed_clusters.filter("problem IS NOT NULL").select(
        F.lit("aggregate").alias("stage"),
        F.lit("collective_parse_failure").alias("error_type"),
        F.col("problem").alias("message"),
        F.lit(2).alias("attempts"),
        F.struct("fault_type", F.array("tag").alias("sub_tags"), F.col("sample_task_ids").alias("task_ids"))
        .alias("cluster"),
    )


def causal_hook(analyze: Callable) -> Callable[[DataFrame], DataFrame]:
    """Chains from a function over the weakness table (at most 35 rows, one batch).

    The function maps a pandas frame of weaknesses to one of chains.
    """

    def run(rows: DataFrame) -> DataFrame:
        flat = rows.select(
            F.lit(1).alias("one"), "rank", "fault_type", first(F.col("sub_tags")).alias("tag"),
            "frequency", "trainability",
        )
        return flat.groupBy("one").applyInPandas(
            lambda pdf: analyze(pdf.drop(columns="one").sort_values("rank")),
            "root string, downstream array<string>, training_priority string",
        )

    return run
