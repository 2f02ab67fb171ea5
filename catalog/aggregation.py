"""Verification, clustering, merging and ranking."""

from pyspark.sql import functions as F

from catalog import sqltext as s
from catalog.registry import query, table
from catalog.views import LOG_SQL, log, tasks
from weakspot import fixed_values as fixed
from weakspot.functions import tags as tg
from weakspot.functions.text import first
from weakspot.operators import clusters as cl
from weakspot.operators import collective as co
from weakspot.operators import diagnose as dg
from weakspot.operators import merges as mg
from weakspot.operators import report as rp
from weakspot.operators.repair import repaired
from weakspot.plans.aggregate import aggregate
from weakspot.plans.diagnose import diagnose


def diagnoses(spark, sf):
    return dg.normalized(log(spark, sf))


def partials(spark, sf):
    return cl.partials(cl.keyed(repaired(dg.failures(diagnoses(spark, sf)))))


def report(spark, sf):
    return aggregate(diagnoses(spark, sf))


_VERDICT = "CASE WHEN task_id % 3 = 0 THEN 'failed' WHEN task_id % 3 = 1 THEN 'passed' END"


@query(f"""WITH {s.NORMALIZED} SELECT task_id,
  CASE WHEN task_id % 3 = 2 THEN 'self_check' ELSE 'cross_model' END AS level,
  CASE WHEN task_id % 3 = 0 THEN 'unverified' ELSE 'passed' END AS status,
  CASE WHEN task_id % 3 = 0 THEN least(confidence, 0.5) ELSE confidence END AS confidence
FROM diagnoses WHERE {s.IS_FAILURE}""")
def verification_ladder(spark, sf):
    """Cross-model verdicts for some rows; the others fall through to the self check."""
    rows = repaired(dg.failures(diagnoses(spark, sf)), verifiers={"cross_model": F.expr(_VERDICT)})
    value = lambda name: F.col("enriched_labels")[name]
    return rows.select(
        "task_id", value("verification_level").alias("level"), value("verification_status").alias("status"), "confidence"
    )


@query(f"""WITH {s.NORMALIZED} SELECT task_id,
  CASE WHEN task_id % 4 = 1 AND sub_tags[1] = 'logic_error' THEN 'unverified' ELSE 'passed' END AS status,
  CASE WHEN task_id % 2 = 1 AND sub_tags[1] = 'logic_error' THEN 'high' ELSE severity END AS severity
FROM diagnoses WHERE {s.IS_FAILURE}""")
def rediagnosed_failures(spark, sf):
    """Odd logic errors fail and are diagnosed again; half of them fail for good."""
    verdict = F.when(
        (F.col("task_id") % 2 == 1) & (first(F.col("sub_tags")) == "logic_error")
        & ((F.col("severity") != "high") | (F.col("task_id") % 4 == 1)), F.lit("failed")
    ).otherwise(F.lit("passed"))
    again = lambda rows: rows.withColumn("severity", F.lit("high"))
    rows = repaired(dg.failures(diagnoses(spark, sf)), verifiers={"self_check": verdict}, rediagnose=again)
    return rows.select("task_id", F.col("enriched_labels")["verification_status"].alias("status"), "severity")


@query(f"WITH {s.CLUSTERED} SELECT fault_type, tag, frequency, min_task_id FROM clusters")
def clusters_by_first_tag(spark, sf):
    named = cl.named(partials(spark, sf))
    return cl.clusters(named).select("fault_type", "tag", "frequency", "min_task_id")


@query(f"""WITH {s.CLUSTERED} SELECT fault_type, tag, frequency, array_to_string(sample_task_ids, ',') AS sample_ids FROM clusters""")
def cluster_samples(spark, sf):
    return cl.clusters(cl.named(partials(spark, sf))).select(
        "fault_type", "tag", "frequency", F.array_join(F.col("sample_task_ids").cast("array<string>"), ",").alias("sample_ids")
    )


@query(f"""WITH {s.NORMALIZED}, labelled AS (
  SELECT fault_type, coalesce(sub_tags[1], 'unknown') AS tag, {s.exact_label('verification_level')} AS level,
    {s.exact_label('verification_status')} AS status FROM diagnoses WHERE {s.IS_FAILURE})
SELECT fault_type, tag, 'Grouped by ' || fault_type || '/' || tag || ' (verification_status='
  || coalesce(string_agg(DISTINCT status, ',' ORDER BY status), 'unknown') || '; verification_level='
  || coalesce(string_agg(DISTINCT level, ',' ORDER BY level), 'unknown') || ')' AS root_cause
FROM labelled GROUP BY fault_type, tag""")
def cluster_causes(spark, sf):
    """Cause texts with the labels of rows that were not verified again."""
    named = cl.named(cl.partials(cl.keyed(dg.failures(diagnoses(spark, sf)))))
    return cl.clusters(named).select("fault_type", "tag", cl.root_cause().alias("root_cause"))


@query(f"""WITH {s.CLUSTERED} SELECT c.fault_type, c.tag, array_to_string(list(o.tag ORDER BY o.min_task_id, o.tag), ',') AS siblings
FROM clusters c JOIN clusters o ON c.fault_type = o.fault_type AND c.tag <> o.tag GROUP BY ALL""")
def sibling_clusters(spark, sf):
    return cl.with_siblings(cl.clusters(cl.named(partials(spark, sf)))).select(
        "fault_type", "tag", F.array_join("siblings", ",").alias("siblings")
    )


@query(f"""WITH {s.CLUSTERED} SELECT fault_type, tag, frequency, frequency AS rows_seen, CAST(ceil(frequency / 200) AS BIGINT) AS most_chunks FROM clusters""")
def group_payload_coverage(spark, sf):
    """Rows that the payloads of each cluster hold between them: all, once each."""
    rows = repaired(dg.failures(diagnoses(spark, sf)))
    groups = cl.clusters(cl.named(partials(spark, sf)))
    told = co.payloads(groups, rows, None).select(
        "fault_type", "tag", F.get_json_object("payload", "$.frequency").cast("bigint").alias("frequency"),
        F.size(F.from_json(F.get_json_object("payload", "$.diagnoses"), "array<struct<task_id: bigint>>")).alias("rows"),
    )
    return told.groupBy("fault_type", "tag", "frequency").agg(
        F.sum("rows").alias("rows_seen"), F.ceil(F.first("frequency") / co.CHUNK_ROWS).alias("most_chunks")
    )


@query(f"""WITH {s.CLUSTERED} SELECT fault_type, tag,
  row_number() OVER (ORDER BY min_task_id, fault_type, tag) AS place FROM clusters""")
def cluster_order(spark, sf):
    """Processing order of clusters, on the cluster table."""
    from pyspark.sql import Window

    order = F.row_number().over(Window.orderBy("min_task_id", "fault_type", "tag"))
    return cl.clusters(cl.named(partials(spark, sf))).select("fault_type", "tag", order.cast("bigint").alias("place"))


# tag map over user tags: every user points at another by the sum of their events, some at tags of no user
_EDGES = """edges AS (SELECT 'u' || CAST(user_id AS VARCHAR) AS source,
  CASE WHEN sum(event_id) % 5 = 0 THEN 'new' ELSE 'u' END || CAST(sum(event_id) % 97 AS VARCHAR) AS target FROM events GROUP BY user_id)"""


def user_edges(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.sum("event_id").alias("n")).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source"),
        F.concat(F.when(F.col("n") % 5 == 0, "new").otherwise("u"), (F.col("n") % 97).cast("string")).alias("target"),
    )


@query(f"""WITH RECURSIVE {_EDGES},
tags AS (SELECT source AS tag FROM edges),
walk AS (
  SELECT tag AS source, tag AS cur, coalesce((SELECT target FROM edges WHERE edges.source = tags.tag), tag) AS nxt, CAST([] AS VARCHAR[]) AS seen FROM tags
  UNION ALL
  SELECT w.source, w.nxt, coalesce(e.target, w.nxt), list_append(w.seen, w.cur)
  FROM walk w LEFT JOIN edges e ON e.source = w.nxt
  WHERE w.nxt <> w.cur AND NOT list_contains(w.seen, w.nxt))
SELECT source, nxt AS target FROM walk WHERE nxt = cur OR list_contains(seen, nxt)""")
def tag_map_closure(spark, sf):
    """Chains, cycles and tails of a tag map made from the events of each user."""
    return mg.closure(user_edges(spark, sf))


_PROPOSALS = f"""proposals AS (
  SELECT fault_type, tag, min_task_id, p.position, p.source_tag, p.target_tag, p.confirmed FROM (
    SELECT *, unnest([
      {{'position': 0, 'source_tag': tag, 'target_tag': 'logic_error', 'confirmed': min_task_id % 2 = 0}},
      {{'position': 1, 'source_tag': 'state_tracking', 'target_tag': tag, 'confirmed': true}},
      {{'position': 2, 'source_tag': tag, 'target_tag': 'Pass', 'confirmed': true}},
      {{'position': 3, 'source_tag': 'off_by_one', 'target_tag': 'loop', 'confirmed': fault_type = 'modeling'}}
    ]) AS p FROM clusters))"""


def proposals(spark, sf):
    groups = cl.clusters(cl.named(partials(spark, sf)))
    row = lambda n, a, b, ok: F.struct(
        F.lit(n).alias("position"), a.alias("source_tag"), b.alias("target_tag"), ok.alias("confirmed")
    )
    tag = F.col("tag")
    listed = F.array(
        row(0, tag, F.lit("logic_error"), F.col("min_task_id") % 2 == 0),
        row(1, F.lit("state_tracking"), tag, F.lit(True)),
        row(2, tag, F.lit("Pass"), F.lit(True)),
        row(3, F.lit("off_by_one"), F.lit("loop"), F.col("fault_type") == "modeling"),
    )
    return groups.select("fault_type", "tag", "min_task_id", F.inline(listed))


_APART = s.among(fixed.SUCCESS_TAGS + fixed.PROTECTED_TAGS)


@query(f"""WITH {s.CLUSTERED}, {_PROPOSALS}
SELECT fault_type, tag, position, source_tag, target_tag FROM proposals WHERE confirmed AND CASE
  WHEN fault_type IN ('implementation', 'surface') THEN lower(source_tag) <> lower(target_tag)
    AND lower(source_tag) NOT IN {_APART} AND lower(target_tag) NOT IN {_APART}
  ELSE source_tag <> target_tag END""")
def mergeable_proposals(spark, sf):
    return mg.mergeable(proposals(spark, sf)).select("fault_type", "tag", "position", "source_tag", "target_tag")


# acceptance in cluster order as a recursion that carries the map; the map is a
# list of (source, target) with the newest entry last, and a cluster is active
# while its tag still leads to itself
@query(f"""WITH RECURSIVE {s.CLUSTERED}, {_PROPOSALS},
ok AS (SELECT * FROM proposals WHERE confirmed AND CASE
  WHEN fault_type IN ('implementation', 'surface') THEN lower(source_tag) <> lower(target_tag)
    AND lower(source_tag) NOT IN {_APART} AND lower(target_tag) NOT IN {_APART}
  ELSE source_tag <> target_tag END),
own AS (SELECT fault_type, tag, min_task_id, list({{'s': source_tag, 't': target_tag}} ORDER BY position) AS edges,
  row_number() OVER (ORDER BY min_task_id, fault_type, tag) AS n FROM ok GROUP BY fault_type, tag, min_task_id),
fold AS (
  SELECT 0 AS n, CAST([] AS STRUCT(s VARCHAR, t VARCHAR)[]) AS m
  UNION ALL
  SELECT o.n, CASE WHEN list_reduce(
      list_prepend(o.tag, list_transform(range(60), lambda i: '')),
      lambda cur, x: coalesce(list_filter(f.m, lambda e: e.s = cur)[-1].t, cur)) = o.tag
    THEN list_concat(f.m, o.edges) ELSE f.m END
  FROM fold f JOIN own o ON o.n = f.n + 1),
last AS (SELECT unnest(m) AS e, generate_subscripts(m, 1) AS i FROM fold WHERE n = (SELECT max(n) FROM own))
SELECT e.s AS source, arg_max(e.t, i) AS target FROM last GROUP BY ALL""")
def accepted_merges(spark, sf):
    return mg.accepted_edges(proposals(spark, sf))


@query(f"""WITH {LOG_SQL} SELECT t AS tag, {s.report_tag('t')} AS report_tag, count(*) AS mentions
FROM (SELECT unnest(string_split(tags_text, ';')) AS t FROM log) GROUP BY ALL""")
def canonical_report_tags(spark, sf):
    tags = log(spark, sf).select(F.explode("sub_tags").alias("tag"))
    return tags.groupBy("tag", tg.report_tag(F.col("tag")).alias("report_tag")).agg(F.count(F.lit(1)).alias("mentions"))


@query(f"""WITH {s.CLUSTERED}, {_EDGES}
SELECT coalesce(e.target, c.tag) AS mapped, count(*) AS clusters, CAST(sum(frequency) AS BIGINT) AS frequency
FROM (SELECT tag, frequency FROM clusters UNION ALL SELECT 'u' || CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY user_id) c
LEFT JOIN edges e ON e.source = c.tag GROUP BY ALL""")
def tag_map_lookup(spark, sf):
    """Tags through a map that knows only some of them."""
    groups = cl.clusters(cl.named(partials(spark, sf))).select("tag", "frequency")
    users = table(spark, sf, "events").groupBy(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("tag")).agg(
        F.count(F.lit(1)).alias("frequency"))
    joined, tag = cl.mapped_tag(user_edges(spark, sf), groups.unionByName(users))
    return joined.groupBy(tag.alias("mapped")).agg(
        F.count(F.lit(1)).alias("clusters"), F.sum("frequency").alias("frequency")
    )


@query(f"WITH {s.CLUSTERED} SELECT fault_type, tag, root_cause, cliff FROM told")
def narratives_by_key(spark, sf):
    groups = cl.clusters(cl.named(partials(spark, sf)))
    told = cl.narratives_by_key(groups.withColumn("narrative", cl.narrative(fixed.MERGED_CLIFF_FORMAT)))
    return told.select(
        "fault_type", "tag", F.col("narrative.refined_root_cause").alias("root_cause"),
        F.col("narrative.capability_cliff").alias("cliff"),
    )


@query(f"""WITH {s.CLUSTERED} SELECT fault_type, tag, frequency, min_task_id, array_to_string(sample_task_ids, ',') AS sample_ids
FROM final_clusters""")
def merged_clusters(spark, sf):
    """Second clustering, from the partials of the first."""
    return cl.clusters(cl.final(partials(spark, sf), None)).select(
        "fault_type", "tag", "frequency", "min_task_id",
        F.array_join(F.col("sample_task_ids").cast("array<string>"), ",").alias("sample_ids"),
    )


@query(f"""WITH {s.CLUSTERED} SELECT rank, fault_type, tag, frequency, array_to_string(sample_task_ids, ',') AS sample_ids,
  trainability, root_cause, cliff FROM weaknesses""")
def weakness_report(spark, sf):
    """The aggregate stage over the diagnosis log."""
    return report(spark, sf).weaknesses.select(
        "rank", "fault_type", first(F.col("sub_tags")).alias("tag"), "frequency",
        F.array_join(F.col("sample_task_ids").cast("array<string>"), ",").alias("sample_ids"), "trainability",
        F.col("collective_diagnosis.refined_root_cause").alias("root_cause"),
        F.col("collective_diagnosis.capability_cliff").alias("cliff"),
    )


def _ranked(score):
    return f"array_to_string(list(rank ORDER BY {score} DESC, rank), ',')"


_DIFFICULTY = s.case_map("fault_type", fixed.DIFFICULTY_SCORE, "NULL")


@query(f"""WITH {s.CLUSTERED} SELECT {_ranked('frequency')} AS by_frequency, {_ranked(_DIFFICULTY)} AS by_difficulty,
  {_ranked('trainability')} AS by_trainability FROM weaknesses""")
def rankings(spark, sf):
    ranks = report(spark, sf).rankings
    return ranks.select(*[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ranks.columns])


@query(f"""WITH {s.CLUSTERED} SELECT fault_type, {s.case_map('fault_type', fixed.TRAINABILITY, 'CAST(0.5 AS DOUBLE)')} AS trainability,
  count(*) AS diagnoses FROM diagnoses GROUP BY ALL""")
def trainability_of_fault(spark, sf):
    rows = diagnoses(spark, sf)
    return rows.groupBy("fault_type", rp.trainability(F.col("fault_type")).alias("trainability")).agg(
        F.count(F.lit(1)).alias("diagnoses")
    )


CHAIN_SQL = "chain AS (SELECT list(tag ORDER BY trainability DESC, frequency DESC, rank) AS tags FROM weaknesses)"


@query(f"""WITH {s.CLUSTERED}, {CHAIN_SQL}
SELECT tags[1] AS root, array_to_string(tags[2:], ',') AS downstream, tags[1] AS training_priority FROM chain""")
def causal_chain(spark, sf):
    return report(spark, sf).chains.select("root", F.array_join("downstream", ",").alias("downstream"), "training_priority")


@query(f"WITH {s.CLUSTERED} SELECT DISTINCT tag AS source, {s.report_tag('tag')} AS target FROM clusters")
def report_tag_map(spark, sf):
    return report(spark, sf).tag_map


_TASK_DIAGNOSES = f"""{s.SCREEN},
task_rows AS (SELECT task_id,
    CASE WHEN route = 'deep' THEN 'implementation'
         ELSE {s.case_map('rule_tag', fixed.FAULT_TYPE_OF_TAG, 'rule_fault')} END AS fault_type,
    CASE WHEN route = 'deep' THEN 'deep_analysis' ELSE rule_tag END AS raw_tag FROM routed),
task_clusters AS (SELECT fault_type, {s.report_tag('raw_tag')} AS tag, count(*) AS frequency,
    array_to_string(list(task_id ORDER BY task_id)[1:3], ',') AS sample_ids FROM task_rows GROUP BY ALL)"""


@query(f"""WITH {_TASK_DIAGNOSES}
SELECT CAST(row_number() OVER (ORDER BY fault_type, tag) AS INTEGER) AS rank, fault_type, tag, frequency, sample_ids,
  {s.case_map('fault_type', fixed.TRAINABILITY, 'CAST(0.5 AS DOUBLE)')} AS trainability FROM task_clusters""")
def weakness_table(spark, sf):
    """Tasks screened, diagnosed, clustered and ranked end to end."""
    rows = aggregate(diagnose(tasks(spark, sf))).weaknesses
    return rows.select(
        "rank", "fault_type", first(F.col("sub_tags")).alias("tag"), "frequency",
        F.array_join(F.col("sample_task_ids").cast("array<string>"), ",").alias("sample_ids"), "trainability",
    )
