"""Top weaknesses, slots, evidence and diversity."""

from functools import reduce

from pyspark.sql import functions as F

from catalog import sqltext as s
from catalog.aggregation import CHAIN_SQL, diagnoses, report
from catalog.registry import query, table
from weakspot import fixed_values as fixed

from weakspot.operators import diversity as dv
from weakspot.operators import slots as sl
from weakspot.plans.synthesize import Settings, allocated

TOP = Settings(top_n=4)
PICKED_SQL = f"""{s.CLUSTERED}, {CHAIN_SQL},
best AS (SELECT * FROM (SELECT *, tag AS key, row_number() OVER (PARTITION BY tag ORDER BY rank) AS nth FROM weaknesses) WHERE nth = 1),
top AS (SELECT * FROM best ORDER BY rank LIMIT 4),
allocated AS (SELECT top.*, top.key = (SELECT tags[1] FROM chain) AS is_root,
    CAST(least(3 + CASE WHEN top.key = (SELECT tags[1] FROM chain) THEN 2 ELSE 0 END
      + CASE WHEN trainability >= 0.8 THEN 1 ELSE 0 END, 8) AS INTEGER) AS n_slots FROM top),
slot_rows AS (SELECT *, CAST(unnest(range(n_slots)) AS INTEGER) AS slot FROM allocated)"""

# one weakness per user: their events as frequency, keys shared by many users
USER_WEAKNESS_SQL = """user_weak AS (
  SELECT CAST(user_id AS INTEGER) AS rank, CASE user_id % 5 WHEN 0 THEN 'modeling' WHEN 1 THEN 'surface' ELSE 'implementation' END AS fault_type,
    CASE WHEN user_id % 11 = 0 THEN NULL ELSE 'tag_' || CAST(user_id * 7 % 23 AS VARCHAR) END AS tag, count(*) AS frequency
  FROM events GROUP BY user_id)"""


def user_weaknesses(spark, sf):
    fault = F.when(F.col("user_id") % 5 == 0, "modeling").when(F.col("user_id") % 5 == 1, "surface").otherwise("implementation")
    tag = F.concat(F.lit("tag_"), (F.col("user_id") * 7 % 23).cast("string"))
    tags = F.when(F.col("user_id") % 11 == 0, F.array().cast("array<string>")).otherwise(F.array(tag))
    return table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("frequency")).select(
        F.col("user_id").cast("int").alias("rank"), fault.alias("fault_type"), tags.alias("sub_tags"), "frequency"
    )


@query(f"""WITH {USER_WEAKNESS_SQL}, keyed AS (SELECT *, coalesce(tag, fault_type || '_' || CAST(rank AS VARCHAR)) AS key FROM user_weak),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rank) AS nth FROM keyed) WHERE nth = 1)
SELECT key, rank, fault_type, frequency FROM best ORDER BY rank LIMIT 20""")
def top_distinct_keys(spark, sf):
    return sl.top_weaknesses(user_weaknesses(spark, sf), 20).select("key", "rank", "fault_type", "frequency")


@query(f"WITH {PICKED_SQL} SELECT key, rank, is_root, n_slots FROM allocated")
def slot_allocation(spark, sf):
    return allocated(report(spark, sf), TOP).select("key", "rank", "is_root", "n_slots")


@query(f"""WITH {PICKED_SQL} SELECT w.rank, w.tag AS key, w.tag = (SELECT tags[1] FROM chain) AS is_root FROM weaknesses w""")
def root_flags(spark, sf):
    found = report(spark, sf)
    return sl.with_root_flag(sl.keyed(found.weaknesses), found.chains).select("rank", "key", "is_root")


def _difficulty_query(name, distribution, medium):
    sql = f"WITH {PICKED_SQL} SELECT key, slot, CASE WHEN {medium} THEN 'medium' ELSE 'hard' END AS difficulty FROM slot_rows"

    @query(sql, name=name)
    def difficulties(spark, sf):
        return sl.slots(allocated(report(spark, sf), TOP), distribution).select("key", "slot", "difficulty")


_difficulty_query("balanced_slots", "balanced", "slot < n_slots / 2")
_difficulty_query("hard_weighted_slots", "weighted_hard", "slot % 3 = 1")


@query(f"WITH {PICKED_SQL} SELECT CAST(sum(n_slots) AS BIGINT) AS slots FROM allocated")
def planned_slot_total(spark, sf):
    return allocated(report(spark, sf), TOP).agg(F.sum("n_slots").alias("slots"))


# samples of a weakness as listed; the keys of ranks 1 and 5 name tasks nobody
# diagnosed, so they fall back to the first rows carrying one of their tags
EVIDENCE_SQL = f"""{PICKED_SQL},
listed AS (SELECT key, unnest(CASE WHEN rank IN (1, 5) THEN [-1] ELSE list_reverse(sample_task_ids) END) AS task_id,
    generate_subscripts(CASE WHEN rank IN (1, 5) THEN [-1] ELSE list_reverse(sample_task_ids) END, 1) AS spot FROM best),
own AS (SELECT key, task_id, spot, wrong_line, correct_approach, failed_test FROM listed JOIN diagnoses USING (task_id)),
tagged_rows AS (SELECT {s.report_tag('t')} AS report_key, t, * FROM (SELECT unnest(sub_tags) AS t, generate_subscripts(sub_tags, 1) AS spot, * FROM diagnoses)),
other AS (SELECT coalesce(CASE WHEN t IN (SELECT tag FROM clusters) THEN report_key END, t) AS key, task_id, spot, wrong_line, correct_approach, failed_test
  FROM tagged_rows),
samples AS (
  SELECT key, row_number() OVER (PARTITION BY key ORDER BY spot) AS nth, wrong_line, correct_approach, failed_test FROM own
  UNION ALL
  SELECT key, row_number() OVER (PARTITION BY key ORDER BY task_id, spot), wrong_line, correct_approach, failed_test FROM other
  WHERE key IN (SELECT key FROM best) AND key NOT IN (SELECT key FROM own)),
first_three AS MATERIALIZED (SELECT key, nth - 1 AS pos, wrong_line, correct_approach, failed_test FROM samples WHERE nth <= 3)"""


def evidence_samples(spark, sf, found=None):
    found = found or report(spark, sf)
    ids = F.when(F.col("rank").isin(1, 5), F.array(F.lit(-1).cast("bigint"))).otherwise(F.reverse("sample_task_ids"))
    weak = found.weaknesses.withColumn("sample_task_ids", ids)
    return sl.sample_evidence(weak, diagnoses(spark, sf), found.tag_map)


@query(f"WITH {EVIDENCE_SQL} SELECT key, pos, wrong_line, correct_approach, failed_test FROM first_three")
def representative_evidence(spark, sf):
    return evidence_samples(spark, sf).select("key", F.col("pos").cast("bigint").alias("pos"), "evidence.*")


def _joined(field):
    return f"array_to_string({s.distinct(f'list({field} ORDER BY pos)')}, ' | ') AS {field}"


@query(f"""WITH {EVIDENCE_SQL} SELECT key, {_joined('wrong_line')}, {_joined('correct_approach')}, {_joined('failed_test')}
FROM first_three GROUP BY key""")
def merged_evidence(spark, sf):
    return sl.merged_evidence(evidence_samples(spark, sf)).select("key", "evidence.*")


# slots of every weakness key and of two keys nobody has evidence for
@query(f"""WITH {EVIDENCE_SQL},
all_slots AS (SELECT key, unnest(range(5)) AS slot FROM (SELECT key FROM best UNION ALL SELECT 'lost_' || event_type FROM events GROUP BY event_type)),
n AS (SELECT key, count(*) AS n FROM first_three GROUP BY key)
SELECT a.key, a.slot, coalesce(t.wrong_line, 'Representative ' || a.key || ' failure pattern.') AS wrong_line,
  coalesce(t.correct_approach, 'Implement the required ' || a.key || ' contract correctly.') AS correct_approach,
  coalesce(t.failed_test, 'Representative failure unavailable for ' || a.key) AS failed_test
FROM all_slots a LEFT JOIN n USING (key) LEFT JOIN first_three t ON t.key = a.key AND t.pos = a.slot % n.n""")
def slot_evidence(spark, sf):
    found = report(spark, sf)
    keys = sl.first_per_key(found.weaknesses).select("key").union(
        table(spark, sf, "events").select(F.concat(F.lit("lost_"), "event_type")).distinct()
    )
    slots = keys.select("key", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("slot"))
    return sl.with_slot_evidence(slots, evidence_samples(spark, sf, found)).select(
        "key", F.col("slot").cast("bigint").alias("slot"), "evidence.*"
    )


# parts as specs: type as key, brand, name and size class as the dimensions
CORPUS_SQL = """corpus AS (SELECT p_type AS key, p_brand AS narrative_theme, p_name AS data_structure,
  CASE WHEN p_size <= 16 THEN 'small' WHEN p_size <= 33 THEN 'medium' ELSE 'large' END AS constraint_scale,
  p_partkey AS seq, 'spec-' || CAST(p_partkey AS VARCHAR) AS spec_id FROM part)"""


def corpus(spark, sf):
    scale = F.when(F.col("p_size") <= 16, "small").when(F.col("p_size") <= 33, "medium").otherwise("large")
    return table(spark, sf, "part").select(
        F.col("p_type").alias("key"), F.col("p_brand").alias("narrative_theme"), F.col("p_name").alias("data_structure"),
        scale.alias("constraint_scale"), F.col("p_partkey").alias("seq"),
        F.concat(F.lit("spec-"), F.col("p_partkey").cast("string")).alias("spec_id"),
    )


def _overlap(a, b):
    return "(" + " + ".join(f"CASE WHEN {a}.{d} = {b}.{d} THEN 1 ELSE 0 END" for d in dv.DIMENSIONS) + ") / 3.0"


def _conflict_query(name, threshold):
    sql = f"""WITH {CORPUS_SQL}, pairs AS (
      SELECT c.spec_id, e.seq, e.spec_id AS other, CAST({_overlap('c', 'e')} AS DOUBLE) AS overlap
      FROM corpus c JOIN corpus e ON c.key = e.key AND e.seq < c.seq),
    judged AS (SELECT spec_id, min(CASE WHEN overlap > {threshold} THEN seq END) AS first_seq, max(overlap) AS highest FROM pairs GROUP BY spec_id)
    SELECT c.spec_id, j.first_seq IS NULL AS accepted,
      coalesce((SELECT p.overlap FROM pairs p WHERE p.spec_id = c.spec_id AND p.seq = j.first_seq), j.highest, 0) AS overlap_score,
      CASE WHEN j.first_seq IS NULL THEN 'Candidate diversity tags accepted.'
        ELSE 'Candidate diversity tags overlap above threshold with spec-' || CAST(j.first_seq AS VARCHAR) || '.' END AS reason
    FROM corpus c LEFT JOIN judged j USING (spec_id)"""

    @query(sql, name=name)
    def conflicts(spark, sf):
        specs = corpus(spark, sf)
        return dv.assigned(specs, specs, threshold, earlier_only=True).select("spec_id", "accepted", "overlap_score", "reason")


_conflict_query("diversity_conflicts", 0.5)
_conflict_query("strict_diversity_conflicts", 0.1)
_conflict_query("exact_diversity_conflicts", 0.7)

# per part type: as many slots as its brands allow, themes from its brands
PLAN_KEYS_SQL = """keys AS (SELECT p_type AS key, CAST(3 + count(*) % 6 AS INTEGER) AS n_slots FROM part GROUP BY p_type)"""
THEMES_SQL = """themes AS (SELECT key, n_slots, list_concat(['ports', 'farms'],
  list_transform(range(1, greatest(n_slots * 3, 6) + 1), lambda i: CASE WHEN i = 1 THEN key ELSE key || '_' || CAST(i AS VARCHAR) END)) AS themes FROM keys)"""
SPACE_SQL = f"""space AS (SELECT key, n_slots, theme AS narrative_theme, d AS data_structure, c AS constraint_scale, ti * 24 + di * 3 + ci AS seq
  FROM (SELECT *, unnest({list(fixed.CONSTRAINT_SCALES)}) AS c, unnest(range(3)) AS ci FROM (
    SELECT *, unnest({list(fixed.DATA_STRUCTURES)}) AS d, unnest(range(8)) AS di FROM (
      SELECT key, n_slots, unnest(themes) AS theme, unnest(range(len(themes))) AS ti FROM themes))))"""


def plan_keys(spark, sf):
    return table(spark, sf, "part").groupBy(F.col("p_type").alias("key")).agg(
        (F.lit(3) + F.count(F.lit(1)) % 6).cast("int").alias("n_slots")
    )


@query(f"WITH {PLAN_KEYS_SQL}, {THEMES_SQL} SELECT key, array_to_string(themes, ',') AS themes FROM themes")
def candidate_themes(spark, sf):
    themes = dv.candidate_themes(F.col("key"), F.col("n_slots"), ["ports", "farms", "ports"])
    return plan_keys(spark, sf).select("key", F.array_join(themes, ",").alias("themes"))


@query(f"WITH {PLAN_KEYS_SQL}, {THEMES_SQL}, {SPACE_SQL} SELECT key, seq, narrative_theme, data_structure, constraint_scale FROM space")
def candidate_space(spark, sf):
    themes = dv.candidate_themes(F.col("key"), F.col("n_slots"), ["ports", "farms"])
    rows = plan_keys(spark, sf).select("key", themes.alias("themes"))
    return dv.candidate_space(rows).select("key", "seq", *dv.DIMENSIONS)


# earlier specs of every type, made from its parts
PRIOR_SQL = f"""prior AS (SELECT DISTINCT p_type AS key, CASE p_partkey % 3 WHEN 0 THEN 'ports' WHEN 1 THEN 'farms' ELSE p_type END AS narrative_theme,
  CASE p_size % 5 WHEN 0 THEN 'array' WHEN 1 THEN 'heap' ELSE 'list' END AS data_structure,
  CASE WHEN p_size <= 20 THEN 'small' ELSE 'large' END AS constraint_scale FROM part)"""


def prior(spark, sf):
    part = table(spark, sf, "part")
    theme = F.when(F.col("p_partkey") % 3 == 0, "ports").when(F.col("p_partkey") % 3 == 1, "farms").otherwise(F.col("p_type"))
    structure = F.when(F.col("p_size") % 5 == 0, "array").when(F.col("p_size") % 5 == 1, "heap").otherwise("list")
    return part.select(
        F.col("p_type").alias("key"), theme.alias("narrative_theme"), structure.alias("data_structure"),
        F.when(F.col("p_size") <= 20, "small").otherwise("large").alias("constraint_scale"),
        F.col("p_partkey").alias("seq"), F.col("p_partkey").cast("string").alias("spec_id"),
    )




@query(f"""WITH RECURSIVE {PLAN_KEYS_SQL}, {THEMES_SQL}, {SPACE_SQL}, {PRIOR_SQL},
free AS (SELECT * FROM space s WHERE NOT EXISTS (SELECT 1 FROM prior p WHERE p.key = s.key AND {_overlap('p', 's')} > 0.5)),
walk AS (SELECT key, n_slots, {{'narrative_theme': narrative_theme, 'data_structure': data_structure, 'constraint_scale': constraint_scale}} AS c,
  row_number() OVER (PARTITION BY key ORDER BY seq) AS n FROM free),
fold AS (
  SELECT key, n_slots, CAST(0 AS BIGINT) AS n, [c][2:] AS taken FROM walk WHERE n = 1
  UNION ALL
  SELECT f.key, f.n_slots, w.n, CASE WHEN len(list_filter(f.taken, lambda t: {_overlap('t', 'c').replace('c.', 'w.c.')} > 0.5)) = 0
    THEN list_append(f.taken, w.c) ELSE f.taken END
  FROM fold f JOIN walk w ON w.key = f.key AND w.n = f.n + 1 WHERE len(f.taken) < f.n_slots),
done AS (SELECT key, arg_max(taken, n) AS taken FROM fold GROUP BY key),
out AS (SELECT key, unnest(taken) AS t, CAST(unnest(range(len(taken))) AS INTEGER) AS slot FROM done)
SELECT key, slot, t.narrative_theme, t.data_structure, t.constraint_scale FROM out""")
def diversity_plan(spark, sf):
    """Greedy plan of new tags per part type, around the earlier specs."""
    planned = dv.plan(plan_keys(spark, sf), prior(spark, sf), ["ports", "farms"])
    return planned.select("key", "slot", "diversity_tags.*")


@query(f"""WITH {CORPUS_SQL}, some_keys AS (SELECT p_type AS key FROM part GROUP BY p_type HAVING count(*) % 2 = 0)
SELECT spec_id, key FROM corpus WHERE key IN (SELECT key FROM some_keys)""")
def relevant_specs(spark, sf):
    counts = table(spark, sf, "part").groupBy(F.col("p_type").alias("key")).count().filter("count % 2 = 0")
    return dv.relevant_specs(corpus(spark, sf), counts).select("spec_id", "key")


@query(f"""WITH {CORPUS_SQL}, {PRIOR_SQL}
SELECT narrative_theme, constraint_scale, count(*) AS specs FROM (
  SELECT narrative_theme, constraint_scale FROM corpus UNION ALL SELECT narrative_theme, constraint_scale FROM prior) GROUP BY ALL""")
def baseline_union(spark, sf):
    """Earlier and new specs as one baseline."""
    parts = [corpus(spark, sf), prior(spark, sf).dropDuplicates(["key", *dv.DIMENSIONS])]
    both = reduce(lambda a, b: a.unionByName(b), [p.select("key", *dv.DIMENSIONS) for p in parts])
    return both.groupBy("narrative_theme", "constraint_scale").agg(F.count(F.lit(1)).alias("specs"))
