"""Token counts and budgets over documents and conversations."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import sqltext as s
from catalog.registry import query, table
from catalog.views import TASKS_SQL, tasks
from weakspot import fixed_values as fixed
from weakspot.functions import budget as bg
from weakspot.functions.text import token_count
from weakspot.operators.diagnose import analyzer_payload

# a user turn, the assistant turn after it, a document as solution and one as tests
PAIRS_SQL = """pairs AS (
  SELECT c.conv_id * 1000 + c.turn AS task_id, c.text AS content, n.text AS completion, coalesce(d.text, '') AS canonical_solution,
    coalesce(replace(p.text, '. ', '. ' || CASE WHEN c.turn % 4 = 0 THEN '#<INSERT>' ELSE '' END), '') AS test_code
  FROM conversations c JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1 AND n.role = 'assistant'
  LEFT JOIN documents d ON d.doc_id = c.conv_id LEFT JOIN documents p ON p.doc_id = c.conv_id + c.turn + 1
  WHERE c.role = 'user')"""


def pairs(spark, sf):
    turns = table(spark, sf, "conversations")
    after = Window.partitionBy("conv_id").orderBy("turn")
    paired = turns.select(
        "*", F.lead("text").over(after).alias("completion"), F.lead("role").over(after).alias("_role"),
        F.lead("turn").over(after).alias("_turn"),
    ).filter("role = 'user' AND _role = 'assistant' AND _turn = turn + 1")
    docs = table(spark, sf, "documents")
    solution = docs.select(F.col("doc_id").alias("conv_id"), F.col("text").alias("_s"))
    tests = docs.select(F.col("doc_id").alias("_d"), F.col("text").alias("_t"))
    marker = F.when(F.col("turn") % 4 == 0, F.lit(". #<INSERT>")).otherwise(F.lit(". "))
    return (
        paired.join(solution, "conv_id", "left").join(tests, F.col("conv_id") + F.col("turn") + 1 == F.col("_d"), "left")
        .select(
            (F.col("conv_id") * 1000 + F.col("turn")).alias("task_id"), F.col("text").alias("content"), "completion",
            F.coalesce("_s", F.lit("")).alias("canonical_solution"),
            F.coalesce(F.replace("_t", F.lit(". "), marker), F.lit("")).alias("test_code"),
        )
    )


@query(f"""SELECT 'documents' AS source, CAST(sum({s.count_words('text')}) AS BIGINT) AS tokens FROM documents
UNION ALL SELECT 'conversations', CAST(sum({s.count_words('text')}) AS BIGINT) FROM conversations
UNION ALL SELECT 'pages', CAST(sum({s.count_words('html')}) AS BIGINT) FROM pages
UNION ALL SELECT 'benchmark', CAST(sum({s.count_words('text')}) AS BIGINT) FROM benchmark""")
def token_totals(spark, sf):
    texts = [("documents", "text"), ("conversations", "text"), ("pages", "html"), ("benchmark", "text")]
    parts = [
        table(spark, sf, name).agg(F.sum(token_count(F.col(column)).cast("bigint")).alias("tokens"))
        .select(F.lit(name).alias("source"), "tokens")
        for name, column in texts
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def _middle(x, n):
    w = s.words(x)
    return (
        f"CASE WHEN len({w}) <= {n} THEN {x} ELSE array_to_string({w}[1:{n // 2}], ' ') || ' ... ' || "
        f"array_to_string({w}[-{n - n // 2}:], ' ') END"
    )


def _marker(x, n):
    third = -(-n // 3)
    pre, suf = (s.words(f"substr({x}, 1, instr({x}, '#<INSERT>') - 1)"), s.words(f"substr({x}, instr({x}, '#<INSERT>'))"))
    kept = f"(CASE WHEN len({pre}) = 0 THEN [] ELSE {pre}[-{third}:] END)"
    return (
        f"CASE WHEN instr({x}, '#<INSERT>') = 0 THEN {_middle(x, n)} ELSE "
        f"array_to_string(list_concat({kept}, {suf}[1:{n} - len({kept})]), ' ') END"
    )


@query(f"SELECT doc_id, {_middle('text', 60)} AS text FROM documents")
def head_tail_shortening(spark, sf):
    return table(spark, sf, "documents").select("doc_id", bg.shorten_middle(F.col("text"), 60).alias("text"))


@query(f"WITH {PAIRS_SQL} SELECT task_id, {_marker('test_code', 50)} AS test_code FROM pairs")
def marker_shortening(spark, sf):
    return pairs(spark, sf).select("task_id", bg.shorten_around_marker(F.col("test_code"), 50).alias("test_code"))


_LIMIT = 300


def _tok(*names):
    return " + ".join(s.count_words(n) for n in names)


@query(f"""WITH {PAIRS_SQL},
a AS (SELECT *, ({_tok('content', 'completion', 'canonical_solution', 'test_code')}) > {_LIMIT} AND canonical_solution <> '' AS cut_s FROM pairs),
b AS (SELECT * REPLACE (CASE WHEN cut_s THEN '' ELSE canonical_solution END AS canonical_solution) FROM a),
c AS (SELECT *, ({_tok('content', 'completion', 'canonical_solution', 'test_code')}) > {_LIMIT} AND test_code <> '' AS cut_t FROM b),
d AS (SELECT * REPLACE (CASE WHEN cut_t THEN {_marker('test_code', 75)} ELSE test_code END AS test_code) FROM c),
e AS (SELECT *, ({_tok('content', 'completion', 'canonical_solution', 'test_code')}) > {_LIMIT} AND completion <> '' AS cut_c FROM d),
f AS (SELECT * REPLACE (CASE WHEN cut_c THEN {_middle('completion', 100)} ELSE completion END AS completion) FROM e),
g AS (SELECT *, ({_tok('content', 'completion', 'canonical_solution', 'test_code')}) > {_LIMIT} AND content <> '' AS cut_p FROM f)
SELECT task_id, CASE WHEN cut_p THEN {_middle('content', 100)} ELSE content END AS content, completion,
  canonical_solution, test_code, cut_s AS canonical_solution_truncated, cut_t AS test_code_truncated,
  cut_c AS completion_truncated FROM g""")
def staged_budget(spark, sf):
    return bg.staged_budget(pairs(spark, sf), _LIMIT)


@query(f"""WITH {PAIRS_SQL},
n AS (SELECT *, {s.count_words('content')} AS nc, {s.count_words('test_code')} AS nt, {s.count_words('canonical_solution')} AS ns FROM pairs),
o AS (SELECT *, nc + nt + ns - {_LIMIT} AS over FROM n),
k AS (SELECT *, greatest(nt - over, 0) AS kt, greatest(ns - greatest(over - nt, 0), 0) AS ks FROM o)
SELECT task_id, content, completion,
  CASE WHEN nc >= {_LIMIT} THEN '' WHEN over <= 0 THEN test_code WHEN kt = 0 THEN '' WHEN nt <= kt THEN test_code
    ELSE array_to_string({s.words('test_code')}[1:kt], ' ') END AS test_code,
  CASE WHEN nc >= {_LIMIT} THEN '' WHEN over <= 0 THEN canonical_solution WHEN ks = 0 THEN '' WHEN ns <= ks THEN canonical_solution
    ELSE array_to_string({s.words('canonical_solution')}[1:ks], ' ') END AS canonical_solution
FROM k""")
def proportional_budget(spark, sf):
    return bg.proportional_budget(pairs(spark, sf), _LIMIT)


_TASK_WORDS = " + ".join(s.count_words(c) for c in ["content", "completion", "canonical_solution", "test_code"])


@query(f"""WITH {TASKS_SQL} SELECT task_id, CASE WHEN labels_text LIKE 'programming_language=%' THEN 'python' ELSE '' END AS language,
  accepted, {_TASK_WORDS} > 20 AS solution_cut, CASE WHEN {_TASK_WORDS} > 20 THEN '' ELSE canonical_solution END AS solution,
  contains(lower(content), 'markdown') AND (contains(content, '```') OR {s.hit('lower(content)', fixed.WRAPPER_REQUEST)}) AS asks
FROM tasks""")
def analyzer_payloads(spark, sf):
    """Payload fields an analyzer receives under a budget of 20 tokens."""
    payload = analyzer_payload(tasks(spark, sf), 20).withColumn("p", F.from_json(
        "payload", "programming_language string, accepted boolean, canonical_solution string, "
        "prompt_requests_markdown_wrapper boolean, truncation_info struct<canonical_solution_truncated: boolean>"))
    return payload.select(
        "task_id", F.col("p.programming_language").alias("language"), "p.accepted",
        F.col("p.truncation_info.canonical_solution_truncated").alias("solution_cut"),
        F.col("p.canonical_solution").alias("solution"), F.col("p.prompt_requests_markdown_wrapper").alias("asks"),
    )
