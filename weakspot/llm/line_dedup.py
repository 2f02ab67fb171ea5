"""Line dedup by a log-template tree of fixed depth.

A line (between newlines, outer blanks off) is parsed into tokens at blanks; a token
with a digit counts as `<*>`.  The tree has a level for the number of tokens and one
for each of the first `depth` tokens.  The last level, a leaf, holds lines of equal
length that begin alike.

A leaf holds as many templates as its lines need.  Of n tokens at most k = n (1 -
similarity) may differ, so two lines of a template share one of k + 1 stretches of
equal length word by word.  Lines of a leaf that share a stretch form a group; the
group's most frequent line (ties: by md5) is a template, and the lines that agree with it
in at least `similarity` of their tokens belong to it: where they differ is a variable
field.  A line that belongs to several templates counts for each and goes with the one in
most documents (ties: by md5).

A template that stands in at least `min_docs` documents recurs.  Its lines stay in the
document with the smallest doc_id (null before all others) and go from all other
documents.  Empty lines stay.  Documents of which no line is left are dropped if
`drop_emptied`.

A document is a doc_id with a text: repeated rows count once and share one outcome.
Null texts have no lines and stay null.  Lines of any length are worked off whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weakspot.llm.common import held, pinned, read, with_names, written

#: leaves that recur and are sent to all executors; beyond it the join shuffles
MOST_LEAVES = 4_000_000


def masked(tokens: Column) -> Column:
    return F.regexp_replace(tokens, "[^ ]*[0-9][^ ]*", "<*>")


def n_tokens(line: Column) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def leaf(line: Column, depth: int) -> Column:
    return F.xxhash64(n_tokens(line), masked(F.substring_index(line, " ", depth)))


def distinct_lines(text: Column) -> Column:
    """Lines of a document without outer blanks and empty ones, each once.

    Explode them with explode_outer: the filter put before a plain explode would work them out twice.
    """
    return F.array_remove(F.array_distinct(F.transform(F.split(text, "\n"), lambda line: F.trim(line))), "")


def recurring_leaves(docs: DataFrame, text: str, depth: int, min_docs: int) -> DataFrame:
    lines = docs.select(F.explode_outer(distinct_lines(F.col(text))).alias("line"))
    return (
        lines.filter(F.col("line").isNotNull()).select(leaf(F.col("line"), depth).alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_docs).select("leaf")
    )


def stretches(tokens: Column, similarity: float) -> Column:
    """(at, hash) of the stretches of a form's tokens, one more than tokens may differ; `tokens` is worked out for each."""
    n = F.size(tokens)
    parts = F.floor(n * (1 - similarity) + 1e-9).cast("int") + 1
    start = lambda i: F.floor(i * n / parts).cast("int")
    return F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(tokens, start(i) + 1, start(i + 1) - start(i))).alias("hash")),
    )


def templates(lines: DataFrame, similarity: float, min_docs: int) -> DataFrame:
    """(leaf, id, template): the recurring templates that each form belongs to, from (leaf, form, id) per occurrence.

    Groups and pairs are narrow, without the words of a line; these are looked up again
    for pairs of different forms only.
    """
    variants, _ = written(lines.groupBy("leaf", "id").agg(F.count("*").alias("n"), F.min("form").alias("form")))
    # the tokens of a form are held: split for each stretch again, long lines cost the square of their length
    parted = held(variants, "tokens", F.split("form", " "))
    groups = parted.select("leaf", "id", "n", F.inline_outer(stretches(F.col("tokens"), similarity)))  # there is always one
    heads = groups.groupBy("leaf", "at", "hash").agg(F.sum("n").alias("in_all"), F.min(F.struct((-F.col("n")).alias("n"), "id")).alias("head"))
    heads = heads.filter(F.col("in_all") >= min_docs).select("leaf", "at", "hash", F.col("head.id").alias("template"))
    pairs, _ = written(groups.drop("n").join(heads, ["leaf", "at", "hash"]).select("leaf", "id", "template").distinct())
    text = variants.select("leaf", "id", F.split("form", " ").alias("tokens"))
    unlike = (
        pairs.filter("id <> template").join(text, ["leaf", "id"])
        .join(text.select("leaf", F.col("id").alias("template"), F.col("tokens").alias("own")), ["leaf", "template"])
    )
    equal = F.size(F.filter(F.zip_with("tokens", "own", lambda a, b: a == b), lambda same: same))
    close = unlike.filter(equal >= F.lit(similarity) * F.size("own")).select("leaf", "id", "template")
    return pairs.filter("id = template").unionByName(close)


def dropped_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", depth: int = 4, min_docs: int = 3, similarity: float = 0.8,
) -> DataFrame:
    """(doc_id, text_hash, lines): ids of the forms that go, per distinct document that loses any."""
    leaves = pinned(recurring_leaves(docs, text, depth, min_docs))
    if leaves.count() <= MOST_LEAVES:
        leaves = F.broadcast(leaves)
    each = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.explode_outer(distinct_lines(F.col(text))).alias("line"),
    ).filter(F.col("line").isNotNull()).withColumn("leaf", leaf(F.col("line"), depth)).join(leaves, "leaf", "left_semi")
    lines, _ = written(each.withColumn("form", masked(F.col("line"))).select("doc_id", "text_hash", "leaf", "form", F.md5("form").alias("id")))
    member, _ = written(templates(lines, similarity, min_docs))
    places = lines.select("doc_id", "text_hash", "leaf", "id")
    counted = (
        places.join(member, ["leaf", "id"]).select("leaf", "template", "doc_id", "text_hash").distinct()
        .groupBy("leaf", "template").agg(F.count("*").alias("in_docs")).filter(F.col("in_docs") >= min_docs)
    )
    best = member.join(counted, ["leaf", "template"]).groupBy("leaf", "id").agg(F.min(F.struct((-F.col("in_docs")).alias("n"), "template")).alias("best"))
    # kept first, here and below: a join of two plain shuffles can split the rows of a frequent line
    best, _ = written(best.select("leaf", "id", "best.template"))
    going, _ = written(places.join(best, ["leaf", "id"]))
    first = going.groupBy("leaf", "template").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("unnamed"))
    first, _ = written(first.select("leaf", "template", F.when(~F.col("unnamed"), F.col("first")).alias("first")))
    return (
        going.join(first, ["leaf", "template"]).filter(~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "text_hash").agg(F.collect_set("id").alias("lines"))  # within one document
    )


def without_recurring_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", depth: int = 4, min_docs: int = 3, similarity: float = 0.8,
    counts: tuple[str, str] | None = None, drop_emptied: bool = False,
) -> DataFrame:
    """Documents with the lines of recurring templates cut out; `counts` names columns for all and dropped lines."""
    names = with_names(docs, ["id", "hash", "lines", "all", "kept"])
    going = dropped_lines(docs, text, doc_id, depth, min_docs, similarity).select(
        F.col("doc_id").alias(names["id"]), F.col("text_hash").alias(names["hash"]), F.col("lines").alias(names["lines"]),
    )
    same = F.col(doc_id).eqNullSafe(F.col(names["id"])) & (F.xxhash64(F.col(text)) == F.col(names["hash"]))
    gone = F.col(names["lines"])
    cut = docs.join(going, same, "left").withColumn(names["all"], F.split(F.col(text), "\n"))
    # worked out once, and for documents that lose lines only
    cut = held(cut, names["kept"], F.when(
        gone.isNotNull(), F.filter(names["all"], lambda line: ~F.array_contains(gone, F.md5(masked(F.trim(line))))),
    ).otherwise(F.col(names["all"])))
    if drop_emptied:
        empty = F.forall(names["kept"], lambda line: F.trim(line) == "")
        cut = cut.filter(gone.isNull() | ~empty)
    result = F.when(gone.isNotNull(), F.array_join(names["kept"], "\n")).otherwise(F.col(text))
    columns = [result.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        n_all = F.coalesce(F.size(names["all"]), F.lit(0)).cast("long")
        columns += [F.when(F.col(text).isNull(), 0).otherwise(n_all).cast("long").alias(counts[0]),
                    F.when(F.col(text).isNull(), 0).otherwise(n_all - F.size(names["kept"])).cast("long").alias(counts[1])]
    return cut.select(*columns)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    cut = without_recurring_lines(docs, counts=("n_lines", "n_dropped"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT DISTINCT r, doc_id, text, line FROM (SELECT r, doc_id, text, trim(unnest(lines), ' ') AS line FROM doc WHERE text IS NOT NULL) WHERE line <> ''),
keyed AS (SELECT r, doc_id, coalesce(CAST(doc_id AS VARCHAR), '-') || ' ' || md5(text) AS document,
  regexp_replace(line, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS form FROM line),
leafed AS (SELECT *, len(string_split(form, ' ')) || ' ' || array_to_string(string_split(form, ' ')[1:4], ' ') AS leaf FROM keyed),
variant AS (SELECT leaf, form, md5(form) AS id, string_split(form, ' ') AS t, count(*) AS n FROM leafed GROUP BY leaf, form),
parted AS (SELECT *, len(t) AS size, CAST(floor(len(t) * (1 - 0.8) + 1e-9) AS BIGINT) + 1 AS parts FROM variant),
stretch AS (SELECT leaf, form, id, n, i || ' ' || array_to_string(t[i * size // parts + 1:(i + 1) * size // parts], ' ') AS part
  FROM (SELECT *, unnest(range(0, parts)) AS i FROM parted)),
head AS (SELECT leaf, part, arg_min(form, {'n': -n, 'id': id}) AS template FROM stretch GROUP BY leaf, part HAVING sum(n) >= 3),
pair AS (SELECT DISTINCT leaf, form, template FROM stretch JOIN head USING (leaf, part)),
member AS (SELECT leaf, form, template FROM (SELECT *, string_split(form, ' ') AS a, string_split(template, ' ') AS b FROM pair)
  WHERE len(list_filter(range(1, len(a) + 1), lambda i: a[i] = b[i])) >= 0.8 * len(b)),
recurring AS (SELECT leaf, template, count(DISTINCT document) AS n FROM leafed JOIN member USING (leaf, form) GROUP BY ALL HAVING count(DISTINCT document) >= 3),
best AS (SELECT leaf, form, arg_min(template, {'n': -n, 'id': md5(template)}) AS template FROM member JOIN recurring USING (leaf, template) GROUP BY leaf, form),
placed AS (SELECT r, doc_id, leaf, form, template FROM leafed JOIN best USING (leaf, form)),
first AS (SELECT leaf, template, CASE WHEN NOT bool_or(doc_id IS NULL) THEN min(doc_id) END AS first FROM placed GROUP BY ALL),
gone AS (SELECT r, list(form) AS g FROM placed JOIN first USING (leaf, template) WHERE doc_id IS DISTINCT FROM first GROUP BY r),
cut AS (SELECT doc_id, text, lines, CASE WHEN g IS NULL THEN lines
    ELSE list_filter(lines, lambda x: NOT list_contains(g, regexp_replace(trim(x, ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g'))) END AS rest
  FROM doc LEFT JOIN gone USING (r))
SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(lines) END AS BIGINT) AS n_lines,
  CAST(CASE WHEN text IS NULL THEN 0 ELSE len(lines) - len(rest) END AS BIGINT) AS n_dropped,
  sha256(CASE WHEN text IS NULL THEN '' ELSE array_to_string(rest, chr(10)) END) AS kept_sha256
FROM cut
"""
