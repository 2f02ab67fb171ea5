"""Benchmark decontamination: word windows of the test items looked up in every text.

Each item gives its windows of `length` consecutive words; a shorter item is one
window.  Every window of every text is looked up by hash, a hit is verified word by
word, and hits of a document become one row.  Windows are counted and weighed first:
up to `MOST_WINDOWS` and `MOST_BYTES` their table is sent to all executors, so that only
hits and one row per document are shuffled.  Beyond it hashes of text windows are
shuffled, without words, and words are looked up for hits only.

A document is contaminated if hit words are at least `share` of its words.  Null and
empty texts have no words and are clean.  Rows with equal doc_id and text share one
outcome, each keeping its row; null doc_ids count as equal.  Items with null text or
no word give no window; a null item_id is left out of the item list.  Other columns
are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weakspot.llm.common import WORD_BREAK, read, with_names, words

LENGTH = 13
#: windows, and bytes of them, up to which their table is sent to all executors
MOST_WINDOWS = 2_000_000
MOST_BYTES = 256 << 20


def item_windows(benchmark: DataFrame, length: int = LENGTH, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(size, window, items): each window once, with the items that hold it."""
    cut = benchmark.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("words"))
    size = F.size("words")
    runs = F.transform(F.sequence(F.lit(1), size - (length - 1)), lambda i: F.slice("words", i, length))
    each = cut.filter(size > 0).select("item", F.explode_outer(F.when(size >= length, runs).otherwise(F.array("words"))).alias("window"))
    # items per window are at most the items of the benchmark
    return each.groupBy("window").agg(F.collect_set("item").alias("items")).withColumn("size", F.size("window"))


def window_hash(size: int | Column, window: Column) -> Column:
    return F.xxhash64(F.lit(size) if isinstance(size, int) else size, window)


def hashes(words_: str, size: int) -> Column:
    """Hashes of a text's windows of `size` words, in order."""
    n = F.size(words_)
    run = F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: window_hash(size, F.slice(words_, i, size)))
    return F.when(n >= size, run).otherwise(F.array().cast("array<bigint>"))


def sent_out(cut: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """(doc_id, text_hash, n_words, hit, items, whole): the table of windows is sent to all executors.

    A text's row isn't shuffled before its hits are found; one more window, of size 0,
    lets each text through once.
    """
    ends = windows.sparkSession.range(1).select(
        F.array().cast("array<string>").alias("window"), F.array().cast("array<string>").alias("items"), F.lit(0).alias("size"),
    )
    table = F.broadcast(windows.unionByName(ends).withColumn("hash", window_hash(F.col("size"), F.col("window"))))
    n = F.size("words")
    last = F.array(window_hash(0, F.array().cast("array<string>")))
    spread = cut.withColumn("hashes", F.concat(*[hashes("words", size) for size in sizes], last)).select(
        # outer, since the filter put before a plain explode would work the hashes out once more
        "doc_id", "text_hash", "words", F.posexplode_outer("hashes").alias("at", "hash"),
    )
    before = F.lit(0)
    offset = F.lit(0)
    for size in sizes:
        offset = F.when(F.col("size") == size, before).otherwise(offset)
        before = before + F.greatest(n - (size - 1), F.lit(0))
    start = F.col("at") - offset
    found = spread.join(table, "hash").filter(
        F.when(F.col("size") == 0, F.col("at") == before)
        .otherwise(F.slice("words", F.greatest(start + 1, F.lit(1)), F.col("size")) == F.col("window"))
    )
    hit = F.when(F.col("size") > 0, F.struct(start.alias("start"), F.col("size").alias("size")))
    return found.select("doc_id", "text_hash", n.alias("n_words"), hit.alias("hit"), "items", (F.col("size") == 0).alias("whole"))


def shuffled(cut: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """The same rows for any number of windows.

    Only text keys, places and hashes are shuffled to meet the windows.  Windows that may
    occur in a text are looked up in its words afterwards, in texts that have any; the
    row per text comes from the texts themselves.
    """
    def places(size: int) -> Column:
        return F.transform(hashes("words", size), lambda h, i: F.struct(h.alias("hash"), i.alias("start"), F.lit(size).alias("size")))

    placed = F.concat(F.array().cast("array<struct<hash: bigint, start: int, size: int>>"), *map(places, sizes))
    spread = cut.select("doc_id", "text_hash", F.explode_outer(placed).alias("w")).select("doc_id", "text_hash", "w.*").filter(F.col("hash").isNotNull())
    known = windows.withColumn("hash", window_hash(F.col("size"), F.col("window")))
    met = spread.join(known, ["hash", "size"]).select("doc_id", "text_hash", F.struct("start", "size").alias("hit"), "window", "items")
    likely = met.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("hit", "window", "items")).alias("likely"))  # of one text
    likely = likely.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "likely")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    seen = cut.join(likely, same).select("doc_id", "text_hash", "words", F.explode("likely").alias("x"))
    true = F.slice("words", F.col("x.hit.start") + 1, F.col("x.hit.size")) == F.col("x.window")
    none = F.lit(None).cast("struct<start: int, size: int>")
    verified = seen.filter(true).select(
        "doc_id", "text_hash", F.size("words").alias("n_words"), F.col("x.hit").alias("hit"), F.col("x.items").alias("items"), F.lit(False).alias("whole"),
    )
    texts = cut.select(
        "doc_id", "text_hash", F.size("words").alias("n_words"), none.alias("hit"), F.array().cast("array<string>").alias("items"), F.lit(True).alias("whole"),
    )
    return texts.unionByName(verified)


def hits(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per distinct (doc_id, text): words, hit ranges, items, and how many rows it stands for."""
    windows = item_windows(benchmark, length)
    # a window's words with their lengths, and its items
    room = F.octet_length(F.array_join("window", " ")) + 16 * F.size("window") + 32 * F.size("items") + 64
    counted = windows.groupBy("size").agg(F.count("*").alias("n"), F.sum(room).alias("bytes")).collect()  # at most `length` rows
    sizes = sorted((row["size"] for row in counted), reverse=True)
    small = sum(row["n"] for row in counted) <= MOST_WINDOWS and sum(row["bytes"] for row in counted) <= MOST_BYTES
    cut = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), words(F.col(text)).alias("words"))
    per_text = (
        (sent_out if small else shuffled)(cut, windows, sizes).groupBy("doc_id", "text_hash")
        .agg(
            F.max("n_words").cast("long").alias("n_words"), F.count_if("whole").alias("rows"),
            F.array_sort(F.collect_set("hit")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    covered = F.aggregate(
        "hits", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, h: F.struct(
            (s["n"] + F.greatest(F.lit(0), h["start"] + h["size"] - F.greatest(h["start"], s["end"]))).alias("n"),
            F.greatest(s["end"], h["start"] + h["size"]).alias("end"),
        ),
        lambda s: s["n"],
    )
    return per_text.withColumn("n_hit", covered.cast("long"))


def contaminated(share: float) -> Column:
    """At least that share of the words hit; the share is taken as one part of a whole number."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * round(1 / share) >= F.col("n_words"))


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", share: float = 0.05, length: int = LENGTH,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Documents without the contaminated ones, or (remove="spans") with their hit words cut out."""
    names = with_names(docs, ["id", "hash", "hits"])
    bad = hits(docs, benchmark, length, doc_id, text).filter(contaminated(share)).select(
        F.col("doc_id").alias(names["id"]), F.col("text_hash").alias(names["hash"]), F.col("hits").alias(names["hits"]),
    )
    same = F.col(doc_id).eqNullSafe(F.col(names["id"])) & (F.xxhash64(F.col(text)) == F.col(names["hash"]))
    if remove == "documents":
        return docs.join(bad, same, "left_anti")
    if remove != "spans":
        raise ValueError(f"remove: {remove}")
    # pieces of a text are a word with what follows it; what stands before the first word stays
    word = r"(?:[A-Z]|[^\x00-\x2F\x3A-\x60\x7B-\x7F])+"
    pieces = F.regexp_extract_all(F.col(text), F.lit(rf"({word}[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"), 1)
    lead = F.regexp_extract(F.col(text), r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    kept = F.filter(pieces, lambda p, i: ~F.exists(F.col(names["hits"]), lambda h: (i >= h["start"]) & (i < h["start"] + h["size"])))
    cut = F.when(F.col(names["hits"]).isNotNull(), F.concat(lead, F.array_join(kept, ""))).otherwise(F.col(text))
    joined = docs.join(bad, same, "left")
    return joined.select(*[cut.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hits(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    each = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated(0.05).alias("contaminated"),
    )


OP7_SQL = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD_BREAK}'), lambda w: w <> '') AS w
  FROM documents
), item AS (
  SELECT item_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD_BREAK}'), lambda w: w <> '') AS w
  FROM benchmark
), win AS (
  SELECT item_id, least(len(w), {LENGTH}) AS size, unnest(list_transform(range(1, greatest(len(w) - {LENGTH} + 1, 1) + 1), lambda i: array_to_string(w[i:i + least(len(w), {LENGTH}) - 1], ' '))) AS g
  FROM item WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM win), gram AS (
  SELECT r, size, unnest(range(1, len(w) - size + 2)) AS pos, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS g
  FROM doc, sizes WHERE len(w) >= size
), hit AS (SELECT r, pos, gram.size AS size, item_id FROM gram JOIN win ON gram.g = win.g AND gram.size = win.size
), words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(pos, pos + size)) AS p FROM hit) GROUP BY r
), items AS (SELECT r, list(i ORDER BY i) AS i FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(i), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(i, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
