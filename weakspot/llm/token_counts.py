"""Token counts: exact length histogram with suffix sums.

Texts are encoded with a public byte-level BPE vocabulary, whose file is a parameter,
and counted by encoded length.  One row per length then answers every context limit:
documents and tokens at least as long (suffix sums), and the tokens left when every
text is cut at that length.  `at_limits` and `quantiles` read any limit or quantile
off the histogram.

Null and empty texts have length 0.  Repeated rows count each time.  An empty table
gives no rows.  Grouping columns may hold nulls, which are a group of their own.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weakspot.llm.common import pinned, read

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MOST_VOCABULARY_BYTES = 64_000_000
# fixed value: how the vocabulary splits a text before encoding
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: lengths that are summed up together before the sums are joined
SPAN = 4096


def vocabulary_bytes(path: str) -> bytes:
    """The file as the driver sees it; it is sent to the executors, so its size is checked."""
    with open(path, "rb") as file:
        content = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(content) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary of over {MOST_VOCABULARY_BYTES} bytes: {path}")
    return content


def encoding(content: bytes):
    import tiktoken

    ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, content.splitlines())}
    return tiktoken.Encoding("given", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def with_length(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, name: str = "n_tokens") -> DataFrame:
    content = docs.sparkSession.sparkContext.broadcast(vocabulary_bytes(vocabulary))

    @F.pandas_udf("long")
    def length(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = encoding(content.value)
        for batch in values:
            yield pd.Series([len(ready.encode_ordinary(v)) if v else 0 for v in batch], dtype="int64")

    return docs.withColumn(name, length(F.col(text)))


def histogram(counted: DataFrame, by: list[str] | None = None, length: str = "n_tokens") -> DataFrame:
    """Rows per encoded length and group, with suffix sums.

    Sums run within spans of lengths, then over the spans, so that no task has more
    than `SPAN` lengths or all spans of one group before it.
    """
    by = by or []
    sizes = counted.groupBy(*by, F.col(length).alias("length")).agg(F.count("*").alias("n_docs"))
    # a row per length, read twice below
    sizes = pinned(sizes.withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("_span", F.expr(f"length div {SPAN}")))
    within = Window.partitionBy(*by, "_span").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    spans = sizes.groupBy(*by, "_span").agg(F.sum("n_docs").alias("_docs"), F.sum("n_tokens").alias("_tokens"))
    longer = Window.partitionBy(*by).orderBy(F.desc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    spans = spans.select(
        *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], F.col("_span").alias("_of"),
        F.coalesce(F.sum("_docs").over(longer), F.lit(0)).alias("_docs_beyond"),
        F.coalesce(F.sum("_tokens").over(longer), F.lit(0)).alias("_tokens_beyond"),
        F.sum("_tokens").over(whole).alias("_all_tokens"), F.sum("_docs").over(whole).alias("_all_docs"),
    )
    same = F.col("_span") == F.col("_of")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    docs = F.sum("n_docs").over(within) + F.col("_docs_beyond")
    tokens = F.sum("n_tokens").over(within) + F.col("_tokens_beyond")
    return (
        sizes.join(spans, same)
        .withColumn("docs_at_least", docs).withColumn("tokens_at_least", tokens)
        .select(
            *by, "length", "n_docs", "n_tokens", "docs_at_least", "tokens_at_least",
            (F.col("_all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("tokens_cut_here"),
            ((F.col("_all_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("_all_docs")).alias("share_up_to"),
        )
    )


def at_limits(histogram: DataFrame, limits: list[int], by: list[str] | None = None) -> DataFrame:
    """Per limit: documents and tokens in all, documents over it, tokens when cut at it."""
    limit = F.explode(F.array(*[F.lit(v).cast("long") for v in limits]))
    rows = histogram.withColumn("limit", limit)
    return rows.groupBy(*(by or []), "limit").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.when(F.col("length") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_over"),
        F.sum(F.least("length", "limit") * F.col("n_docs")).alias("tokens_cut"),
    )


def quantiles(histogram: DataFrame, shares: list[float], by: list[str] | None = None) -> DataFrame:
    """Smallest length up to which at least the given share of documents goes."""
    rows = histogram.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    return rows.filter(F.col("share_up_to") >= F.col("share")).groupBy(*(by or []), "share").agg(F.min("length").alias("length"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(with_length(read(spark, sf_dir, "documents").select("text")).select("n_tokens"))
