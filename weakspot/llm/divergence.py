"""Source divergence audit: how far the term shares of each (lang, source) lie apart.

Each language keeps the terms that stand in enough of its documents.  Shares are whole
numbers p = 1 + floor(10^9 (count + 2) / (N + 2 V)), the distance of two groups is
the sum of f = floor((p - q)^2 / (p + q)) over all kept terms, the absent ones too.

    sum f = V f(p0, q0)                         no term of either group
          + sum over the group's terms of f(p, q0) - f(p0, q0)
          + sum over the peer's terms of  f(p0, q) - f(p0, q0)
          + sum over shared terms of      f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

with p0 and q0 the shares of absent terms (zero baselines).  The middle sums depend on
counts alone and come from one histogram per group.  The last is Gustavson's row
accumulation: within a run of whole terms each group scatters its postings through the
term-major index into one dense accumulator of its peers, and only the sums per
(group, peer) leave the task.  No pair of postings is ever a row.  Everything is in
whole numbers, so that the order of work doesn't matter.

Nulls in lang, source and text count as ''.  Repeated rows count each; other columns
are not read.  Groups without terms are there with baselines only; a language without
kept terms has distances 0.  An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weakspot.llm.common import read, written

SCALE = 1_000_000_000
#: UTF-8 bytes to term bytes: A-Z lowered, whatever is no letter a blank
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: counts held by a task before they are passed on, postings worked off together, matches worked off at once
HELD, RUN, MATCHES = 400_000, 200_000, 2_000_000
#: groups per bucket of a language where groups meet their peers
BUCKET = 256


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, summed up within tasks only."""

    def frame(counts: dict[tuple[str, str], tuple[Counter, Counter]]) -> pd.DataFrame:
        rows = [(l, s, t.decode("utf-8", "replace"), n, seen[t]) for (l, s), (all_, seen) in counts.items() for t, n in all_.items()]
        return pd.DataFrame(rows, columns=["lang", "source", "term", "n", "docs"])

    def counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, size = {}, 0
        for batch in batches:
            for l, s, value in zip(*(batch[c] for c in batch.columns)):
                occurrences, seen = counts.setdefault((l, s), (Counter(), Counter()))
                before, found = len(occurrences), Counter(value.encode("utf-8", "replace").translate(TERM_BYTES).split())
                occurrences.update(found)
                seen.update(found.keys())
                size += len(occurrences) - before
                if size > HELD:
                    yield frame(counts)
                    counts, size = {}, 0
        if size:  # an empty frame has no types
            yield frame(counts)

    filled = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    return filled.mapInPandas(counted, "lang string, source string, term string, n long, docs long")


def kept_postings(docs: DataFrame, least_docs: int = 10, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, total, head): terms kept by their language; head marks one posting per term."""
    whole = Window.partitionBy("lang", "term")
    # dealt by (lang, term) once: sums per source, then over the sources of a term, need no second shuffle
    summed = (
        term_counts(docs, lang, source, text).repartition("lang", "term")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    held = summed.select(
        "lang", "source", "term", "n", F.sum("n").over(whole).alias("total"), F.sum("docs").over(whole).alias("in_docs"),
        (F.min("source").over(whole) == F.col("source")).alias("head"),
    )
    return held.filter(F.col("in_docs") >= least_docs).drop("in_docs")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + 2) / (total + 2 terms)) without rounding; null without terms."""
    over = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    by = F.nullif(total + 2 * terms, F.lit(0)).cast("decimal(20,0)")
    return F.call_function("div", over, by) + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def accumulated(run: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Sums over the shared terms of one language, for postings that are sorted by term and hold their terms whole."""
    groups, names = pd.factorize(run["source"])
    terms, _ = pd.factorize(run["term"])
    p, p0 = run["p"].to_numpy(), run["p0"].to_numpy()
    # the term-major index: where each posting's term begins, and how many postings it has
    sizes = np.bincount(terms)
    starts = (np.cumsum(sizes) - sizes)[terms]
    sizes = sizes[terms]
    by_group = np.argsort(groups, kind="stable")
    bounds = np.searchsorted(groups[by_group], np.arange(len(names) + 1))
    for g, name in enumerate(names):
        row = by_group[bounds[g] : bounds[g + 1]]
        peers = np.zeros(len(names), np.int64)
        pieces = np.unique(np.searchsorted(np.cumsum(sizes[row]), np.arange(0, sizes[row].sum(), MATCHES)))
        for low, high in zip(pieces, [*pieces[1:], len(row)]):
            mine = np.repeat(row[low:high], sizes[row[low:high]])
            ends = np.cumsum(sizes[row[low:high]])
            theirs = starts[mine] + np.arange(len(mine)) - np.repeat(ends - sizes[row[low:high]], sizes[row[low:high]])
            a, a0, b, b0 = p[mine], p0[mine], p[theirs], p0[theirs]
            np.add.at(peers, groups[theirs], distance(a, b) - distance(a, b0) - distance(a0, b) + distance(a0, b0))
        peers[g] = 0
        met = np.flatnonzero(peers)
        if len(met):
            yield pd.DataFrame({"lang": run["lang"].iloc[0], "source": name, "item": names[met], "value": peers[met]})


def shared_sums(postings: DataFrame) -> DataFrame:
    """(lang, source, item, value): parts of the sums over shared terms."""

    def runs(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def worked(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for _, run in frame.groupby("lang", sort=False):
                yield from accumulated(run)

        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size < RUN:
                continue
            frame = pd.concat(held, ignore_index=True)
            # the last term may go on in the next batch
            last = (frame["lang"] == frame["lang"].iloc[-1]) & (frame["term"] == frame["term"].iloc[-1])
            yield from worked(frame[~last].reset_index(drop=True))
            held, size = [frame[last]], int(last.sum())
        if held:
            yield from worked(pd.concat(held, ignore_index=True))

    dealt = postings.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
    return dealt.mapInPandas(runs, "lang string, source string, item string, value long")


def divergences(
    docs: DataFrame, least_docs: int = 10, top: int = 10, lang: str = "lang", source: str = "source", text: str = "text",
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to all peers, and the terms most above the language's share."""
    kept, _ = written(kept_postings(docs, least_docs, lang, source, text))
    occurring = docs.select(F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(source, F.lit("")).alias("source")).distinct()
    per_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    per_lang = kept.groupBy("lang").agg(F.count_if("head").alias("terms"), F.sum("n").alias("all"))
    counted = occurring.join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left").fillna(0, ["own", "terms", "all"])
    groups, _ = written(counted.withColumn("p0", share(F.lit(0), F.col("own"), F.col("terms"))))

    priced = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("own"), F.col("terms")))
    by_value = [F.col("value").desc(), F.col("item")]
    ranked = Window.partitionBy("lang", "source").orderBy(*by_value)
    q = share(F.col("total"), F.col("all"), F.col("terms"))
    above = priced.withColumn("q", q).filter("p > q").select("lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    terms = above.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)

    # peers of a language are dealt to buckets of its groups; p is null in the row for terms that no one has
    buckets = groups.groupBy("lang").agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("buckets"))
    bucket = F.pmod(F.xxhash64("source"), F.col("buckets")).cast("int")
    histogram = priced.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("n"))
    baseline = groups.select("lang", "source", F.lit(None).cast("long").alias("p"), "p0", F.col("terms").alias("n"))
    rows = histogram.unionByName(baseline).join(buckets, "lang").withColumn("bucket", bucket)
    peers = groups.join(buckets, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"), F.col("source").alias("item"), F.col("p0").alias("q0"),
    )
    absent = apart(F.col("p0"), F.col("q0"))
    one_sided = (
        rows.join(peers, ["lang", "bucket"]).filter("source <> item").groupBy("lang", "source", "item")
        .agg(
            F.sum(F.when(F.col("p").isNull(), F.col("n") * absent)).alias("base"),
            F.sum(F.when(F.col("p").isNotNull(), F.col("n") * (apart(F.col("p"), F.col("q0")) - absent))).alias("more"),
        )
        .fillna(0, ["base", "more"])
    )
    sides = one_sided.select("lang", F.inline(F.array(
        F.struct("source", "item", (F.col("base") + F.col("more")).alias("value")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("more").alias("value")),
    )))
    summed = sides.unionByName(shared_sums(priced)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = summed.withColumn("rank", F.row_number().over(ranked))
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", "value", "rank",
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), tok AS (SELECT r, lang, source, unnest(w) AS term FROM doc
), kept AS (SELECT lang, term, count(*) AS total FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), size AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), grp AS (SELECT DISTINCT lang, source FROM doc
), cnt AS (SELECT lang, source, term, count(*) AS c FROM tok GROUP BY lang, source, term
), grid AS (
  SELECT lang, source, term, total, coalesce(c, 0) AS c, sum(coalesce(c, 0)) OVER (PARTITION BY lang, source) AS own
  FROM grp JOIN kept USING (lang) LEFT JOIN cnt USING (lang, source, term)
), price AS (
  SELECT lang, source, term, c, CAST(1 + 1000000000 * (c + 2) // (own + 2 * v) AS HUGEINT) AS p, CAST(1 + 1000000000 * (total + 2) // (n + 2 * v) AS HUGEINT) AS q
  FROM grid JOIN size USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM price a JOIN price b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM price WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 10
"""
