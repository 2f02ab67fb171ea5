"""N-gram Jaccard join by MinHash banding.

A document is the set of its runs of `n` words; a document of fewer words, but not
none, is one run.  Documents of equal sets are one class.  A class has rows * bands
minimum hashes; bands and rows are chosen so that a pair right at the threshold
shares a band with probability `recall` at the least cost.  Classes are shuffled on
their band hashes, and those that share one are verified on their full sets.

Verification is by blocks, so that no pair list is written: each class has one block,
a piece of bounded size of the largest bucket it is in; each pair of blocks that meet
in some bucket is compared once.  A task holds two blocks, however large a bucket is.
Links are counted in that task, with the rows of each class, and the edges it hands
on are as few as join its classes.

Null and empty texts have no words, link with nothing and are kept.  Rows of equal
doc_id are told apart by their text; equal rows link with each other.  The smallest
doc_id passes over nulls.  Further columns are kept.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weakspot.llm.common import pinned, read, with_names, word_list
from weakspot.llm.graph import components, local_roots

BLOCK_CLASSES = 256
BLOCK_GRAMS = 400_000
COLUMNS_AT_ONCE = 8_192
HASHED_AT_ONCE = 4_096
#: word hashes a task keeps at hand; beyond it they are worked out anew
REMEMBERED = 500_000
STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_set(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of n words."""
    words = word_list(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    ids = np.fromiter((hashes[w] for w in words), dtype=np.uint64, count=len(words))
    run = min(n, len(ids))
    total = np.full(len(ids) - run + 1, run, dtype=np.uint64)
    for i in range(run):
        total = mixed(total * STEP + ids[i: len(ids) - run + 1 + i])
    return np.unique(total)


def banding(threshold: float, recall: float) -> tuple[int, int]:
    """(bands, rows): as many rows as fit with at most 32 bands, and the bands that the recall then takes."""
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)) if threshold < 1 else 1
        if bands <= 32:
            return bands, rows
    raise ValueError(f"no banding for threshold {threshold} and recall {recall}")


def signature(grams: np.ndarray, factors: np.ndarray, bands: int) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(grams), HASHED_AT_ONCE):
        np.minimum(least, (grams[at: at + HASHED_AT_ONCE, None] * factors[None, :]).min(axis=0), out=least)
    rows = least.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for row in rows.T:
        key = mixed(key * STEP + row)
    return key.view(np.int64)


def digests(docs: DataFrame, doc_id: str, text: str, n: int, bands: int, rows: int, seed: int) -> DataFrame:
    """(doc_id, text_hash, grams, key, bands) per row; key stands for the whole set."""

    @F.pandas_udf("grams int, key binary, bands array<long>")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        factors = np.random.default_rng(seed).integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            out = []
            for value in batch:
                grams = gram_set(value, n, hashes)
                if len(grams):
                    key = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
                    out.append((len(grams), key, signature(grams, factors, bands)))
                else:
                    out.append((0, None, None))
            yield pd.DataFrame(out, columns=["grams", "key", "bands"])

    picked = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), digest(F.col(text)).alias("d"))
    return picked.select("doc_id", "text_hash", "d.*")


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections; what stands in one set only is left out, the rest goes through in slices."""
    lengths = [len(s) for s in (*left, *right)]
    owner = np.repeat(np.arange(len(lengths)), lengths)
    _, column, times = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, (kept, column) = owner[shared], np.unique(column[shared], return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(left), len(right)), dtype=np.float64)
    for at in range(0, len(kept), COLUMNS_AT_ONCE):
        low, high = np.searchsorted(column, [at, at + COLUMNS_AT_ONCE])
        held = np.zeros((len(lengths), min(COLUMNS_AT_ONCE, len(kept) - at)), dtype=np.float32)
        held[owner[low:high], column[low:high] - at] = 1
        total += held[: len(left)] @ held[len(left):].T
    return total


def compared(threshold: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        """Per linked class of two blocks: rows in classes it links with, and one class of its component here."""
        a, b = rows["a"].iloc[0], rows["b"].iloc[0]
        left = rows[rows["block"] == a]
        right = left if a == b else rows[rows["block"] == b]
        common = intersections(list(left["set"]), list(right["set"]))
        union = left["set"].map(len).to_numpy()[:, None] + right["set"].map(len).to_numpy()[None, :] - common
        found = common >= threshold * union - 1e-9
        if a == b:
            np.fill_diagonal(found, False)
            nodes, linked = left["node"].to_numpy(), found
            links = found @ left["copies"].to_numpy()
        else:
            nodes = np.concatenate([left["node"], right["node"]])
            links = np.concatenate([found @ right["copies"].to_numpy(), left["copies"].to_numpy() @ found])
            linked = np.zeros((len(nodes), len(nodes)), dtype=bool)
            linked[: len(left), len(left):] = found
            linked |= linked.T
        roots = local_roots(linked)
        hit = links > 0
        return pd.DataFrame({"node": nodes[hit], "links": links[hit].astype("int64"), "root": nodes[roots[hit]]})

    return compare


def blocks_of(members: DataFrame) -> DataFrame:
    """(node, block): each class in a piece of bounded size of its largest bucket.

    Hardly any bucket holds all of a large group, so some of its classes end in small
    buckets.  Where fewer than half a block chose a bucket, they gather with others
    whose bucket is mostly made up of classes that chose the same one.
    """
    home = members.groupBy("node").agg(F.max(F.struct("members", "bucket", "grams")).alias("home"))
    homes = pinned(home.select("node", F.col("home.bucket").alias("home"), "home.grams"))
    votes = homes.groupBy("home").agg(F.count("*").alias("votes"))
    usual = (
        members.select("bucket", "node").join(homes.select("node", "home"), "node").groupBy("bucket", "home").agg(F.count("*").alias("n"))
        .groupBy(F.col("bucket").alias("home")).agg(F.max(F.struct("n", "home")).alias("most")).select("home", F.col("most.home").alias("usual"))
    )
    gathered = F.when(F.col("votes") * 2 < BLOCK_CLASSES, F.xxhash64(F.lit("rest"), "usual")).otherwise(F.col("home"))
    placed = pinned(homes.join(votes, "home").join(usual, "home").select("node", "grams", gathered.alias("group")))
    sizes = placed.groupBy("group").agg(F.count("*").alias("held"), F.sum("grams").alias("weight"))
    pieces = F.greatest(F.ceil(F.col("held") / BLOCK_CLASSES), F.ceil(F.col("weight") / BLOCK_GRAMS), F.lit(1))
    return pinned(placed.join(sizes, "group").select("node", F.xxhash64("group", F.pmod(F.xxhash64("node"), pieces)).alias("block")))


def linked_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8, n: int = 5, recall: float = 0.9999, seed: int = 11,
) -> tuple[DataFrame, DataFrame]:
    """Digests of all rows; and (key, class_id, class_hash, n_links, component_id, component_hash) per class.

    A class or component is named by its smallest doc_id, with the text hash of that row.
    """
    bands, rows = banding(threshold, recall)
    digest = pinned(digests(docs, doc_id, text, n, bands, rows, seed))
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    classes = pinned(
        digest.filter("grams > 0").groupBy("key")
        .agg(F.count("*").alias("copies"), F.min(first).alias("first"), F.first("grams").alias("grams"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    # buckets of two classes or more; counts are combined before the shuffle
    entries = classes.select("node", "grams", F.explode_outer("bands").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    members = pinned(entries.join(buckets, "bucket").select("bucket", "node", "members", "grams"))
    homes = blocks_of(members)
    met = members.join(homes, "node").select("bucket", "block").distinct()
    pairs = (
        met.select("bucket", F.col("block").alias("a")).join(met.select("bucket", F.col("block").alias("b")), "bucket")
        .filter("a <= b").select("a", "b").distinct()
    )
    # sets of the classes that share a bucket, from one row of each class
    hashes_of = with_names(docs, ["id", "hash"])
    chosen = homes.join(classes, "node").select("node", "block", "copies", F.col("first.doc_id").alias(hashes_of["id"]), F.col("first.text_hash").alias(hashes_of["hash"]))

    @F.pandas_udf("array<long>")
    def grams_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        for batch in batches:
            yield pd.Series([gram_set(v, n, hashes).view(np.int64) for v in batch])

    same = F.col(doc_id).eqNullSafe(F.col(hashes_of["id"])) & (F.xxhash64(F.col(text)) == F.col(hashes_of["hash"]))
    texts = docs.select(doc_id, text).join(chosen, same).select("node", "block", "copies", F.col(text).alias("text")).dropDuplicates(["node"])
    sets = texts.select("node", "block", "copies", grams_of("text").alias("set"))
    met_by = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    compare = met_by.join(sets, "block").groupBy("a", "b").applyInPandas(compared(threshold), "node long, links long, root long")
    found = pinned(compare)
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    least = groups.join(classes.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("least"))
    named = groups.join(least, "component").select("node", "least")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    result = (
        classes.join(links, "node", "left").join(named, "node", "left")
        .select(
            "key", F.col("first.doc_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("least", "first").alias("of"),
        )
        .select("key", "class_id", "n_links", F.col("of.doc_id").alias("component_id"), F.col("of.text_hash").alias("component_hash"))
    )
    return digest, result


def joined(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, class_id, n_links, component_id, kept) per row of docs."""
    digest, classes = linked_classes(docs, **options)
    rows = digest.select("doc_id", "text_hash", "key").join(classes, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    stays = F.col("key").isNull() | (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("component_hash")))
    return rows.select(
        "doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), stays.alias("kept"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Documents with one row of each component, that of the smallest doc_id; all columns as they are."""
    digest, classes = linked_classes(docs, doc_id=doc_id, text=text, **options)
    names = with_names(docs, ["id", "hash", "rows", "stands", "turn"])
    named, hashed, repeats, stands, turn = (names[k] for k in ("id", "hash", "rows", "stands", "turn"))
    # null and other ids as one text, so that the join and the count of equal rows share a shuffle
    identity = lambda c: F.when(c.isNull(), "null").otherwise(F.concat(F.lit("="), c.cast("string")))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("component_hash"))
    linked = (
        digest.join(classes.filter("n_links > 0"), "key")
        .groupBy(identity(F.col("doc_id")).alias(named), F.col("text_hash").alias(hashed))
        .agg(F.count("*").alias(repeats), F.max(stays).alias(stands))
        .filter(~F.col(stands) | (F.col(repeats) > 1))
    )
    keyed = docs.withColumns({named: identity(F.col(doc_id)), hashed: F.xxhash64(F.col(text))})
    left = keyed.join(linked, [named, hashed], "left").filter(F.coalesce(F.col(stands), F.lit(True)))
    equal = Window.partitionBy(named, hashed).orderBy(F.lit(1))
    return left.withColumn(turn, F.row_number().over(equal)).filter(F.col(repeats).isNull() | (F.col(turn) == 1)).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(read(spark, sf_dir, "documents").select("doc_id", "text"))
