"""Embedding near-duplicates by passes over sorted random projections.

Equal vectors are one class first.  A pass draws random hyperplanes, orders the
classes by the signs of a vector on them, read as one number, and compares each class
with the `window` before it in that order (and its own chunk).  Two vectors of angle w
agree on a plane with probability 1 - w/pi; the number of passes is set so that a pair
right at the threshold agrees, with probability `recall`, on all of the first planes in
one of them.  Classes that do so are a cell.  A cell of at most a window is never cut by
a boundary of tasks, so the window meets all its pairs.  A cell of more, as in a dense
region, is also compared whole, in pairs of blocks; only blocks that hold nothing but
one component of the windows leave each other out.  So a pair is met with `recall`
however dense the region that it stands in; what that costs is the square of the cells.
Pairs found with cosine >= `threshold` in double precision are united over all passes.

Within each component all pairs of classes are then compared in blocks, which makes
the link counts exact for whatever the passes have joined, also in a group of thousands.

Vectors that are null, empty, zero, or hold null or non-finite components link with
nothing and are their own component.  Vectors of different length are not comparable
and do not link.  Rows of equal vectors link with each other, repeated rows too.  A
null vec_id is passed over when the smallest is looked for; such a row alone has a
null component and is kept.  Further columns are kept; one that is called like a
result stands aside under an underscore.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weakspot.llm.common import pinned, read, room_for, with_names
from weakspot.llm.graph import components, local_roots

BITS = 62
CHUNK = 256
BLOCK = 256
# passes that are shuffled together: so many copies of vectors, but four passes at least
COPIES_AT_ONCE = 4_000_000


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: Iterable) -> np.ndarray:
    rows = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    # scaled first, so that squares of extreme components stay finite
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def planes_for(n: int, window: int) -> int:
    """Planes that leave a window of evenly spread vectors in a cell, and two more."""
    return min(BITS, math.ceil(max(1.0, math.log2(max(2.0, n / window)))) + 2)


def passes_needed(n: int, window: int, threshold: float, recall: float) -> int:
    """Passes until a pair at the threshold shares a cell in one of them."""
    agree = 1 - math.acos(threshold) / math.pi
    return math.ceil(math.log(1 - recall) / math.log(1 - agree ** planes_for(n, window)))


def keyed(classes: DataFrame, passes: list[int], planes: int, seed: int) -> DataFrame:
    """The classes once per pass, with their key of all planes and the cell of the first ones."""
    def keys(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            for size, rows in batch.groupby(batch["vector"].map(len)):
                whole = unit(rows["vector"])
                for number in passes:
                    normals = np.random.default_rng([seed, number, int(size)]).standard_normal((int(size), BITS))
                    key = ((whole @ normals) >= 0) @ weights
                    yield pd.DataFrame({
                        "pass": number, "size": int(size), "cell": key >> (BITS - planes), "key": key,
                        "node": rows["node"], "vector": rows["vector"],
                    })

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.select("node", "vector").mapInPandas(keys, f"pass int, size int, cell long, key long, node long, vector {kind}")


def neighbours(threshold: float, window: int):
    def compare(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come in order; links of a chunk with what stands before it, as few edges as join them."""
        held, nodes, group = None, None, None
        for batch in batches:
            for key, rows in batch.groupby(["pass", "size"], sort=True):
                if key != group:
                    held, nodes, group = None, None, key
                for at in range(0, len(rows), CHUNK):
                    part = rows.iloc[at: at + CHUNK]
                    here, names = unit(part["vector"]), part["node"].to_numpy()
                    if held is not None:
                        here, names = np.concatenate([held, here]), np.concatenate([nodes, names])
                    linked = here @ here.T >= threshold
                    roots = local_roots(linked)
                    joined = np.flatnonzero(roots != np.arange(len(roots)))
                    if len(joined):
                        yield pd.DataFrame({"a": names[joined], "b": names[roots[joined]]})
                    held, nodes = here[-window:], names[-window:]

    return compare


def two_blocks(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    return tuple(rows[rows["block"] == rows[side].iloc[0]] for side in ("i", "j"))


def cell_edges(threshold: float):
    def edges(rows: pd.DataFrame) -> pd.DataFrame:
        """Edges between components that are linked within two blocks of a cell."""
        if rows["i"].iloc[0] != rows["j"].iloc[0]:
            rows = pd.concat(two_blocks(rows))
        whole, own = unit(rows["vector"]), rows["component"].to_numpy()
        roots = local_roots((whole @ whole.T >= threshold) | (own[:, None] == own[None, :]))
        joined = np.flatnonzero(own != own[roots])
        return pd.DataFrame({"a": own[joined], "b": own[roots[joined]]}).drop_duplicates()

    return edges


def crowded_edges(crowded: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Edges between components that cells of more than a window show, each cell compared in pairs of blocks.

    A component of the windows (`groups`) that fills a block has blocks of its own in
    its cell, which aren't compared with each other: the last step does that once.
    """
    cell = ["pass", "size", "cell"]
    rows = crowded.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = rows.groupBy(*cell, "component").agg(F.count("*").alias("here"))
    # nodes are never negative, so -1 stands for all small components of a cell
    sizes = sizes.withColumn("part", F.when(F.col("here") >= BLOCK, F.col("component")).otherwise(F.lit(-1)))
    parts = sizes.groupBy(*cell, "part").agg(F.ceil(F.sum("here") / BLOCK).cast("int").alias("blocks"))
    # a row per block's worth of rows at most, and one more per cell
    within = Window.partitionBy(*cell)
    parts = parts.withColumns({
        "total": F.sum("blocks").over(within).cast("int"), "alone": F.count("*").over(within) == 1,
        "start": (F.sum("blocks").over(within.orderBy("part")) - F.col("blocks")).cast("int"),
    }).filter("NOT alone OR part = -1")
    large = sizes.filter("part >= 0").select(*cell, "component", "part")
    placed = (
        rows.join(large, [*cell, "component"], "left").withColumn("part", F.coalesce("part", F.lit(-1)))
        .join(parts, [*cell, "part"])
        .withColumn("block", F.col("start") + F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    pairs = (
        placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("total") - 1)))
        .filter("part = -1 OR other < start OR other >= start + blocks")
        .select(*cell, "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component", "vector")
    )
    return pairs.groupBy(*cell, "i", "j").applyInPandas(cell_edges(threshold), "a long, b long").distinct()


def block_links(threshold: float):
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        """Per class of two blocks, the number of rows in linked classes of the other."""
        left, right = two_blocks(rows)
        found = unit(left["vector"]) @ unit(right["vector"]).T >= threshold
        if rows["i"].iloc[0] == rows["j"].iloc[0]:
            np.fill_diagonal(found, False)
            return pd.DataFrame({"node": left["node"], "links": found @ right["copies"].to_numpy()})
        return pd.DataFrame({
            "node": np.concatenate([left["node"], right["node"]]),
            "links": np.concatenate([found @ right["copies"].to_numpy(), left["copies"].to_numpy() @ found]),
        })

    return links


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95,
    window: int = 64, recall: float = 0.999, seed: int = 17,
) -> DataFrame:
    """The table with n_links, component_id and kept."""
    vectors = room_for(vectors, ["n_links", "component_id", "kept"])
    names = with_names(vectors, ["vector", "found"])
    good = vectors.filter(usable(F.col(embedding)))
    classes = pinned(
        good.groupBy(F.col(embedding).alias("vector")).agg(F.count("*").alias("copies"), F.min(vec_id).alias("first"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    n = classes.count()
    parts = max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    planes, total = planes_for(n, window), passes_needed(n, window, threshold, recall)
    step = max(4, COPIES_AT_ONCE // max(1, n))
    batches = [list(range(at, min(total, at + step))) for at in range(0, total, step)]
    cell, edges, crowds = ["pass", "size", "cell"], [], []
    for numbers in batches:
        rows = keyed(classes, numbers, planes, seed)
        # few against the rows; adaptive execution sends them out if they are small and splits hot cells if not
        crowds.append(pinned(rows.groupBy(*cell).count().filter(F.col("count") > window).select(*cell, F.lit(True).alias("crowded"))))
        rows = rows.join(crowds[-1], cell, "left")
        # ranges end within crowded cells only
        apart = [F.when(F.col("crowded"), F.col(c)) for c in ("key", "node")]
        ordered = rows.repartitionByRange(parts, *cell, *apart).sortWithinPartitions("pass", "size", "key", "node")
        edges.append(pinned(ordered.select("pass", "size", "node", "vector").mapInPandas(neighbours(threshold, window), "a long, b long").distinct()))
    groups = pinned(components(reduce(DataFrame.union, edges)))
    more = []
    for numbers, cells in zip(batches, crowds):
        if not cells.isEmpty():
            rows = keyed(classes, numbers, planes, seed).join(cells, cell).select(*cell, "node", "vector")
            more.append(pinned(crowded_edges(rows, groups, threshold)))
    if any(not found.isEmpty() for found in more):
        # the stars of the windows with the edges that join two of them
        stars = groups.select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a <> b")
        groups = pinned(components(reduce(DataFrame.union, [stars, *more])))
    sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    placed = groups.join(sizes, "component").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(classes, "node")
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "vector", "copies",
    )
    counted = pairs.groupBy("component", "i", "j").applyInPandas(block_links(threshold), "node long, links long")
    linked = counted.groupBy("node").agg(F.sum("links").alias("links"))
    first = groups.join(classes.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("least"))
    result = (
        classes.join(groups.join(first, "component").select("node", "least"), "node", "left").join(linked, "node", "left")
        .select(
            F.col("vector").alias(names["vector"]),
            F.struct(
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "first").alias("component_id"),
            ).alias(names["found"]),
        )
    )
    # rows that link with nothing find no partner and stay on their own
    rows = vectors.join(result, F.when(usable(F.col(embedding)), F.col(embedding)) == F.col(names["vector"]), "left")
    found = F.col(names["found"])
    own = F.coalesce(found["component_id"], F.col(vec_id))
    return rows.withColumns({
        "n_links": F.coalesce(found["n_links"], F.lit(0)).cast("long"), "component_id": own,
        "kept": F.coalesce(F.col(vec_id) == own, F.lit(True)),
    }).drop(*names.values())


def op4_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "n_links", "component_id", "kept")
