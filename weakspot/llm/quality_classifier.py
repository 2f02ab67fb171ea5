"""Quality classifier from weak labels.

Heuristic labellers each vote good (2), bad (0) or abstain (1) on a text.  The votes
of a document are one of at most 3^m patterns; patterns are counted over all
documents, and expectation-maximisation on those counts estimates how each labeller
votes on good and on bad documents, and how many are good.  That gives a posterior
per pattern: the weak label.  It trains a linear scorer on hashed words and word
shapes by logistic loss, which generalises beyond the labellers.

The scorer is fitted on a bounded sample of at most `train_rows` documents, drawn by a
hash of doc_id and text; the pattern counts, and with them the weak labels, cover all
documents, and every document is scored whole.

Null texts count as empty: no features, score 0, not kept.  Repeated rows are worked
off one by one; further columns are kept.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from weakspot.llm.common import draw_of, fraction_of, read, row_key, with_names

BAD, ABSTAIN, GOOD = 0, 1, 2
BUCKETS = 1 << 14
#: UTF-8 bytes to classes of characters, for shapes and shares
SHAPES = bytes(
    88 if 65 <= b <= 90 else 120 if 97 <= b <= 122 or b >= 128 else 57 if 48 <= b <= 57 else b for b in range(256)
)
RUN = re.compile(rb"X{2,}|x{2,}|9{2,}")
MARKS = re.compile(rb"([^\sXx9])\1")
PLAIN = b".,;:'\"!?()-"


def vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


class Text:
    """What the labellers and the features look at."""

    def __init__(self, text: str | None):
        raw = (text or "").encode("utf-8", "surrogatepass")
        self.words = raw.lower().split()
        self.shape = raw.translate(SHAPES)
        self.n = len(self.words)
        self.upper = self.shape.count(b"X")
        self.letters = self.upper + self.shape.count(b"x")
        self.digits = self.shape.count(b"9")
        self.size = max(1, len(raw) - sum(raw.count(b) for b in (b" ", b"\n", b"\t", b"\r")))
        self.plain = sum(self.shape.count(bytes([b])) for b in PLAIN)
        self.pipes = self.shape.count(b"|")
        self.counts = Counter(self.words)


# each looks at one property; thresholds are part of the labeller
LABELLERS = {
    "symbols": lambda t: vote((s := 1 - (t.letters + t.digits + t.plain) / t.size) > 0.08, s < 0.02 and t.n > 0),
    "capitals": lambda t: vote(t.letters > 0 and t.upper / t.letters > 0.4, t.letters > 0 and t.upper / t.letters < 0.2),
    "one word": lambda t: vote(t.n >= 10 and (m := max(t.counts.values())) / t.n > 0.3, t.n >= 10 and m / t.n < 0.15),
    "marks": lambda t: vote(t.n > 0 and (m := sum(1 for _ in MARKS.finditer(t.shape)) / t.n) > 0.1, t.n > 0 and m < 0.02),
    "cells": lambda t: vote(t.n > 0 and t.pipes / t.n > 0.1, t.n > 0 and t.pipes == 0),
    "length": lambda t: vote(t.n < 5, False),
    "sentences": lambda t: vote(t.n >= 30 and (e := t.shape.count(b".") / t.n) < 0.01, t.n >= 30 and 0.02 < e < 0.4),
    "distinct": lambda t: vote(t.n >= 50 and len(t.counts) < 0.1 * min(t.n, 500), t.n >= 50 and len(t.counts) > 0.3 * min(t.n, 500)),
}


def pattern(text: Text) -> int:
    """The votes as one number in base three."""
    number = 0
    for labeller in LABELLERS.values():
        number = number * 3 + labeller(text)
    return number


def votes_of(patterns: np.ndarray) -> np.ndarray:
    m = len(LABELLERS)
    return patterns[:, None] // 3 ** np.arange(m - 1, -1, -1)[None, :] % 3


def pattern_counts(docs: DataFrame, text: str = "text") -> dict[int, int]:
    """Documents per pattern; at most 3^m rows come back."""

    def counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = Counter(pattern(Text(v)) for v in batch.iloc[:, 0])
            if counts:  # an empty frame has no types
                yield pd.DataFrame({"pattern": list(counts), "n": list(counts.values())})

    rows = docs.select(F.col(text)).mapInPandas(counted, "pattern int, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    return {row["pattern"]: row["n"] for row in rows.collect()}


def posteriors(counts: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], np.ndarray]:
    """Probability of good per pattern, and per class, labeller and vote how often it is cast.

    Labellers are taken to vote independently within a class.  The start is the share
    of good among the votes cast; one smoothing count keeps every rate above zero.
    """
    patterns = np.array(sorted(counts), dtype=np.int64)
    if not len(patterns):
        return {}, np.zeros((2, len(LABELLERS), 3))
    weight = np.array([counts[p] for p in patterns.tolist()], dtype=float)
    cast = (votes_of(patterns)[:, :, None] == np.arange(3)).astype(float)
    good = (1 + cast[:, :, GOOD].sum(axis=1)) / (2 + cast[:, :, GOOD].sum(axis=1) + cast[:, :, BAD].sum(axis=1))
    rates = np.zeros((2, len(LABELLERS), 3))
    for _ in range(rounds):
        share = np.stack([1 - good, good]) * weight
        rates = 1 + np.einsum("cp,plv->clv", share, cast)
        rates /= rates.sum(axis=2, keepdims=True)
        prior = (1 + share.sum(axis=1)) / (2 + weight.sum())
        logs = np.log(prior)[:, None] + np.einsum("plv,clv->cp", cast, np.log(rates))
        now = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if np.abs(now - good).max() < 1e-9:
            break
        good = now
    return dict(zip(patterns.tolist(), good.tolist())), rates


def features(text: Text) -> np.ndarray:
    """Distinct buckets of the words and word shapes of a text."""
    shapes = {RUN.sub(lambda m: m[0][:1], s) for s in set(text.shape.split())}
    found = {zlib.crc32(w) % BUCKETS for w in text.counts}
    found.update(zlib.crc32(b"\0" + s) % BUCKETS for s in shapes)
    return np.fromiter(sorted(found), dtype=np.int32, count=len(found))


def fit(rows: list[np.ndarray], labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Weights of the buckets and, last, the constant; adaptive steps on the logistic loss of soft labels."""
    weights = np.zeros(BUCKETS + 1)
    scale = np.full(BUCKETS + 1, 1e-6)
    order = np.random.default_rng(3)
    for _ in range(epochs):
        for part in np.array_split(order.permutation(len(rows)), max(1, len(rows) // batch)):
            if not len(part):
                continue
            lengths = np.array([len(rows[i]) for i in part])
            index = np.concatenate([rows[i] for i in part])
            value = np.repeat(1 / np.sqrt(np.maximum(lengths, 1)), lengths)
            owner = np.repeat(np.arange(len(part)), lengths)
            margin = np.bincount(owner, weights[index] * value, len(part)) + weights[-1]
            error = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels[part]
            gradient = np.append(np.bincount(index, error[owner] * value, BUCKETS), error.sum()) / len(part)
            gradient[:-1] += decay * weights[:-1]
            scale += gradient ** 2
            weights -= rate * gradient / np.sqrt(scale)
    return weights


def train(docs: DataFrame, labels: dict[int, float], text: str = "text", doc_id: str = "doc_id", train_rows: int = 10_000, total: int | None = None) -> np.ndarray:
    total = docs.count() if total is None else total

    @F.pandas_udf("pattern int, buckets array<int>")
    def looked_at(values: pd.Series) -> pd.DataFrame:
        texts = [Text(v) for v in values]
        return pd.DataFrame({"pattern": [pattern(t) for t in texts], "buckets": [features(t) for t in texts]})

    key = row_key(F.col(doc_id), F.col(text))
    sample = docs if total <= train_rows else docs.filter(fraction_of(key, train_rows / total))
    rows = sample.select(draw_of(key).alias("draw"), looked_at(F.col(text)).alias("x")).select("draw", "x.*")
    if total > train_rows:  # equal rows are drawn together, so that the share alone is no bound
        rows = rows.orderBy("draw").limit(train_rows)
    frame = rows.drop("draw").toArrow().to_pandas()
    if not len(frame):
        return np.zeros(BUCKETS + 1)
    return fit([np.asarray(b, dtype=np.int32) for b in frame["buckets"]], frame["pattern"].map(labels).to_numpy(dtype=float))


def classify(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", train_rows: int = 10_000) -> DataFrame:
    """Add weak_label, score and kept (score of one half or more)."""
    counts = pattern_counts(docs, text)
    labels, _ = posteriors(counts)
    weights = train(docs, labels, text, doc_id, train_rows, sum(counts.values()))

    @F.pandas_udf("weak_label double, score double")
    def scored(values: pd.Series) -> pd.DataFrame:
        out = []
        for value in values:
            seen = Text(value)
            found = features(seen)
            margin = weights[found].sum() / np.sqrt(len(found)) + weights[-1] if len(found) else -np.inf
            out.append((labels[pattern(seen)], float(1 / (1 + np.exp(-np.clip(margin, -500, 500)))) if len(found) else 0.0))
        return pd.DataFrame(out, columns=["weak_label", "score"])

    name = with_names(docs, ["quality"])["quality"]
    found = docs.drop("weak_label", "score", "kept").withColumn(name, scored(F.col(text)))
    return found.withColumns({
        "weak_label": F.col(f"{name}.weak_label"), "score": F.col(f"{name}.score"), "kept": F.col(f"{name}.score") >= 0.5,
    }).drop(name)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
