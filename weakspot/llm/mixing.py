"""Mixing sources to target weights by soft membership.

A table of labelled documents defines the domains.  A softmax classifier on hashed
words, runs of marks and a few shares gives each document a posterior over the
domains.  Each document gets a rate >= 0 at which it enters the mixture: with n words
and posterior p it adds rate * n * p to the expected totals of the domains.  Rates
start at 1 and are moved by projected gradient steps on the squared distance of the
expected totals from the targets.  Words, not documents, weigh alike, and the distance
is measured where the domains are uncorrelated over them; a step of 1 is then safe,
and exact where no rate reaches 0.

A document's rate depends on p and the gradient at each step only, and the gradient
has one entry per domain.  So an iteration is one sum over a narrow table
(in the shared folder) and the history of gradients, a few numbers, is all that the
driver keeps; the rates of all documents are one expression of it.

The classifier is fitted on a bounded sample of at most `train_rows` labelled rows.
Labels with a null id or domain are left out; a document labelled twice
counts for each label.  Null and empty texts have no words: they get the
posterior of a text without features, and have no effect on totals.  With no labels at all, all domains are equally
likely.  Repeated rows have equal rates; further columns are kept.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weakspot.llm.common import draw_of, held, read, smallest, with_names, words, written

BUCKETS = 1 << 14
TARGETS = {"good": 0.93, "poor": 0.05, "toxic": 0.02}


def domains_of_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from the quality and toxic marks."""
    toxic, quality = F.col("toxic"), F.col("quality")
    return labels.select("doc_id", F.when(toxic == 1, "toxic").when(quality == 1, "good").when(quality == 0, "poor").alias("domain"))


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def buckets_of(text: Column, found: Column) -> Column:
    """Distinct buckets of a text's words, runs of marks, capitals, repetition and length."""
    marks = F.array_distinct(F.split(F.coalesce(text, F.lit("")), r"[\p{L}\p{N}\s]+"))
    size, capitals = F.size(found), F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    share = lambda part, of: F.floor(F.lit(10) * part / F.greatest(of, F.lit(1))).cast("string")

    def hashed(kinds: Column) -> Column:
        facts = F.array(
            F.concat(F.lit("\tcapitals "), share(F.coalesce(capitals, F.lit(0)), F.coalesce(F.char_length(text), F.lit(0)))),
            F.concat(F.lit("\trepeated "), share(F.size(kinds), size)),
            F.concat(F.lit("\tlength "), F.floor(F.log2(size + F.lit(1))).cast("string")),
        )
        return F.transform(F.concat(kinds, marks, facts), bucket)

    # the kinds of words are found once for both uses
    return F.array_distinct(F.get(F.transform(F.array(F.array_distinct(found)), hashed), 0))


class Classifier:
    """Per domain the weight of each bucket, and a constant."""

    def __init__(self, domains: list[str], weights: np.ndarray, constants: np.ndarray):
        self.domains, self.weights, self.constants = domains, weights, constants

    def logits(self, buckets: Column) -> list[Column]:
        """Logarithm of each domain's posterior but for a constant, from the distinct buckets of a text."""

        def logit(weights: np.ndarray, constant: float) -> Column:
            # a literal once folded; written as text to keep the plan small
            table = F.split(F.lit(",".join(f"{w:.4g}" for w in weights)), ",").cast("array<double>")
            total = F.aggregate(buckets, F.lit(0.0), lambda total, b: total + F.get(table, b))
            return total / F.sqrt(F.greatest(F.size(buckets), F.lit(1))) + F.lit(float(constant))

        return [logit(*domain) for domain in zip(self.weights, self.constants)]


def fit(rows: list[np.ndarray], labels: np.ndarray, k: int, epochs: int = 15, batch: int = 64, rate: float = 0.5, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression by adaptive steps: weights and constants."""
    weights, constants = np.zeros((k, BUCKETS)), np.zeros(k)
    scale, scale_of_constants = np.full((k, BUCKETS), 1e-6), np.full(k, 1e-6)
    order = np.random.default_rng(5)
    for _ in range(epochs):
        for part in np.array_split(order.permutation(len(rows)), max(1, len(rows) // batch)):
            if not len(part):
                continue
            lengths = np.array([len(rows[i]) for i in part])
            index = np.concatenate([rows[i] for i in part])
            value = np.repeat(1 / np.sqrt(np.maximum(lengths, 1)), lengths)
            owner = np.repeat(np.arange(len(part)), lengths)
            logits = np.stack([np.bincount(owner, weights[j, index] * value, len(part)) + constants[j] for j in range(k)], axis=1)
            chances = np.exp(logits - logits.max(axis=1, keepdims=True))
            chances /= chances.sum(axis=1, keepdims=True)
            error = (chances - np.eye(k)[labels[part]]) / len(part)
            for j in range(k):
                gradient = np.bincount(index, error[owner, j] * value, BUCKETS) + decay * weights[j]
                scale[j] += gradient ** 2
                weights[j] -= rate * gradient / np.sqrt(scale[j])
            pull = error.sum(axis=0)
            scale_of_constants += pull ** 2
            constants -= rate * pull / np.sqrt(scale_of_constants)
    return weights, constants


def labelled_rows(docs: DataFrame, labelled: DataFrame, domains: list[str], text: str, doc_id: str, train_rows: int) -> DataFrame:
    """(id, text, domain): at most `train_rows` labelled documents, whatever ids repeat.

    Labels are drawn by id and domain among those that meet a document, which reads no
    text.  Where ids repeat so that more documents than that bear the drawn labels, these
    are drawn once more by their texts; equal rows count once.
    """
    usable = labelled.select(F.col("doc_id").alias("id"), "domain").filter(F.col("id").isNotNull() & F.col("domain").isin(domains)).distinct()
    ids = docs.select(F.col(doc_id).alias("id"))
    met = ids.join(usable, "id").groupBy("id", "domain").agg(F.count("*").alias("copies"))
    chosen = smallest(met.withColumn("draw", draw_of(F.col("id"), F.col("domain"))), "draw", train_rows).collect()  # at most train_rows short rows
    picked = docs.sparkSession.createDataFrame([(row["id"], row["domain"]) for row in chosen], usable.schema)
    found = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(picked), "id")
    if sum(row["copies"] for row in chosen) <= train_rows:
        return found.select("id", "text", "domain")
    drawn = found.withColumn("draw", draw_of(F.col("id"), F.col("domain"), F.col("text")))
    return smallest(drawn, "draw", train_rows).select("id", "text", "domain")


def train(
    docs: DataFrame, labelled: DataFrame, domains: list[str], text: str = "text", doc_id: str = "doc_id", train_rows: int = 6_000,
    train_entries: int = 8_000_000,
) -> Classifier:
    """Fitted by the driver on the buckets of at most `train_rows` rows, with `train_entries` buckets in all.

    The second bound is met in the order of a hash, row by row, and binds only where texts
    of the sample hold more than 1,300 kinds of words in the mean.
    """
    marked = labelled_rows(docs, labelled, domains, text, doc_id, train_rows)
    listed = held(marked, "_words", words(F.col("text"))).select(
        draw_of(F.col("id"), F.col("domain"), F.col("text")).alias("draw"), "domain", F.array_sort(buckets_of(F.col("text"), F.col("_words"))).alias("buckets"),
    )
    so_far = F.sum(F.size("buckets")).over(Window.orderBy("draw", "domain", "buckets"))  # over a bounded sample
    # as text: the driver holds no list of numbers per row
    rows = listed.withColumn("so_far", so_far).filter(F.col("so_far") <= train_entries).select(
        "domain", F.array_join(F.col("buckets").cast("array<string>"), " ").alias("buckets")
    ).collect()
    if not rows:
        return Classifier(domains, np.zeros((len(domains), BUCKETS)), np.zeros(len(domains)))
    # in a fixed order, whatever order the rows came in
    rows.sort(key=lambda row: (row["domain"], row["buckets"]))
    labels = np.array([domains.index(row["domain"]) for row in rows])
    lists = [np.fromstring(row["buckets"], dtype=np.int32, sep=" ") for row in rows]
    del rows
    return Classifier(domains, *fit(lists, labels, len(domains)))


def with_posteriors(docs: DataFrame, model: Classifier, text: str, n: str, posterior: list[str]) -> DataFrame:
    """Add the number of words and the posterior of each domain."""
    names = with_names(docs, ["words", "n", "buckets", "logits"])
    rows = held(docs, names["words"], words(F.col(text)))
    rows = held(rows, names["buckets"], buckets_of(F.col(text), F.col(names["words"])))
    # counted before the next step, which then need not carry the words
    rows = rows.withColumn(names["n"], F.size(names["words"]).cast("long")).drop(names["words"])
    rows = held(rows, names["logits"], F.array(*model.logits(F.col(names["buckets"]))))
    logits = [F.col(names["logits"])[k] for k in range(len(model.domains))]
    top = F.greatest(*logits) if len(logits) > 1 else logits[0]
    parts = [F.exp(x - top) for x in logits]
    return rows.withColumns(
        {n: F.col(names["n"])} | {p: part / sum(parts[1:], parts[0]) for p, part in zip(posterior, parts)}
    ).drop(*names.values())


def rate_of(posterior: list[Column], history: list[list[float]]) -> Column:
    """The rate after the steps taken so far; one small expression however many they are."""
    if not history:
        return F.lit(1.0)
    steps = F.array(*[F.array(*[F.lit(float(w)) for w in pull]) for pull in history])

    def moved(rate: Column, step: Column) -> Column:
        move = sum((p * step[k] for k, p in enumerate(posterior)), F.lit(0.0))
        return F.greatest(F.lit(0.0), rate - move)

    return F.aggregate(steps, F.lit(1.0), moved)


def fitted(table: DataFrame, n: str, posterior: list[str], targets: list[float], iterations: int = 40, tolerance: float = 1e-6) -> list[list[float]]:
    """History of gradients until the expected totals meet the targets, or no step brings them nearer.

    A step is first taken in the metric of the documents that still have a rate, which
    is exact if no more of them reach 0.  If it brings the totals no nearer, it is taken
    back for one in the metric of all documents, which always does.
    """
    size = len(posterior)
    columns = [F.col(p) for p in posterior]

    rate = with_names(table, ["rate"])["rate"]

    def sums() -> tuple[float, np.ndarray, np.ndarray]:
        now = held(table, rate, rate_of(columns, history))
        live = F.when(F.col(rate) > 0, F.col(n)).otherwise(F.lit(0))
        row = now.agg(
            F.sum(n), *[F.sum(F.col(rate) * F.col(n) * p) for p in columns], *[F.sum(live * a * b) for a in columns for b in columns],
        ).first()
        values = np.array([float(v or 0) for v in row])
        return values[0], values[1: 1 + size], values[1 + size:].reshape(size, size)

    history: list[list[float]] = []
    metric = goal = gap = None
    nearest, bold = math.inf, False
    for _ in range(iterations):
        total, now, gram = sums()
        if total == 0:
            return []
        if metric is None:
            metric, goal = np.linalg.pinv(gram), np.array(targets) / sum(targets) * total
        distance = float((now - goal) @ metric @ (now - goal))
        if distance >= nearest * (1 - 1e-4):
            if not bold:
                break
            history[-1], bold = (metric @ gap).tolist(), False
            continue
        nearest, gap = distance, now - goal
        if np.abs(gap).sum() < tolerance * total:
            break
        history.append((np.linalg.pinv(gram) @ gap).tolist())
        bold = True
    return history


def mixed(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float], text: str = "text", doc_id: str = "doc_id", train_rows: int = 6_000,
    keep: list[str] | None = None,
) -> tuple[DataFrame, list[list[float]]]:
    """(docs with n_tokens, p_<domain>, rate), and the gradients taken.

    Texts are classified once: the classified rows are written to the shared folder, with
    all their columns or, given `keep`, with those only.  The fit reads the narrow columns
    of that table, and the rates are added on reading it.
    """
    domains = sorted(targets)
    model = train(docs, labelled, domains, text, doc_id, train_rows)
    posterior = [f"p_{d}" for d in domains]
    base = docs.drop("n_tokens", "rate", *posterior)
    kept = base.columns if keep is None else keep
    table, _ = written(with_posteriors(base, model, text, "n_tokens", posterior).select(*kept, "n_tokens", *posterior))
    history = fitted(table.select("n_tokens", *posterior), "n_tokens", posterior, [targets[d] for d in domains])
    return table.withColumn("rate", rate_of([F.col(p) for p in posterior], history)), history


def drawn(docs: DataFrame, doc_id: str = "doc_id", rate: str = "rate") -> DataFrame:
    """Add `copies`: the rate rounded up or down by a hash of doc_id, right in expectation."""
    part = F.pmod(F.xxhash64(F.lit("mix"), F.col(doc_id)), F.lit(1 << 40)) / float(1 << 40)
    return docs.withColumn("copies", (F.floor(rate) + (part < F.col(rate) - F.floor(rate)).cast("int")).cast("long"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return mixed(docs, domains_of_labels(read(spark, sf_dir, "labels")), TARGETS, keep=["doc_id"])[0]
