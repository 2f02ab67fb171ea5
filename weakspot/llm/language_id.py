"""Language ID: known words by per-language log frequency, else backoff to n-grams.

Words are runs of letters (and of all characters beyond ASCII) in lower case.  The
model holds, per language, the log frequency of its most frequent words and of the
character n-grams of its words, ends marked, for n from 5 to 1.  A known word adds
its log frequency in each language.  An unseen word adds the mean log frequency of
its n-grams of the greatest n of which one is known; a word without any known
n-gram adds nothing.  The score is the posterior of the best language over all words
of the whole text; ties go to the language that comes first.

The model is fitted on a sample of about `sample` labelled rows per language, drawn by a
hash of doc_id and text, of every language.  It keeps `entries` words and n-grams, shared
out evenly over languages and orders, and `least` of each at any rate: its size depends
on the number of languages and not on the corpus.  An entry holds the languages that
know it only, so that many languages need no wide table.  Rows whose crc32(doc_id) mod 4 is 2 are held out.  Only text
and lang are learnt from; predictions see the text alone.

Null texts and texts without a letter are `und` with score 0, and so is every text
where no labelled row was learnt from.  A null doc_id is not held out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weakspot.llm.common import draw_of, read, row_key, with_names

UNDECIDED = "und"
ORDERS = (5, 4, 3, 2, 1)
#: UTF-8 bytes of lowered text to letters and blanks
LETTERS = bytes(b if 97 <= b <= 122 or 65 <= b <= 90 or b >= 128 else 32 for b in range(256))
#: scores of words that a task keeps at hand, shared out over the languages; beyond it they are worked out anew
REMEMBERED, LEAST_REMEMBERED = 1_600_000, 10_000
#: numbers up to which entries are kept as a matrix
WIDE = 4_000_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letter_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(LETTERS).split()


def ngrams(word: bytes, order: int) -> list[str]:
    marked = f"_{word.decode('utf-8', 'replace')}_"
    return [marked[i: i + order] for i in range(len(marked) - order + 1)]


def counted(rows: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, order, gram, n); order 0 is a whole word."""

    def counts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for value, label in zip(batch["text"], batch["lang"]):
                seen.setdefault(label, Counter()).update(letter_words(value))
            out = []
            for label, found in seen.items():
                grams = Counter()
                for word, n in found.items():
                    out.append((label, 0, word.decode("utf-8", "replace"), n))
                    for order in ORDERS:
                        for gram in ngrams(word, order):
                            grams[order, gram] += n
                out += [(label, order, gram, n) for (order, gram), n in grams.items()]
            if out:  # an empty frame has no types
                yield pd.DataFrame(out, columns=["lang", "order", "gram", "n"])

    picked = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    return (
        picked.mapInPandas(counts, "lang string, order int, gram string, n long")
        .groupBy("lang", "order", "gram").agg(F.sum("n").alias("n"))
    )


class Entries:
    """Log frequencies of words and n-grams: per order what a language gives that doesn't know them, and what others add."""

    def __init__(self, absent: np.ndarray, orders: np.ndarray, bounds: np.ndarray, languages: np.ndarray, added: np.ndarray):
        self.absent, self.orders, self.bounds, self.languages, self.added = absent, orders, bounds, languages, added

    def dense(self) -> np.ndarray:
        values = self.absent[self.orders]
        np.add.at(values, (np.repeat(np.arange(len(self)), np.diff(self.bounds)), self.languages), self.added)
        return values

    def __len__(self) -> int:
        return len(self.orders)

    def __getitem__(self, row: int) -> np.ndarray:
        if row >= len(self):
            raise IndexError(row)
        values = self.absent[self.orders[row]].copy()
        mine = slice(self.bounds[row], self.bounds[row + 1])
        values[self.languages[mine]] += self.added[mine]
        return values


class Rows(dict):
    """Word to row of a matrix of scores; rows are added as words come."""

    def __init__(self, model: Model):
        self.model = model
        self.room = max(LEAST_REMEMBERED, REMEMBERED // max(1, len(model.languages)))
        self.scores = np.zeros((self.room, len(model.languages)))
        self.used = 0

    def make_room(self, n: int) -> None:
        if self.used + n > self.room:
            self.clear()
            self.used = 0

    def __missing__(self, word: bytes) -> int:
        known = self.model.words.get(word)
        self.scores[self.used] = self.model.backoff(word) if known is None else self.model.values[known]
        self[word] = self.used
        self.used += 1
        return self[word]


class Model:
    """Log frequencies per language; rows of one matrix, found by word or n-gram."""

    def __init__(self, languages: list[str], words: dict[bytes, int], grams: dict[str, int], values: np.ndarray | Entries):
        self.languages, self.words, self.grams, self.values = languages, words, grams, values

    def backoff(self, word: bytes) -> np.ndarray:
        for order in ORDERS:
            known = [self.grams[g] for g in ngrams(word, order) if g in self.grams]
            if known:
                return sum(self.values[row] for row in known) / len(known)
        return np.zeros(len(self.languages))

    def predict(self, texts: Iterable[str | None], rows: Rows | None = None) -> Iterator[tuple[str, float]]:
        rows = Rows(self) if rows is None else rows
        for text in texts:
            if not text or not self.languages or not any(map(str.isalpha, text)):
                yield UNDECIDED, 0.0
                continue
            found = list(Counter(letter_words(text)).items())
            total = np.zeros(len(self.languages))
            for at in range(0, len(found), rows.room // 2):
                part = found[at : at + rows.room // 2]
                rows.make_room(len(part))
                total += np.array([n for _, n in part], dtype=float) @ rows.scores[[rows[w] for w, _ in part]]
            best = int(total.argmax())
            yield self.languages[best], float(1 / np.exp(total - total[best]).sum())


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
    sample: int = 500, entries: int = 200_000, least: int = 1_000, alpha: float = 0.5,
) -> Model:
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(doc_id)))
    sizes = {
        row["lang"]: row["n"]
        for row in labelled.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()  # one row a language
    }
    if not sizes:
        return Model([], {}, {}, np.zeros((0, 0)))
    bounds = [(name, (1 << 40) * sample // n) for name, n in sizes.items()]
    below = docs.sparkSession.createDataFrame(bounds, "_name string, _below long")
    key = draw_of(row_key(F.col("doc_id"), F.col("text")))
    drawn = (
        labelled.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
        .join(F.broadcast(below), F.col("lang") == F.col("_name")).filter(key < F.col("_below"))
    )
    share = max(least, entries // len(sizes) // (1 + len(ORDERS)))
    counts = counted(drawn, "text", "lang")
    # the most frequent of each language and order, out of a bounded sample
    group = Window.partitionBy("lang", "order")
    place = group.orderBy(F.desc("n"), "gram")
    frame = (
        counts.withColumns({"place": F.row_number().over(place), "total": F.sum("n").over(group), "kinds": F.count("*").over(group)})
        .filter(F.col("place") <= share).select("lang", "order", "gram", "n", "total", "kinds").toArrow().to_pandas()
    )
    languages = sorted(sizes)
    place_of = {name: i for i, name in enumerate(languages)}
    floor = np.zeros((1 + max(ORDERS), len(languages)))
    for name, order, total, kinds in frame[["lang", "order", "total", "kinds"]].drop_duplicates().itertuples(index=False):
        floor[int(order), place_of[name]] = np.log(total + alpha * kinds)
    floor[floor == 0] = np.log(1 + alpha)
    frame = frame.sort_values(["order", "gram", "lang"], ignore_index=True)
    new = ((frame["order"] != frame["order"].shift()) | (frame["gram"] != frame["gram"].shift())).to_numpy()
    starts = np.flatnonzero(new)
    orders, kept = frame["order"].to_numpy()[starts], frame["gram"].to_numpy()[starts]
    values = Entries(
        np.log(alpha) - floor, orders, np.append(starts, len(frame)), frame["lang"].map(place_of).to_numpy(dtype=np.int32),
        (np.log(frame["n"].to_numpy() + alpha) - np.log(alpha)),
    )
    if len(values) * len(languages) <= WIDE:
        values = values.dense()  # the same numbers, found faster
    words = {gram.encode(): row for row, (order, gram) in enumerate(zip(orders, kept)) if order == 0}
    grams = {gram: row for row, (order, gram) in enumerate(zip(orders, kept)) if order > 0}
    return Model(languages, words, grams, values)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add the columns lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(values: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rows = Rows(shared.value)
        for batch in values:
            yield pd.DataFrame(shared.value.predict(batch, rows), columns=["lang_pred", "score"])

    names = with_names(docs, ["found"])
    found = docs.drop("lang_pred", "score").withColumn(names["found"], predict(F.col(text)))
    return found.withColumns({part: F.col(f"{names['found']}.{part}") for part in ("lang_pred", "score")}).drop(names["found"])


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """Documents whose language is told with a posterior of at least `least`; their columns only."""
    found = identify(docs.select(F.struct("*").alias("row"), F.col(text).alias(text)), model, text)
    return found.filter((F.col("lang_pred") != UNDECIDED) & (F.col("score") >= least)).select("row.*")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs.select("doc_id", "text", "lang")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
