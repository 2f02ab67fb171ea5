"""Secret scan: fixed patterns plus a battery of randomness tests.

The patterns give the base spans.  Besides, every run of 20 or more characters of a
key alphabet is looked at.  It is split at each `=` that is not padding at its end; a
part is a candidate, and so are its pieces between `/`, between `_` and `-`, and
between all of them, if they have 20 or more characters and an alphabet holds them.  So
NAME=<key> and path_a/<key> are found as well as keys that hold those marks; of nested
candidates beyond the cut the longest is reported.  A candidate's encoding is inferred
from its characters and three tests of "drawn at random from that alphabet" are made: chi-squared for a uniform
alphabet, the number of runs above and below the middle of the alphabet, and the
serial correlation of neighbours.  Fisher's sum joins them into one p-value, high
for random strings.

How often ordinary writing of the same length passes for random is taken from the
corpus: the whole running text of each document, without blanks, is cut into stretches
that follow each other, once for each length class.  What is left at the end is shorter
than the class.  Per length class, the cut on the p-value is the lowest at which the
expected number of ordinary strings beyond it, out of all candidates that touch no base
span, is at most `rate` of the spans that would be reported at it (Benjamini-Hochberg on
a grid): of nested candidates one is reported, though each is a test.  Counts cover all
documents; what reaches the driver is one row per class and cell of the grid.

Null texts count as empty.  Repeated rows are worked off one by one; further columns
are kept.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from weakspot.llm.common import read

# fixed values: patterns of the base spans, with the least length that counts
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ["assign", "access", "hex", "random"]
KEYWORDS = ("passw", "secret", "token", "api")

LEAST = 20
#: bytes that a candidate may hold; all others become blanks
KEY_BYTES = bytes(b if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-" else 32 for b in range(256))
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}")
#: what stands between the signs of equality of a run, with the padding at its end
VALUE = re.compile(r"[^=]+(?:=+\Z)?")
#: a whole value, and its pieces between marks that are in some alphabets and not in others
PIECES = [re.compile(p) for p in (r".+", r"[^/]+", r"[^_-]+", r"[^/_-]+")]
#: least lengths of the classes
CLASSES = [20, 28, 40, 64, 128]
#: lower bounds of the cells of the grid over p
CELLS = np.concatenate([[0.0], np.logspace(-6, -1, 11), np.linspace(0.2, 0.9, 8)])

# fixed values: the alphabets in their natural order
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = {
    "digits": DIGITS, "hex": DIGITS + "abcdef", "HEX": DIGITS + "ABCDEF", "base32": UPPER + "234567",
    "lower": LOWER + DIGITS, "base64": UPPER + LOWER + DIGITS + "+/", "base64url": UPPER + LOWER + DIGITS + "-_",
}
MEMBERS = {name: frozenset(alphabet) for name, alphabet in ALPHABETS.items()}
PLACES = {name: {c: i for i, c in enumerate(alphabet)} for name, alphabet in ALPHABETS.items()}


def encoding_of(text: str) -> str | None:
    """Smallest alphabet that holds all characters."""
    held = set(text)
    return next((name for name, members in MEMBERS.items() if held <= members), None)


def both_tails(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def randomness(text: str) -> float:
    """Joint p-value of the three tests; 0 where no encoding fits."""
    body = text.rstrip("=")
    name = encoding_of(body)
    n = len(body)
    if name is None or n < 8:
        return 0.0
    places, size = PLACES[name], len(ALPHABETS[name])
    numbers = [places[c] for c in body]
    # uniform alphabet: pairs of equal characters are as many as chance has it
    pairs = sum(c * (c - 1) // 2 for c in Counter(numbers).values())
    expected = n * (n - 1) / 2 / size
    chi = (size * 2 * pairs / n + size - n)  # sum of (seen - n/size)^2 / (n/size)
    spread = math.sqrt(max(1e-9, 2 * (size - 1) * (n - 1) / n))
    uniform = both_tails((chi - (size - 1)) / spread) if pairs > expected else 1.0
    # runs above and below the middle
    high = [v >= size / 2 for v in numbers]
    above = sum(high)
    below = n - above
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    if above and below:
        mean = 2 * above * below / n + 1
        variance = (mean - 1) * (mean - 2) / (n - 1)
        crossing = both_tails((runs - mean) / math.sqrt(max(variance, 1e-9)))
    else:
        crossing = 0.0
    # serial correlation
    values = np.array(numbers, dtype=float)
    values -= values.mean()
    scale = float(values @ values)
    serial = both_tails(float(values[:-1] @ values[1:]) / scale * math.sqrt(n)) if scale > 0 else 0.0
    if min(uniform, crossing, serial) <= 0:
        return 0.0
    half = -(math.log(uniform) + math.log(crossing) + math.log(serial))  # Fisher, six degrees of freedom
    return math.exp(-half) * (1 + half + half * half / 2)


def length_class(n: int) -> int:
    return sum(n >= least for least in CLASSES) - 1


def cell_of(p: float) -> int:
    return int(np.searchsorted(CELLS, p, side="right")) - 1


def parts_of(run: str) -> Iterator[tuple[int, int]]:
    """Spans of the candidates within a run, longer ones before those within them."""
    for value in VALUE.finditer(run):
        begin = value.start()
        spans = {m.span() for pattern in PIECES for m in pattern.finditer(value[0])}
        for start, end in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
            if end - start >= LEAST and encoding_of(value[0][start:end].rstrip("=")):
                yield begin + start, begin + end


def candidates(text: str, raw: bytes | None = None) -> list[tuple[int, int, str]]:
    """Parts of long runs of key characters; the bytes tell cheaply whether there are any."""
    raw = text.encode("utf-8", "surrogatepass") if raw is None else raw
    if max(map(len, raw.translate(KEY_BYTES).split()), default=0) < LEAST:
        return []
    return [
        (m.start() + start, m.start() + end, m[0][start:end]) for m in CANDIDATE.finditer(text) for start, end in parts_of(m[0])
    ]


#: per byte a bit for each alphabet that holds it, and its place in each
BITS_OF = np.array([sum(1 << k for k, held in enumerate(MEMBERS.values()) if chr(b) in held) for b in range(256)], dtype=np.uint8)
PLACE_OF = np.array([[places.get(chr(b), 0) for b in range(256)] for places in PLACES.values()], dtype=np.int16)
SIZE_OF = np.array([len(a) for a in ALPHABETS.values()])
#: characters whose stretches are worked off at once
AT_ONCE = 1 << 18


def tails(z: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.erfc, (np.abs(z) / math.sqrt(2)).tolist()), dtype=float, count=len(z))


def randomness_of_rows(chars: np.ndarray) -> np.ndarray:
    """`randomness` of each row of a matrix of bytes without padding, at least 8 to a row."""
    rows, n = chars.shape
    fits = np.bitwise_and.reduce(BITS_OF[chars], axis=1)
    name = np.log2(np.maximum(1, fits & -fits.astype(np.int16))).astype(np.int64)  # the lowest bit
    size = SIZE_OF[name]
    numbers = PLACE_OF[name[:, None], chars]
    seen = np.bincount((numbers + 64 * np.arange(rows)[:, None]).ravel(), minlength=64 * rows).reshape(rows, 64)
    pairs = ((seen * seen).sum(axis=1) - n) // 2
    chi = size * 2 * pairs / n + size - n
    spread = np.sqrt(np.maximum(1e-9, 2 * (size - 1) * (n - 1) / n))
    uniform = np.where(pairs > n * (n - 1) / 2 / size, tails((chi - (size - 1)) / spread), 1.0)
    high = 2 * numbers >= size[:, None]
    above = high.sum(axis=1)
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 2 * above * (n - above) / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    crossing = np.where((above > 0) & (above < n), tails((runs - mean) / np.sqrt(np.maximum(variance, 1e-9))), 0.0)
    values = numbers - numbers.mean(axis=1, keepdims=True)
    scale = np.einsum("ij,ij->i", values, values)
    serial = np.where(scale > 0, tails(np.einsum("ij,ij->i", values[:, :-1], values[:, 1:]) / np.where(scale > 0, scale, 1) * math.sqrt(n)), 0.0)
    some = (fits > 0) & (np.minimum(np.minimum(uniform, crossing), serial) > 0)
    half = -sum(np.log(np.where(some, p, 1.0)) for p in (uniform, crossing, serial))
    return np.where(some, np.exp(-half) * (1 + half + half * half / 2), 0.0)


def running(text: str) -> bytes:
    """The words of a text without blanks, but for those long enough to be candidates."""
    return b"".join(w for w in text.encode("utf-8", "replace").translate(KEY_BYTES).split() if len(w) < LEAST)


class Ordinary:
    """Counts of all stretches of running text, by class and cell."""

    def __init__(self):
        self.counts, self.waiting, self.held = Counter(), [], 0

    def add(self, text: str) -> None:
        letters = running(text)
        if len(letters) >= CLASSES[0]:
            self.waiting.append(letters)
            self.held += len(letters)
            if self.held >= AT_ONCE:
                self.work_off()

    def work_off(self) -> None:
        for group, least in enumerate(CLASSES):
            cut = np.frombuffer(b"".join(w[: len(w) // least * least] for w in self.waiting), dtype=np.uint8).reshape(-1, least)
            for at in range(0, len(cut), AT_ONCE // least):
                # padding at the end of a stretch is not judged, as in a candidate
                part = cut[at: at + AT_ONCE // least]
                padded = part[:, -1] == ord("=")
                values = [randomness_of_rows(part[~padded])] + [[randomness(bytes(row).decode("ascii"))] for row in part[padded]]
                cells, n = np.unique(np.searchsorted(CELLS, np.concatenate(values), side="right") - 1, return_counts=True)
                for cell, many in zip(cells.tolist(), n.tolist()):
                    self.counts[group, cell, 1] += many
        self.waiting, self.held = [], 0


def base_spans(text: str, raw: bytes, long: bool) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns; `long` tells whether a run of 20 key characters is there at all."""
    low = raw.lower()
    spans = []
    if any(k.encode() in low for k in KEYWORDS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if long:
        spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return spans


def untouched(found: list[tuple[int, int, str]], base: list[tuple[str, int, int]]) -> list[tuple[int, int, str]]:
    """Candidates that overlap no base span."""
    if not base:
        return found
    ordered = sorted((start, end) for _, start, end in base)
    starts, reach = [s for s, _ in ordered], list(accumulate((e for _, e in ordered), max))

    def free(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return not before or reach[before - 1] <= start

    return [c for c in found if free(c[0], c[1])]


def outermost(spans: Iterable[tuple]) -> Iterator[tuple]:
    """Of nested and overlapping spans (start, end, ...) those that come first; runs come in order."""
    taken: list[tuple[int, int]] = []
    for span in spans:
        start, end = span[:2]
        if taken and start >= max(e for _, e in taken):
            taken = []
        if not any(s < end and start < e for s, e in taken):
            taken.append((start, end))
            yield span


def histogram(docs: DataFrame, text: str = "text") -> dict[tuple[int, int], tuple[int, int, int]]:
    """(class, cell) -> (candidates, ordinary strings, spans reported with the cut at the cell), over all documents."""

    def counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ordinary = Ordinary()
            counts = ordinary.counts
            for value in batch.iloc[:, 0]:
                if value:
                    raw = value.encode("utf-8", "surrogatepass")
                    long = candidates(value, raw)
                    if long:
                        left = [
                            (start, end, length_class(len(found)), cell_of(randomness(found)))
                            for start, end, found in untouched(long, base_spans(value, raw, True))
                        ]
                        counts.update((group, cell, 0) for _, _, group, cell in left)
                        for cut in range(1, 1 + max((cell for *_, cell in left), default=0)):
                            counts.update((group, cut, 2) for _, _, group, _ in outermost(c for c in left if c[3] >= cut))
                    ordinary.add(value)
            ordinary.work_off()
            if counts:  # an empty frame has no types
                yield pd.DataFrame([(*key, n) for key, n in counts.items()], columns=["class", "cell", "plain", "n"])

    rows = (
        docs.select(F.col(text)).mapInPandas(counted, "class int, cell int, plain int, n long")
        .groupBy("class", "cell")
        .agg(*[F.sum(F.when(F.col("plain") == kind, F.col("n"))).alias(name) for kind, name in enumerate(("found", "ordinary", "told"))])
    )
    return {(r["class"], r["cell"]): (r["found"] or 0, r["ordinary"] or 0, r["told"] or 0) for r in rows.collect()}


def cuts(counts: dict[tuple[int, int], tuple[int, int, int]], rate: float) -> list[float]:
    """Per length class the lowest p-value that counts as random; above 1 where none does."""
    result = []
    for group in range(len(CLASSES)):
        found, plain, told = zip(*(counts.get((group, cell), (0, 0, 0)) for cell in range(len(CELLS))))
        cut = 2.0
        for cell in range(1, len(CELLS)):
            tail = (1 + sum(plain[cell:])) / (1 + sum(plain))
            if told[cell] and sum(found) * tail <= rate * told[cell]:
                cut = float(CELLS[cell])
                break
        result.append(cut)
    return result


def spans_of(text: str, limits: list[float]) -> list[tuple[str, int, int]]:
    """All spans by start, then kind."""
    raw = text.encode("utf-8", "surrogatepass")
    long = candidates(text, raw)
    spans = base_spans(text, raw, bool(long))
    # the pieces of what is reported are not reported again
    random = (c for c in untouched(long, spans) if randomness(c[2]) >= limits[length_class(len(c[2]))])
    spans += [("random", start, end) for start, end, _ in outermost(random)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan_secrets(docs: DataFrame, text: str = "text", rate: float = 0.01) -> DataFrame:
    """Add an array column `secrets` of (kind, start, end) in code points, end exclusive."""
    limits = cuts(histogram(docs, text), rate)

    @F.pandas_udf("array<struct<kind: string, start: long, end: long>>")
    def scan(values: pd.Series) -> pd.Series:
        return pd.Series([
            [{"kind": k, "start": s, "end": e} for k, s, e in spans_of(v or "", limits)] for v in values
        ])

    return docs.withColumn("secrets", scan(F.col(text)))


def redacted(text, spans):
    """Text with each span replaced by its kind in brackets; overlapping spans merge under the first kind."""
    merged = F.aggregate(
        spans, F.lit(None).cast("array<struct<kind: string, start: bigint, end: bigint>>"),
        lambda done, s: F.when(done.isNull(), F.array(s)).when(
            s["start"] < F.element_at(done, -1)["end"],
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["kind"].alias("kind"), F.element_at(done, -1)["start"].alias("start"),
                F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
            ))),
        ).otherwise(F.concat(done, F.array(s))),
    )
    out = F.aggregate(
        merged, F.struct(F.lit("").alias("text"), F.lit(0).cast("bigint").alias("at")),
        lambda state, s: F.struct(
            F.concat(
                state["text"], F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")),
                F.lit("["), s["kind"], F.lit("]"),
            ).alias("text"),
            s["end"].alias("at"),
        ),
        lambda state: F.concat(state["text"], F.substr(text, (state["at"] + 1).cast("int"))),
    )
    return F.when(F.size(spans) > 0, out).otherwise(text)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secrets")
    text = lambda array: F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(text(F.filter(spans, lambda s: s["kind"] != "random")), 256).alias("base_sha256"), text(spans).alias("spans"),
        count("random").alias("n_random"),
    )
