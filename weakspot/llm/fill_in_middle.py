"""Fill-in-middle transformation: texts cut in three by code points and put in another order.

Texts come in Arrow batches, as UTF-8 bytes.  A batch gets one sparse index: the
positions of its multibyte characters and their excess bytes.  Characters are bytes
less the excess; a cut by code points is found by one binary search among the
multibyte characters before it, and in ASCII stretches by arithmetic alone.  No text is
decoded.

The cuts and the form follow from a hash of the row's id, so that a lost task gives the
same again.  Null texts count as empty; a null id is hashed as no digits, repeated rows
come out alike.  A text that is empty or holds one of the marks stays plain.  All other
columns are kept; one that is called like a result column moves aside (`room_for`).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weakspot.llm.common import read, room_for, with_names

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
RESULTS = ["n", "form", "prefix_chars", "middle_chars", "output"]


class ExceptionIndex:
    """Multibyte characters of a run of UTF-8 bytes: where each begins and how many bytes it has beyond one."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        #: excess bytes before the k-th multibyte character, and in all
        self.before = np.concatenate([[0], np.cumsum(excess)])
        #: number of the character, counted over the whole run
        self.number = self.at - self.before[:-1]

    def number_of(self, byte: np.ndarray) -> np.ndarray:
        """How many characters begin before a byte position (where a character begins)."""
        return byte - self.before[np.searchsorted(self.at, byte)]

    def byte_of(self, number: np.ndarray) -> np.ndarray:
        """Where the character of that number begins."""
        return number + self.before[np.searchsorted(self.number, number)]


def utf8(texts: pa.Array) -> tuple[np.ndarray, memoryview, np.ndarray]:
    """Bytes of a string array and the bounds of its rows among them."""
    _, bounds, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bounds = np.frombuffer(bounds, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = memoryview(data or b"")[bounds[0] : bounds[-1]]
    return np.frombuffer(data, np.uint8), data, bounds - bounds[0]


def transformed(texts: pa.Array, draws: list[np.ndarray], rate: int, spm: int) -> list[pa.Array]:
    """The result columns for one batch."""
    if not len(texts):
        return [pa.array([], t) for t in (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())]
    texts = pc.fill_null(texts, "")
    data, view, bounds = utf8(texts)
    index = ExceptionIndex(data)
    numbers = index.number_of(bounds)
    n = np.diff(numbers)
    marked = np.zeros(len(texts), bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.match_substring(texts, mark.decode()).to_numpy(zero_copy_only=False)
    plain = (n == 0) | marked | (draws[2] % 100 >= rate)
    suffix_first = draws[3] % 100 < spm
    one, two = draws[0] % (n + 1), draws[1] % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    first, second = index.byte_of(numbers[:-1] + low), index.byte_of(numbers[:-1] + high)
    outputs = []
    for k in range(len(texts)):
        start, end = bounds[k], bounds[k + 1]
        if plain[k]:
            outputs.append(view[start:end])
            continue
        prefix, middle, suffix = view[start : first[k]], view[first[k] : second[k]], view[second[k] : end]
        parts = (SUFFIX, suffix, PREFIX, prefix) if suffix_first[k] else (PREFIX, prefix, SUFFIX, suffix)
        outputs.append(b"".join((*parts, MIDDLE, middle)))
    forms = np.where(plain, "plain", np.where(suffix_first, "spm", "psm"))
    return [
        pa.array(n), pa.array(forms.tolist(), pa.string()), pa.array(low, mask=plain), pa.array(high - low, mask=plain),
        pa.array([bytes(o) for o in outputs], pa.binary()).cast(pa.string()),
    ]


def fill_in_middle(
    docs: DataFrame, rate: int = 90, spm: int = 20, seed: str = "1", doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Add n, form, prefix_chars, middle_chars and output; `rate` and `spm` are in hundredths."""
    if {doc_id.lower(), text.lower()} & set(RESULTS):
        raise ValueError("the columns of ids and texts can't be called like results")
    docs = room_for(docs, RESULTS)
    kept, helpers = docs.columns, with_names(docs, ["h1", "h2", "h3", "h4"])
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    docs = docs.withColumns({
        name: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k, name in enumerate(helpers.values())
    })

    def batches_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = [batch.column(name).to_numpy() for name in helpers.values()]
            columns = [batch.column(name) for name in kept]
            results = transformed(batch.column(text), draws, rate, spm)
            yield pa.RecordBatch.from_arrays([*columns, *results], names=[*kept, *RESULTS])

    schema = T.StructType([docs.schema[c] for c in kept])
    for name, kind in zip(RESULTS, ("long", "string", "long", "long", "string")):
        schema = schema.add(name, kind)
    return docs.mapInArrow(batches_of, schema)


def restored(output: Column, form: Column) -> Column:
    """The text, put together again from the output and its form alone."""
    parts = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP13_SQL = """
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents
), draw AS (
  SELECT *, CAST('0x' || substr(k, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(k, 9, 8) AS BIGINT) % (n + 1) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(k, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || substr(k, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM doc
), cut AS (
  SELECT *, substring(t, 1, least(a, b)) AS p, substring(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS m, substring(t, greatest(a, b) + 1) AS s FROM draw
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(least(a, b) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(greatest(a, b) - least(a, b) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM cut
"""
