import hashlib
import random

import pytest

from weakspot.llm.fill_in_middle import fill_in_middle, restored

SCHEMA = "doc_id long, text string, form string, N long, _form string"


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    low, high = sorted((a % (n + 1), b % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:low], text[low:high], text[high:]
    if d % 100 < 20:
        return n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}"


def texts():
    draw = random.Random(5)
    kinds = ["abc xyz\n", "aé", "日本語 text", "a😀é日", "<PSM>", "é" * 3, "\x00\x7f"]
    made = [(i, "".join(draw.choice(kind) for _ in range(draw.choice([0, 1, 2, 7, 300])))) for i, kind in enumerate(kinds * 40)]
    made += [(900, None), (901, ""), (None, None), (None, "no id é"), (902, "a <S> b"), (903, "<P"), (904, "é😀" * 60_000), (905, "x" * 200_000)]
    return made + made[:3]


def test_as_cut_by_hand(spark):
    rows = [(i, t, "mine", 7, "other") for i, t in texts()]
    for parts in (1, 5):
        found = fill_in_middle(spark.createDataFrame(rows, SCHEMA).repartition(parts))
        assert found.columns == ["doc_id", "text", "__form", "_N", "_form", "n", "form", "prefix_chars", "middle_chars", "output"]
        again = found.withColumn("again", restored(found["output"], found["form"])).collect()
        got = sorted((str((r.doc_id, r.text)), (r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in again)
        assert got == sorted((str((i, t)), brute(i, t)) for i, t, *_ in rows)
        assert all(r.again == (r.text or "") and (r["__form"], r["_N"], r["_form"]) == ("mine", 7, "other") for r in again)
        assert {r.form for r in again} == {"plain", "psm", "spm"}


def test_empty_tables_and_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fill_in_middle(empty).collect() == []
    named = spark.createDataFrame([(1, "long enough to be cut")], "key long, body string")
    row = fill_in_middle(named, rate=100, spm=0, doc_id="key", text="body").first()
    assert row.form == "psm" and row.output.startswith("<P>")
    with pytest.raises(ValueError):
        fill_in_middle(named.withColumnRenamed("body", "output"), doc_id="key", text="output")
