import random
import re
from collections import Counter, defaultdict

import pytest

from weakspot.llm import divergence
from weakspot.llm.divergence import divergences

SCHEMA = "doc_id long, lang string, source string, text string, term string, p long"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    kept = {lang: [t for t, n in seen.items() if n >= least] for lang, seen in docs.items()}

    def shares(lang, count):
        n = sum(count[t] for t in kept[lang])
        return {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * len(kept[lang])) for t in kept[lang]}

    def far(p, q):
        return (p - q) ** 2 // (p + q)

    result = []
    for (lang, source), count in counts.items():
        mine = shares(lang, count)
        pairs = [(sum(far(p, q[t]) for t, p in mine.items()), peer)
                 for (other, peer), c in counts.items() if other == lang and peer != source for q in [shares(lang, c)]]
        total = shares(lang, sum((c for (other, _), c in counts.items() if other == lang), Counter()))
        terms = [(far(p, total[t]), t) for t, p in mine.items() if count[t] and p > total[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, 10)):
            found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            result += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(result)


def made(seed=3):
    draw = random.Random(seed)
    words = ["alpha", "Beta", "ÉTÉ", "été", "日本", "don't", "x1y", "rare", "ß", "q"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = []
    for k in range(260):
        lang = draw.choice(["en", "en", "de", None, ""])
        source = draw.choice(["hot", "hot", "hot", "é", "z", "a b", None, "", f"s{k % 7}"])
        pick = words if source != "hot" else words[:12]
        rows.append((lang, source, " ".join(draw.choice(pick) for _ in range(draw.choice([0, 1, 5, 40])))))
    rows += [("en", "silent", None), ("en", "silent", "12 34"), ("fr", "one", "only here"), ("fr", "two", ""), (None, None, None), ("de", "new", "unseen")]
    return rows + rows[:20] + [("en", "long", "alpha beta " * 30_000)]


def table(spark, rows):
    return spark.createDataFrame([(None, *r, "clash", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("least", [1, 10])
def test_as_summed_by_hand(spark, least):
    rows = made()
    got = sorted(tuple(r) for r in divergences(table(spark, rows), least).collect())
    assert got == brute(rows, least)


def test_runs_and_pieces_make_no_difference(spark, monkeypatch):
    rows = made(8)
    for name, size in (("HELD", 5), ("RUN", 3), ("BUCKET", 2)):  # they travel with the functions that tasks run
        monkeypatch.setattr(divergence, name, size)
    assert sorted(tuple(r) for r in divergences(table(spark, rows), 3).collect()) == brute(rows, 3)


def test_accumulation_in_small_pieces(monkeypatch):
    import numpy as np
    import pandas as pd

    monkeypatch.setattr(divergence, "MATCHES", 2)
    draw = random.Random(1)
    terms = [[(t, s, draw.randint(1, 10**9), 5 + s) for s in range(6) if draw.random() < 0.7] for t in range(9)]
    frame = pd.DataFrame([x for term in terms for x in term], columns=["term", "source", "p", "p0"]).assign(lang="en")
    found = pd.concat(divergence.accumulated(frame))
    want = Counter()
    far = divergence.distance
    for term in terms:
        for _, g, p, p0 in term:
            for _, h, q, q0 in term:
                if g != h:
                    want[g, h] += int(far(p, q) - far(p, q0) - far(p0, q) + far(p0, q0))
    assert {(r.source, r.item): r.value for r in found.itertuples()} == {k: v for k, v in want.items() if v}
    assert found["value"].dtype == np.int64


def test_large_counts_stay_exact(spark):
    count = spark.sql("SELECT 9007199254740993L AS c, 9007199254740995L AS n, 3L AS v")
    row = count.select(divergence.share(count["c"], count["n"], count["v"]).alias("p")).first()
    assert row.p == 1 + 10**9 * (9007199254740993 + 2) // (9007199254740995 + 6)


def test_empty_table(spark):
    assert divergences(table(spark, [])).collect() == []
