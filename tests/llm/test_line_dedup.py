import hashlib
import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from weakspot.llm import line_dedup as L


def masked(line):
    return " ".join("<*>" if any(c in "0123456789" for c in t) else t for t in line.split(" "))


def brute(docs, depth, min_docs, similarity):
    """Kept texts, by plain loops over the whole table."""
    digest = lambda form: hashlib.md5(form.encode()).hexdigest()
    each = [((doc, text), sorted({masked(s) for s in {s.strip(" ") for s in (text or "").split("\n")} - {""}})) for doc, text in docs]
    seen, times = defaultdict(lambda: defaultdict(set)), Counter()
    for key, (doc, text) in zip(each, docs):
        distinct = {s.strip(" ") for s in (text or "").split("\n")} - {""}
        times.update(masked(s) for s in distinct)
        for form in key[1]:
            tokens = form.split(" ")
            seen[len(tokens), " ".join(tokens[:depth])][form].add((doc, text))
    chosen, placed = {}, defaultdict(set)
    for leaf, forms in seen.items():
        n = leaf[0]
        parts = math.floor(n * (1 - similarity) + 1e-9) + 1
        groups = defaultdict(list)
        for form in forms:
            tokens = form.split(" ")
            for i in range(parts):
                groups[i, tuple(tokens[i * n // parts : (i + 1) * n // parts])].append(form)
        member = defaultdict(set)
        for group in groups.values():
            if sum(times[f] for f in group) >= min_docs:
                template = min(group, key=lambda f: (-times[f], digest(f)))
                for form in group:
                    if sum(a == b for a, b in zip(form.split(" "), template.split(" "))) >= similarity * n:
                        member[template].add(form)
        size = {t: len(set().union(*(forms[f] for f in own))) for t, own in member.items()}
        for form in forms:
            best = min((t for t, own in member.items() if form in own and size[t] >= min_docs), key=lambda t: (-size[t], digest(t)), default=None)
            if best is not None:
                chosen[form] = best
                placed[best] |= {doc for doc, _ in forms[form]}
    out = []
    for doc, text in docs:
        if text is None:
            out.append((doc, None))
            continue
        keep = []
        for line in text.split("\n"):
            owners = placed.get(chosen.get(masked(line.strip(" "))), set())
            first = None if None in owners else min(owners, default=None)
            if not owners or doc == first:
                keep.append(line)
        out.append((doc, "\n".join(keep)))
    return out


def cut(df):
    return {r.doc_id: r.text for r in L.without_recurring_lines(df).collect()}


def test_documents_count_and_not_occurrences(table):
    line = "the night train to {} leaves from platform two as ever".format
    docs = [(1, f"{line('york')}\n{line('leeds')}"), (2, line("york")), (2, line("york"))]
    assert cut(table(docs)) == dict(docs)
    more = cut(table([*docs, (3, line("bath"))]))
    assert more == {1: docs[0][1], 2: "", 3: ""}


def test_a_leaf_holds_several_templates(table):
    one = "we would like to thank {} for the help with this page".format
    two = "we would like to hear what readers of {} have to say".format
    names = "ann bea cid dan eva fox gus".split()
    docs = [(i, one(n)) for i, n in enumerate(names[:6])] + [(10 + i, two(n)) for i, n in enumerate(names[:5])] + [(30, "we would like to go home now if that is all right")]
    assert len({(len(t.split()), tuple(t.split()[:4])) for _, t in docs}) == 1
    kept = {d for d, t in cut(table(docs)).items() if t}
    assert kept == {0, 10, 30}


def test_matches_brute_force(table, prose):
    shared = prose(1, 60)
    near = lambda i: " ".join(w if n != 20 + i % 30 else f"word{chr(97 + i)}" for n, w in enumerate(shared.split()))
    docs = [(i, f"{prose(i, 12)}\n  user {i} logged in at 10:{i} today \n\n{near(i)}\nThe end.") for i in range(12)]
    docs += [(20, None), (21, ""), (22, "\n\n"), (23, "The end."), (23, "The end."), (None, "The end.\nown words here"), (24, "x " * 3000 + "y")]
    docs += [(30 + i, "Read the manual first\nRead the manual twice") for i in range(2)]
    got = L.without_recurring_lines(table(docs))
    assert got.columns == table(docs).columns
    key = lambda r: (str(r[0]), str(r[1]))
    want = brute(docs, 4, 3, 0.8)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(want, key=key)
    assert any(t is not None and len(t) < len(s or "") for (_, t), (_, s) in zip(want, docs))


def test_emptied_documents_and_empty_table(table):
    docs = table([(i, "One line that all of them share") for i in range(4)] + [(9, ""), (10, None)])
    kept = L.without_recurring_lines(docs, drop_emptied=True)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 9, 10]
    assert L.without_recurring_lines(table([])).count() == 0


def test_stretches_are_cut_from_tokens_split_beforehand(spark):
    rows = spark.createDataFrame([("a b c d e".split(),), (["x"],)], "tokens array<string>")
    cut = rows.select(L.stretches(F.col("tokens"), 0.8).alias("cut"))
    assert "split(" not in cut._jdf.queryExecution().optimizedPlan().toString()
    hashes = rows.limit(1).select(F.xxhash64(F.slice("tokens", 1, 2)), F.xxhash64(F.slice("tokens", 3, 3))).first()
    assert [[(part["at"], part["hash"]) for part in row.cut] for row in cut.collect()][0] == list(enumerate(hashes))
    assert [len(row.cut) for row in cut.collect()] == [2, 1]
