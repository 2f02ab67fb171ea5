import random

from weakspot.llm import jaccard_join as J


def grams(text, n=5):
    words = J.word_list(text)
    return {tuple(words[i: i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(docs):
    sets = [grams(t) for _, t in docs]
    near = [[i for i, b in enumerate(sets) if i != k and a and b and 5 * len(a & b) >= 4 * len(a | b)] for k, a in enumerate(sets)]
    group = list(range(len(docs)))
    for _ in docs:
        group = [min([group[k]] + [group[i] for i in near[k]]) for k in range(len(docs))]
    ids = lambda k: min((docs[i][0] for i in range(len(docs)) if group[i] == group[k] and docs[i][0] is not None), default=None)
    return [(docs[k][0], len(near[k]), ids(k) if sets[k] else docs[k][0]) for k in range(len(docs))]


def corpus(prose):
    draw = random.Random(7)

    def changed(text, n):
        words = text.split()
        for _ in range(n):
            words[draw.randrange(len(words))] = f"new{draw.randrange(999)}"
        return " ".join(words)

    docs = [(i, prose(i, 60 + i)) for i in range(30)]
    for base in range(8):
        docs += [(100 + 10 * base + k, changed(docs[base][1], k % 4)) for k in range(6)]
    docs += [(200, docs[3][1].upper()), (201, docs[3][1] + "!"), (201, docs[3][1] + "!"), (None, docs[4][1]), (210, "one two"), (211, "One, two."),
             (212, ""), (213, None), (214, "..."), (215, prose(99, 6000)), (216, prose(99, 5990))]
    return docs


def test_matches_brute_force(table, prose):
    docs = corpus(prose)
    rows = J.joined(table(docs)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.n_links, r.component_id) for r in rows), key=key) == sorted(brute(docs), key=key)
    assert all(r.kept for r in rows if r.n_links == 0)


def test_one_of_each_group_stays(table, prose):
    docs = corpus(prose)
    left = J.one_of_each(table(docs))
    assert left.columns == table(docs).columns
    kept = [r.doc_id for r in left.collect()]
    groups = {c for d, n, c in brute(docs) if n}
    alone = [d for d, n, _ in brute(docs) if not n]
    assert sorted(map(str, kept)) == sorted(map(str, list(groups) + alone))


def test_blocks_of_a_large_group_count_every_link(spark, prose, monkeypatch):
    # many small blocks, so that one group is compared across blocks
    monkeypatch.setattr(J, "BLOCK_CLASSES", 4)
    base = prose(5, 300).split()
    docs = [(i, " ".join(base[:i] + [f"own{i}"] + base[i + 1:])) for i in range(40)]
    rows = J.joined(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.n_links, r.component_id) for r in rows} == {(39, 0)}


def test_empty_table_and_banding(table):
    assert J.joined(table([])).count() == 0
    bands, rows = J.banding(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9999
