import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from weakspot.llm import language_id as I, mixing as M, quality_classifier as Q, token_counts as T
from weakspot.llm.common import words

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ei", "ver"], "cc": ["çé", "eau", "que", "ion"]}


def spoken(lang, seed, n):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 5))) for _ in range(n))


def test_languages_are_told_and_held_out_rows_not_learnt(spark):
    rows = [(i, spoken(lang, i, 40), lang, i) for i in range(90) for lang in [sorted(SYLLABLES)[i % 3]]]
    rows += [(1000, None, "aa", 0), (1001, "", "bb", 0), (1002, "12 34 !", "cc", 0), (1003, "KALOMI", None, 0), (None, spoken("cc", 7, 9), "cc", 0),
             (1004, "中文", None, 0), (1005, spoken("bb", 1, 30_000), None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred int")
    model = I.train(docs)
    assert model.languages == sorted(SYLLABLES)
    got = {r.doc_id: r for r in I.identify(docs, model).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang_pred == lang for i, _, lang, _ in rows[:90])
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert (got[1003].lang_pred, got[1005].lang_pred, got[None].lang_pred) == ("aa", "bb", "cc")
    assert got[1004].lang_pred in SYLLABLES and 0 <= got[1004].score <= 1
    # the held-out rows may say what they like
    lied = docs.withColumn("lang", F.when(I.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    again = I.train(lied)
    assert (again.words, again.languages) == (model.words, model.languages) and np.array_equal(again.values, model.values)
    assert I.accepted(docs, model).columns == docs.columns
    nothing = I.train(docs.filter("false"))
    assert {r.lang_pred for r in I.identify(docs, nothing).collect()} == {"und"}


def test_backoff_takes_the_longest_known_ngram():
    model = I.Model(["x", "y"], {b"known": 0}, {"abc": 1, "a": 2}, np.log(np.array([[0.9, 0.1], [0.2, 0.8], [0.7, 0.3]])))
    assert [p[0] for p in model.predict(["known", "zabcz", "za"])] == ["x", "y", "x"]


def test_histogram_answers_match_a_plain_count(spark):
    lengths = [0, 0, 1, 5, 5, 5, 9, 5000, 5000, 123_456]
    rows = [(n, None if i % 3 else "s") for i, n in enumerate(lengths)]
    counted = spark.createDataFrame(rows, "n_tokens long, source string")
    for r in T.histogram(counted).collect():
        assert r.docs_at_least == sum(n >= r.length for n in lengths) and r.n_docs == lengths.count(r.length)
        assert r.tokens_at_least == sum(n for n in lengths if n >= r.length)
        assert r.tokens_cut_here == sum(min(n, r.length) for n in lengths)
    whole = T.histogram(counted, ["source"])
    limits = {(r.source, r.limit): (r.docs_over, r.tokens_cut) for r in T.at_limits(whole, [4, 5, 8192], ["source"]).collect()}
    for (source, limit), got in limits.items():
        own = [n for n, s in rows if s == source]
        assert got == (sum(n > limit for n in own), sum(min(n, limit) for n in own))
    half = {r.share: r.length for r in T.quantiles(T.histogram(counted), [0.5, 1.0]).collect()}
    assert half == {0.5: 5, 1.0: 123_456}
    assert T.histogram(counted.filter("false")).count() == 0


def test_lengths_are_those_of_the_encoding(table):
    encoding = T.encoding(T.vocabulary_bytes(T.VOCABULARY))
    texts = [None, "", "Hello world", "  naïve\n\n日本 " * 50, "x" * 50_000]
    got = {r.doc_id: r.n_tokens for r in T.with_length(table(list(enumerate(texts)))).collect()}
    assert got == {i: len(encoding.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    assert encoding.decode(encoding.encode_ordinary(texts[3])) == texts[3]


def quality_rows(prose):
    junk = ["!! ".join(prose(i, 60).upper().split()) for i in range(20)] + [" ".join(["same"] * 80)] * 5 + [" | ".join(prose(i, 40).split()) for i in range(15)]
    good = [". ".join(f"{prose(1000 + 9 * i + k, 12)}".capitalize() for k in range(6)) + "." for i in range(80)]
    return [(i, t) for i, t in enumerate(good)] + [(500 + i, t) for i, t in enumerate(junk)]


def test_weak_labels_and_scorer(table, prose):
    docs = quality_rows(prose) + [(900, None), (901, ""), (None, "word")]
    rows = {r.doc_id: r for r in Q.classify(table(docs)).collect()}
    assert len(rows) == len(docs)
    assert np.mean([rows[i].kept for i in range(80)]) > 0.95 and np.mean([rows[500 + i].kept for i in range(40)]) < 0.1
    assert (rows[900].score, rows[901].score, rows[900].kept) == (0.0, 0.0, False)
    assert Q.classify(table([])).count() == 0


def test_expectation_maximisation_finds_known_accuracies():
    draw = random.Random(4)
    m = len(Q.LABELLERS)
    right = [0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6][:m]
    counts, truth = Counter(), Counter()
    for _ in range(40_000):
        good = draw.random() < 0.7
        number = 0
        for p in right:
            vote = Q.ABSTAIN if draw.random() < 0.2 else Q.GOOD if (draw.random() < p) == good else Q.BAD
            number = number * 3 + vote
        counts[number] += 1
        truth[number] += good
    labels, rates = Q.posteriors(counts)
    for k, p in enumerate(right):
        assert abs(rates[1, k, Q.GOOD] / (rates[1, k, Q.GOOD] + rates[1, k, Q.BAD]) - p) < 0.03
    assert sum(abs(labels[n] * c - truth[n]) for n, c in counts.items()) / 40_000 < 0.12


def test_rates_meet_targets_as_a_plain_descent_does(spark):
    draw = np.random.default_rng(2)
    p = draw.dirichlet([0.5, 0.3, 0.2], 300)
    n = draw.integers(0, 400, 300)
    table = spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(n, p)], "n long, a double, b double, c double").cache()
    for goal in ([0.6, 0.3, 0.1], [0.05, 0.05, 0.9]):
        history = M.fitted(table, "n", ["a", "b", "c"], goal)
        rates = np.array([r.rate for r in table.withColumn("rate", M.rate_of([F.col(c) for c in "abc"], history)).collect()])
        want, plain = np.array(goal) * n.sum(), np.ones(300)
        for step in history:
            plain = np.maximum(0, plain - p @ np.array(step))
        assert np.allclose(rates, plain) and (rates >= 0).all()
        assert np.abs((rates * n) @ p - want).sum() < 1e-4 * n.sum()
        # a long plain descent gets no nearer
        metric, slow = np.linalg.pinv((p * n[:, None]).T @ p), np.ones(300)
        for _ in range(5000):
            slow = np.maximum(0, slow - p @ (metric @ ((slow * n) @ p - want)))
        assert np.abs((rates * n) @ p - want).sum() <= np.abs((slow * n) @ p - want).sum() + 1e-4 * n.sum()
    assert M.fitted(table.filter("n < 0"), "n", ["a", "b", "c"], [1, 1, 1]) == []


def test_mixing_keeps_all_rows(spark, table, prose):
    docs = table(quality_rows(prose) + [(900, None), (901, ""), (None, "word"), (3, "word"), (3, "word")])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(500 + i, 0, 0) for i in range(30)] + [(None, 1, 1), (2, None, None)],
                                   "doc_id long, quality int, toxic int")
    rows, history = M.mixed(docs, M.domains_of_labels(labels), {"good": 0.5, "poor": 0.5})
    got = rows.collect()
    assert len(got) == docs.count() and set(docs.columns) <= set(rows.columns) and history
    known = {r.doc_id: r for r in got}
    assert known[70].p_good > 0.6 and known[535].p_poor > 0.6
    share = sum(r.rate * r.n_tokens * r.p_good for r in got) / sum(r.n_tokens for r in got)
    assert abs(share - 0.5) < 0.02
    assert (known[900].n_tokens, known[901].n_tokens) == (0, 0)
    copies = [r.copies for r in M.drawn(rows).collect()]
    assert abs(sum(copies) - sum(r.rate for r in got)) < 30
    assert M.mixed(table([]), M.domains_of_labels(labels), M.TARGETS)[0].count() == 0


def test_mixing_goes_its_whole_way_to_the_targets(spark):
    assert (M.TARGETS, M.BUCKETS) == ({"good": 0.93, "poor": 0.05, "toxic": 0.02}, 1 << 14)
    draw = np.random.default_rng(2)
    p, n = draw.dirichlet([3, 1, 0.3], 300), draw.integers(0, 400, 300)
    table = spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(n, p)], "n long, a double, b double, c double").coalesce(1).cache()
    goal = np.array([0.7, 0.01, 0.29])
    history = M.fitted(table, "n", ["a", "b", "c"], goal.tolist())
    rates = np.ones(300)
    for step in history:
        rates = np.maximum(0, rates - p @ np.array(step))
    # many rates reach 0 here, and 25 iterations stop at 0.163
    assert np.abs((rates * n) @ p / n.sum() - goal).sum() < 0.155


def test_samples_stay_bounded_where_ids_are_null_or_repeated(spark, table, prose, monkeypatch):
    rows = [(None if i % 3 else i % 2, prose(i, 30)) for i in range(600)]
    same = [(None, prose(1, 30))] * 600
    learnt = []
    monkeypatch.setattr(Q, "fit", lambda lists, labels, *_: learnt.append(len(lists)) or np.zeros(Q.BUCKETS + 1))
    for docs in (rows, same):
        Q.classify(table(docs), train_rows=60)
    assert (not learnt or max(learnt) <= 60) and 30 <= learnt[0]
    taken, counted = [], I.counted
    monkeypatch.setattr(I, "counted", lambda sample, *names: taken.append(sample.count()) or counted(sample, *names))
    I.train(spark.createDataFrame([(*r, "aa") for r in rows], "doc_id long, text string, lang string"), sample=60)
    assert 30 <= taken[0] <= 100


def test_mixing_learns_from_a_bounded_sample_whatever_ids_repeat(spark, table, prose, monkeypatch):
    learnt = []
    fit = lambda lists, labels, k, *_: learnt.append((len(lists), sum(map(len, lists)))) or (np.zeros((k, M.BUCKETS)), np.zeros(k))
    monkeypatch.setattr(M, "fit", fit)
    labels = spark.createDataFrame([(i, d) for i in range(3000) for d in ("good",)] + [(7, "poor")] * 3000, "doc_id long, domain string")
    hot = table([(7, prose(i, 12)) for i in range(4000)] + [(i, prose(i, 12)) for i in range(300)])
    same = table([(7, prose(1, 12))] * 4000)
    for docs in (hot, same):
        M.train(docs, labels, ["good", "poor"], train_rows=100)
    M.train(hot, labels, ["good", "poor"], train_rows=100, train_entries=150)
    assert 90 <= learnt[0][0] <= 100 and learnt[1][0] <= 2 and learnt[2][1] <= 150 and learnt[2][0] >= 5
    # the hot id doesn't stand for all: other ids are drawn, too
    rows = M.labelled_rows(table([(i, prose(i, 5)) for i in range(500)]), labels, ["good", "poor"], "text", "doc_id", 100)
    assert 95 <= rows.count() <= 102 and rows.select("id").distinct().count() >= 95


def test_smallest_draws(spark):
    from weakspot.llm.common import draw_of, smallest

    rows = spark.range(5000).select(draw_of(F.col("id")).alias("draw"), F.col("id").alias("x")).union(spark.range(900).selectExpr("5L", "-1L"))
    got = [tuple(r) for r in smallest(rows, "draw", 50).collect()]
    assert got == sorted({tuple(r) for r in rows.collect()})[:50] and got[0] == (5, -1)
    assert smallest(rows.limit(0), "draw", 50).count() == 0 and smallest(rows, "draw", 9000).count() == 5001


def test_every_language_can_be_predicted(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [f"l{k:03d}" for k in range(300)]
    speak = lambda k, seed: " ".join(letters[k % 26] + letters[k // 26] + random.Random(f"{k}{seed}{w}").choice(letters) * 2 for w in range(30))
    rows = [(4 * k + j, speak(k, j), names[k]) for k in range(300) for j in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learnt = {r.lang for r in docs.filter(~I.held_out(F.col("doc_id"))).select("lang").distinct().collect()}
    model = I.train(docs, sample=3)
    assert model.languages == sorted(learnt) and len(learnt) > 290
    got = I.identify(docs, model).collect()
    assert np.mean([r.lang_pred == r.lang for r in got if r.lang in learnt]) > 0.99
    # a text of more kinds of words than a task keeps at hand is worked off in parts
    text = " ".join(f"{a}{b}{c}" for a in letters for b in letters for c in letters)
    rows, whole = I.Rows(model), [list(model.predict([text]))]
    rows.room = 64
    assert np.allclose(list(model.predict([text], rows))[0][1], whole[0][0][1]) and list(model.predict([text], rows))[0][0] == whole[0][0][0]


def test_buckets_find_the_kinds_of_words_once(spark):
    texts = ["ABcd ABcd é!", "", None, "\U0001f600X\nY"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("found", words(F.col("text")))
    listed = rows.select("text", M.buckets_of(F.col("text"), F.col("found")).alias("buckets"))
    plan = listed._jdf.queryExecution().analyzed().toString()
    assert plan.count("array_distinct(found") == 1 and "translate(text" not in plan.split("\n")[0]
    shares = [3, 0, 0, 5]  # A-Z per code points, in tenths
    names = spark.range(10).select(M.bucket(F.concat(F.lit("\tcapitals "), F.col("id").cast("string")))).collect()
    for row, tenth in zip(sorted(listed.collect(), key=lambda r: texts.index(r["text"])), shares):
        assert names[tenth][0] in row["buckets"] and len(set(row["buckets"])) == len(row["buckets"])
