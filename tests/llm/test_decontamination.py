import hashlib
import re

from pyspark.sql import functions as F

from weakspot.llm import decontamination as D


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, length=13):
    windows = []
    for item, text in items:
        w = words(text)
        size = min(length, len(w))
        windows += [(item, tuple(w[i: i + size])) for i in range(len(w) - size + 1)] if w else []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i: i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found.add(str(item))
        yield doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def test_matches_brute_force_with_odd_rows(spark, table, prose):
    first, second = prose(1, 30), prose(2, 20)
    items = [(1, first), (2, second), (3, "Über kurz, oder LANG"), (4, None), (5, "..."), (10, first), (7, "solo")]
    docs = [
        (1, prose(3, 40) + " " + " ".join(first.split()[4:22]).upper() + ". " + prose(4, 10)),
        (2, second + " " + second), (3, "sie sagte: über  kurz - oder lang!"), (3, "sie sagte: über  kurz - oder lang!"),
        (4, None), (None, ""), (None, "solo"), (6, prose(5, 500) + " solo " + prose(6, 20)), (7, " ".join(first.split()[:12])),
        (8, prose(9, 4000) + " " + first),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(
        (str(r.doc_id), r.n_words, r.n_hit, list(r["items"]), r.bad)
        for r in D.hits(table(docs), benchmark).withColumn("bad", D.contaminated(0.05))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).collect()
    )
    assert got == sorted((str(d), n, h, i, b) for d, n, h, i, b in brute(docs, items))


def test_removal_keeps_other_rows_and_columns(spark, table, prose):
    item = prose(1, 15)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = table([(1, f"«Start» {item.title()}, end."), (2, "clean text"), (None, None), (None, item)])
    kept = D.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("2", "clean text"), ("None", "None")]
    cut = {str(r.doc_id): r.text for r in D.decontaminated(docs.filter("doc_id is not null"), benchmark, remove="spans").collect()}
    assert cut == {"1": "«Start» end.", "2": "clean text"}


def test_empty_tables(spark, table):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in D.hits(table([(1, "a b")]), nothing).collect()] == [0]
    assert D.hits(table([]), nothing).count() == 0


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_any_number_of_windows_gives_the_same(spark, table, prose, monkeypatch):
    first, second = prose(1, 30), prose(2, 20)
    items = spark.createDataFrame([(1, first), (2, second), (3, "Über kurz, oder LANG"), (4, None), (10, first), (7, "solo")], "item_id long, text string")
    docs = table(
        [(i, f"{prose(i + 40, 30)} {first.upper()}") for i in range(30)] + [(i, prose(i + 90, 200)) for i in range(40, 50)]
        + [(50, None), (None, ""), (None, "solo"), (51, "sie sagte: über  kurz - oder lang!"), (51, "sie sagte: über  kurz - oder lang!"), (52, second + " " + second)]
    )
    sent = sorted(map(str, D.hits(docs, items).collect()))
    for name in ("MOST_WINDOWS", "MOST_BYTES"):
        with monkeypatch.context() as patch:
            patch.setattr(D, name, 0)
            found = D.hits(docs, items)
            assert sorted(map(str, found.collect())) == sent
            cut = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), D.words(F.col("text")).alias("words"))
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
            try:
                plan = D.shuffled(cut, D.item_windows(items), [13, 4, 1])._jdf.queryExecution().executedPlan().toString()
            finally:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            # what goes to meet the windows by hash carries no words; no row has a made-up key
            lines = plan.splitlines()
            dealt = [k for k, line in enumerate(lines) if "Exchange hashpartitioning(hash" in line]
            below = next(line for line in lines[dealt[0] + 1 :] if "Project" in line)
            assert dealt and "words" not in below.split("[", 1)[1] and "Union" in plan
    nothing = spark.createDataFrame([], "item_id long, text string")
    monkeypatch.setattr(D, "MOST_BYTES", -1)
    assert {(r.n_hit, tuple(r["items"])) for r in D.hits(docs, nothing).collect()} == {(0, ())}
