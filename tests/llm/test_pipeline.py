import sys
from pathlib import Path

import pytest
import test_decontamination
import test_jaccard_join
import test_line_dedup
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402


@pytest.fixture(scope="module")
def tables(spark, prose, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    item = prose(7000, 30)
    docs = [(i, f"{prose(i, 60)}\n{prose(i + 500, 40)}", "en", "web", 1) for i in range(40)]
    docs += [(100 + i, docs[i][1], "en", "web", 1) for i in range(3)]  # exact copies
    docs += [(110 + i, docs[5][1].replace("\n", f" changed{i}\n"), "en", "web", 1) for i in range(3)]  # near copies
    docs += [(120, f"{prose(120, 90)} {item}", "en", "web", 1), (121, f"{prose(121, 50)}\n{item.upper()}", "en", "books", 1)]
    docs += [(130 + i, f"{prose(130 + i, 50)}\nSubscribe to letter {i} now", "en", "web", 1) for i in range(6)]
    docs += [(140 + i, " ".join(["schung", "ung", "verei", "eiver"][(i + k * k) % 4] + "ei" * (k % 3) for k in range(50 + i)), "de", "web", 1) for i in range(20)]
    docs += [(200, None, "en", "web", 0), (201, "12 34", "en", None, 5), (202, "", None, "web", 0), (None, prose(9999, 30), None, None, None)]
    frames = {
        "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "benchmark": ([(1, item), (2, None)], "item_id long, text string"),
        "labels": ([(i, int(i % 4 > 0), int(i % 9 == 0)) for i in range(40)] + [(None, 1, 0)], "doc_id long, quality int, toxic int"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder), docs, item


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_each_stage_does_its_part_on_its_own_input(spark, tables, tmp_path):
    folder, docs, item = tables
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing to target weights"]
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = now.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        before, now = now, spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert now.columns == columns
        seen.append((pairs(before), pairs(now)))
    took, gave = seen[0]
    assert gave == [(d, t) for d, t in took if t and any(map(str.isalpha, t))]
    took, gave = seen[1]
    cut = dict(test_line_dedup.brute(took, 4, 3, 0.8))
    assert gave == sorted([(d, cut[d]) for d, t in took if cut[d].strip() or not t.strip()], key=str)
    took, gave = seen[2]
    groups = {}
    for (d, t), (_, n, c) in zip(took, test_jaccard_join.brute(took)):
        groups.setdefault(("linked", c) if n else ("alone", d), []).append(d)
    assert sorted(d for d, _ in gave if d is not None) == sorted(min(g) for g in groups.values() if None not in g)
    took, gave = seen[3]
    bad = {d for d, *_, contaminated in test_decontamination.brute(took, [(1, item)]) if contaminated}
    assert bad and gave == [(d, t) for d, t in took if d not in bad]
    took, gave = seen[4]
    assert gave == took and now.filter("rate < 0 OR rate IS NULL OR copies < 0 OR (rate = 0 AND copies > 0)").count() == 0
    weighed = now.agg(*[F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) for d in ("good", "poor", "toxic")]).first()
    assert weighed[0] == max(weighed)


def test_run_is_the_stages_in_turn(spark, tables):
    rows = corpus_pipeline.run(spark, tables[0]).collect()
    kept = {r.doc_id for r in rows}
    assert kept.isdisjoint({100, 101, 102, 120, 121, 200, 201, 202}) and len(kept & set(range(40))) >= 38
