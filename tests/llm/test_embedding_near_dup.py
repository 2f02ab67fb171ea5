import math

import numpy as np

from weakspot.llm import embedding_near_dup as E


def test_matches_brute_force(spark):
    draw = np.random.default_rng(1)
    base = draw.standard_normal((60, 16))
    rows = [v for v in base] + [base[i % 12] + draw.standard_normal(16) * 0.08 for i in range(80)]
    rows += [base[0] * 3, base[1], base[1]] + [base[5] + draw.standard_normal(16) * 0.01 for _ in range(300)]
    table = [(1000 - i, [float(x) for x in np.float32(v)], 7) for i, v in enumerate(rows)]
    table += [(5000, None, 1), (5001, [], 1), (5002, [0.0] * 16, 1), (5003, [math.nan] * 16, 1), (5004, [math.inf] + [1.0] * 15, 1),
              (5005, [None] + [1.0] * 15, 1), (None, table[1][1], 1), (5006, [1.0] * 8, 1)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, n_links int")
    got = {(r.vec_id, str(r.embedding)): r for r in E.near_duplicates(df).collect()}
    good = [(i, np.array(v, dtype=float)) for i, v, _ in table if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    whole = np.stack([v / np.linalg.norm(v) for _, v in good])
    linked = whole @ whole.T >= 0.95
    np.fill_diagonal(linked, False)
    group = np.arange(len(good))
    for _ in good:
        group = np.array([min([group[k], *group[linked[k]]]) for k in range(len(good))])
    for k, (i, v) in enumerate(good):
        row = got[i, str([float(x) for x in np.float32(v)])]
        ids = [good[j][0] for j in range(len(good)) if group[j] == group[k] and good[j][0] is not None]
        assert (row.n_links, row.component_id) == (linked[k].sum(), min(ids)), i
    for i in range(5000, 5007):
        row = next(r for (vec, _), r in got.items() if vec == i)
        assert (row.n_links, row.component_id, row.kept) == (0, i, True)


def test_empty_table(spark):
    assert E.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_passes_grow_with_the_corpus():
    assert E.passes_needed(10_000, 64, 0.95, 0.999) < E.passes_needed(10_000_000, 64, 0.95, 0.999) < 200


def found_pairs(spark, rows, **how):
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in E.near_duplicates(df.repartition(5), **how).collect()}
    assert sorted(got) == list(range(len(rows)))
    return got


def brute_links(rows):
    whole = np.stack([v / np.linalg.norm(v) for v in rows])
    linked = whole @ whole.T >= 0.95
    np.fill_diagonal(linked, False)
    return linked


def test_isolated_pairs_in_a_dense_cloud(spark):
    # all at a cosine of about 0.9 to each other, a twentieth with a partner at about 0.96
    draw = np.random.default_rng(5)
    middle = draw.standard_normal(64) * 3
    rows = [middle + draw.standard_normal(64) for _ in range(3000)]
    rows += [rows[i] + draw.standard_normal(64) * 0.6 for i in range(150)]
    linked = brute_links(rows)
    assert linked.any(axis=1).sum() >= 250
    got = found_pairs(spark, rows)
    missed = [i for i in range(len(rows)) if got[i].n_links != linked[i].sum()]
    assert len(missed) <= 2  # 0.999 for a pair right at the threshold, more above it


def test_large_group_beside_outsiders_in_its_cells(spark):
    # a group that fills several blocks on its own, and pairs near it that the windows may not meet
    draw = np.random.default_rng(6)
    middle = draw.standard_normal(64) * 3
    rows = [middle + draw.standard_normal(64) * 0.3 for _ in range(900)] + [middle + draw.standard_normal(64) * 0.95 for _ in range(400)]
    linked = brute_links(rows)
    got = found_pairs(spark, rows)
    assert [got[i].n_links for i in range(len(rows))] == [int(n) for n in linked.sum(axis=1)]


def test_small_cells_are_met_whole_wherever_ranges_end(spark):
    # one pass, few planes: every pair of a cell has to be met, whatever the number of tasks
    draw = np.random.default_rng(7)
    rows = [v for v in draw.standard_normal((400, 8))]
    rows += [v + draw.standard_normal(8) * 0.05 for v in rows]
    linked = brute_links(rows)
    got = found_pairs(spark, rows, window=16)
    assert sum(got[i].n_links != linked[i].sum() for i in range(len(rows))) <= 1


def test_columns_called_like_results_stand_aside(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 9, "x"), (2, [1.0, 0.0], 8, "y")], "vec_id long, embedding array<double>, n_links int, kept string")
    got = {r.vec_id: r for r in E.near_duplicates(df).collect()}
    assert (got[1].n_links, got[1]._n_links, got[1].kept, got[2].kept, got[2]._kept) == (1, 9, True, False, "y")
