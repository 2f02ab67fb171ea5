import json
import pathlib

import pytest
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.operators.diagnose import unprocessed
from weakspot.schemas import DIAGNOSIS, REPORT, SPEC, TASK
from weakspot.sources import gate, jsonl, nested_gate, tasks
from weakspot.sources.artifacts import RunStore, check_run_id, scratch, scratch_root, written

TASK_ROW = {"task_id": 1, "content": "c", "canonical_solution": "s", "completion": "x", "test_code": "t",
            "labels": {"k": "v", "n": 3}, "accepted": False, "metrics": {"p": 0.5}, "extra": {}}
REAL_ROW = {"id": 7, "content": "Ünï", "canonical_solution": "s", "completion": "x", "labels": {"locale": "en", "d": 1},
            "pass_at_1": 1, "model": "m", "test": {"asset": {}, "code": {"b": [1, 2], "a": "x:y"}}}


def write(path, *rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")
    return str(path)


def test_scan_drops_blank_lines_and_keeps_bad_ones_aside(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", TASK_ROW, "", "  ", "{broken", "[1]", TASK_ROW)
    scanned = jsonl.scan(spark, path)
    assert jsonl.good_rows(scanned).count() == 2
    assert {(r["raw"], r["problem"]) for r in jsonl.quarantined(scanned).collect()} == {
        ("{broken", "not JSON"), ("[1]", "not an object")}
    with pytest.raises(Exception, match="bad row in"):
        jsonl.read(spark, path, TASK).collect()


def test_detection(spark, tmp_path):
    merged = write(tmp_path / "m.jsonl", "", TASK_ROW)
    real = write(tmp_path / "r.jsonl", REAL_ROW)
    inference = write(tmp_path / "i.jsonl", {k: TASK_ROW[k] for k in fixed.INFERENCE_KEYS})
    results = write(tmp_path / "o.jsonl", {k: TASK_ROW[k] for k in fixed.RESULT_KEYS})
    assert tasks.detect(spark, [merged]) == tasks.MERGED
    assert tasks.detect(spark, [real]) == tasks.REAL_LOG
    assert tasks.detect(spark, [results, inference]) == tasks.SPLIT
    for paths in ([inference], [merged, results], [inference, inference]):
        with pytest.raises(ValueError, match="Could not detect"):
            tasks.detect(spark, paths)
    with pytest.raises(ValueError, match="empty"):
        tasks.detect(spark, [write(tmp_path / "e.jsonl", "")])


def test_merged_rows(spark, tmp_path):
    row = tasks.load(spark, [write(tmp_path / "m.jsonl", TASK_ROW)]).first()
    assert row["labels"] == {"k": "v", "n": "3"} and json.loads(row["metrics"]) == {"p": 0.5}
    for bad in ({**TASK_ROW, "more": 1}, {k: v for k, v in TASK_ROW.items() if k != "extra"}):
        with pytest.raises(Exception, match="unknown or missing key"):
            tasks.load_merged(spark, write(tmp_path / "bad.jsonl", bad)).collect()


def test_real_log_rows(spark, tmp_path):
    row = tasks.load(spark, [write(tmp_path / "r.jsonl", REAL_ROW)]).first()
    assert (row["task_id"], row["content"], row["accepted"]) == (7, "Ünï", True)
    assert row["test_code"] == '{"b": [1, 2], "a": "x:y"}'
    assert row["labels"] == {"d": "1"} and json.loads(row["extra"]) == {"model": "m"}


@pytest.mark.parametrize("bad, message", [
    ("{broken", "not JSON"), ({k: v for k, v in REAL_ROW.items() if k != "id"}, "id is missing"), ({**REAL_ROW, "id": "x"}, "no whole number"),
])
def test_checks_stay_whatever_is_read(spark, tmp_path, bad, message):
    table = tasks.load_real_log(spark, write(tmp_path / "r.jsonl", REAL_ROW, bad, {**REAL_ROW, "id": "8"}))
    merged = tasks.load_merged(spark, write(tmp_path / "m.jsonl", TASK_ROW, "{broken"))
    for read in (lambda df: df.count(), lambda df: df.select("task_id", "accepted").collect(), lambda df: df.select("labels").collect(),
                 lambda df: df.filter("task_id = 7").count()):
        with pytest.raises(Exception, match=message):
            read(table)
        with pytest.raises(Exception, match="not JSON"):
            read(merged)


def test_rows_of_a_log_name_their_task(spark, tmp_path):
    rows = [{"task_id": 1, "fault_type": "surface"}, {"task_id": 2}]
    assert jsonl.read_log(spark, write(tmp_path / "good.jsonl", *rows), DIAGNOSIS).count() == 2
    for bad in ({"fault_type": "surface"}, {"task_id": True}, {"task_id": 1.5}, {"task_id": "3"}, {"task_id": None}):
        with pytest.raises(Exception, match="task_id is"):
            jsonl.read_log(spark, write(tmp_path / "bad.jsonl", *rows, bad), DIAGNOSIS).count()
    table = spark.createDataFrame([(1,), (2,)], "task_id long")
    with pytest.raises(Exception, match="Missing task_id"):
        unprocessed(table, spark.createDataFrame([(1,), (None,)], "task_id long")).collect()


def split_files(tmp_path, ids, result_ids):
    left = [{**{k: TASK_ROW[k] for k in fixed.INFERENCE_KEYS}, "task_id": i} for i in ids]
    right = [{**{k: TASK_ROW[k] for k in fixed.RESULT_KEYS}, "task_id": i, "accepted": i % 2 == 0} for i in result_ids]
    return [write(tmp_path / "res.jsonl", *right), write(tmp_path / "inf.jsonl", *left)]


def test_split_rows_in_either_order(spark, tmp_path):
    paths = split_files(tmp_path, [1, 2], [2, 1])
    for order in (paths, paths[::-1]):
        assert {r["task_id"]: r["accepted"] for r in tasks.load(spark, order).collect()} == {1: False, 2: True}


@pytest.mark.parametrize("ids, results, message", [
    ([1, 2], [1], "Missing result row for task_id 2"),
    ([1], [1, 9, 8], "Extra result row for task_id 8"),
    ([1, 2], [1, 1], "Duplicate result row for task_id 1"),
])
def test_split_issues(spark, tmp_path, ids, results, message):
    with pytest.raises(ValueError, match=message):
        tasks.load(spark, split_files(tmp_path, ids, results))


def test_filter_directory(spark, tmp_path):
    source = tmp_path / "logs"
    source.mkdir()
    write(source / "a.jsonl", *[{"pass_at_1": v} for v in (0, 0.0, False, "0", None, 1)], "")
    write(source / "b.jsonl", {"pass_at_1": 1}, {"other": 0})
    write(source / f"a{fixed.FILTERED_SUFFIX}", {"pass_at_1": 0})
    stats = jsonl.filter_directory(spark, str(source), str(tmp_path / "out"))
    found = {r["file"].rsplit("/", 1)[1]: (r["total_rows"], r["kept_rows"]) for r in stats.collect()}
    assert found == {"a.jsonl": (6, 3), "b.jsonl": (2, 0)}
    assert spark.read.text(str(tmp_path / "out")).filter("source_file = 'a'").count() == 3


def test_append_keeps_earlier_rows(spark, tmp_path):
    for n in (1, 2):
        jsonl.append(spark.createDataFrame([(n, "é")], "task_id bigint, s string"), str(tmp_path / "deep" / "log"))
    assert sorted(r["task_id"] for r in spark.read.json(str(tmp_path / "deep" / "log")).collect()) == [1, 2]


def test_schema_gate(spark):
    good = {"task_id": 1, "fault_type": "surface", "sub_tags": ["a"], "severity": "low", "description": "d",
            "evidence": {"wrong_line": "w", "correct_approach": "c", "failed_test": "t"}, "enriched_labels": {},
            "confidence": 1.0, "diagnosis_source": "rule_only", "prompt_version": "v"}
    bad = {**good, "fault_type": "x", "confidence": 1.1, "more": 1}
    rows = spark.createDataFrame([(json.dumps(r),) for r in (good, bad)], "raw string")
    gated = gate.gate(rows, DIAGNOSIS, gate.diagnosis_violations())
    assert gate.accepted(gated).count() == 1
    assert sorted(gate.rejected(gated).first()["violations"]) == ["confidence", "fault_type", "unknown more"]


@pytest.mark.parametrize("run_id", ["", ".", "..", "a/b", "/a", "a\\b"])
def test_unsafe_run_ids(run_id):
    with pytest.raises(ValueError):
        check_run_id(run_id)


def test_missing_artifact_is_empty(spark, tmp_path):
    store = RunStore(spark, str(tmp_path), "r1")
    assert store.read("specs", TASK) is None and store.read_report() is None
    assert store.read_or_empty("specs", TASK).count() == 0


def left(spark):
    folder = pathlib.Path(scratch_root(spark).removeprefix("file:")) / "weakspot"
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


def test_intermediates_go_with_their_scope(spark):
    before = left(spark)
    with scratch():
        outer = written(spark.range(3), "outer")
        with scratch():
            assert written(spark.range(2), "inner").count() == 2
        assert {n.split("-")[0] for n in left(spark) - before} == {"outer"} and outer.count() == 3
    assert left(spark) == before
    with pytest.raises(ZeroDivisionError), scratch():
        written(spark.range(1), "lost")
        1 / 0
    with pytest.raises(Exception, match="no row"), scratch():
        written(spark.range(1).select(F.raise_error(F.lit("no row")).alias("x")), "half")
    assert left(spark) == before
    free = written(spark.range(1), "free")
    assert free.count() == 1 and {n.split("-")[0] for n in left(spark) - before} == {"free"}


def test_a_run_leaves_no_intermediates_and_a_failed_stage_leaves_the_specs(spark, tmp_path):
    from weakspot.plans.run import run
    from weakspot.plans.synthesize import Settings, Synthesis

    before = left(spark)
    rows = spark.createDataFrame([tuple({**TASK_ROW, "task_id": i, "completion": "AssertionError in go_on_now", "labels": {}, "metrics": "{}", "extra": "{}"}[f]
                                        for f in TASK.fieldNames()) for i in (1, 2)], TASK)
    run(spark, rows, str(tmp_path), "r", settings=Settings(top_n=1))
    store = RunStore(spark, str(tmp_path), "r")
    made = sorted(r["spec_id"] for r in store.read("specs", SPEC).collect())
    assert made and left(spark) == before

    def broken(report, diagnoses, prior):
        bad = prior.withColumn("spec_id", F.raise_error(F.lit("no spec")).cast("string"))
        return Synthesis(bad, spark.createDataFrame([], "stage string"), prior)

    with pytest.raises(Exception, match="no spec"):
        run(spark, rows, str(tmp_path), "r", "synthesize", synthesize_stage=broken)
    assert sorted(r["spec_id"] for r in store.read("specs", SPEC).collect()) == made and left(spark) == before


SPEC_ROW = {
    "spec_id": "s1", "target_weakness": {"fault_type": fixed.FAULT_TYPES[0], "sub_tags": ["a"], "root_cause": "r", "capability_cliff": "c"},
    "problem_spec": {
        "algorithm_type": "a", "difficulty": fixed.DIFFICULTIES[0], "narrative_theme": "n", "key_trap": "k", "must_cover": [], "must_avoid": ["x"],
        "constraints": {"n_range": [1, 9], "value_range": [0, 5], "time_limit": "1s", "memory_limit": "1m"},
    },
    "verification_spec": {"min_test_cases": 3, "must_include_edge_cases": [], "brute_force_verifiable": True, "brute_force_complexity_limit": "n"},
    "diversity_tags": {"narrative_theme": "n", "data_structure": "d", "constraint_scale": "s"},
    "generation_hints": {"solution_approach": "s", "common_wrong_approach": "w", "distinguishing_test": "t"},
    "language_constraint": {"target_languages": ["python"], "language_specific": False}, "prompt_version": "v1",
}


def broken(row, path, value=None, drop=False):
    row = json.loads(json.dumps(row))
    *way, last = path
    at = row
    for step in way:
        at = at[step]
    if drop:
        del at[last]
    else:
        at[last] = value
    return row


def violations(spark, rows, schema, rules):
    texts = [(i, r if r is None or isinstance(r, str) else json.dumps(r)) for i, r in enumerate(rows)]
    got = nested_gate.gated(spark.createDataFrame(texts, "n int, raw string"), schema, rules)
    return got, [r.violations for r in got.orderBy("n").collect()]


def test_nested_gate_takes_objects_apart_once_per_level(spark):
    rows = spark.createDataFrame([('{"\\ud800": 1, "a.b": 2}',), ("{}",)], "raw string")
    checked = nested_gate.gated(rows, SPEC, nested_gate.SPEC_RULES)
    plan = checked._jdf.queryExecution().analyzed().toString()
    # written out as JSON and typed as wholes, the inner objects were read again on each level
    assert "json_object_keys" not in plan and "to_json" not in plan
    # a key that can't be written as JSON text is a key like any other
    told = [[v for v in r[nested_gate.VIOLATIONS] if v.startswith("unknown")] for r in checked.collect()]
    assert [len(t) for t in told] == [2, 0] and "unknown a.b" in told[0]


def test_nested_gate_names_every_path_of_a_spec(spark):
    limits = ("problem_spec", "constraints")
    cases = [
        (SPEC_ROW, []), (None, ["type $"]), ("{broken", ["type $"]), ("[1]", ["type $"]), ("", ["type $"]),
        (broken(SPEC_ROW, (*limits, "n_range"), [1]), ["value problem_spec.constraints.n_range"]),
        (broken(SPEC_ROW, (*limits, "n_range"), [1, "2"]), ["type problem_spec.constraints.n_range[1]"]),
        (broken(SPEC_ROW, (*limits, "n_range"), "1-2"), ["type problem_spec.constraints.n_range"]),
        (broken(SPEC_ROW, (*limits, "more"), 1), ["unknown problem_spec.constraints.more"]),
        (broken(SPEC_ROW, limits, drop=True), ["missing problem_spec.constraints"]),
        (broken(SPEC_ROW, limits, None), ["type problem_spec.constraints"]),
        (broken(SPEC_ROW, ("verification_spec", "min_test_cases"), 0), ["value verification_spec.min_test_cases"]),
        (broken(SPEC_ROW, ("verification_spec", "min_test_cases"), 2**40), ["type verification_spec.min_test_cases"]),
        (broken(SPEC_ROW, ("verification_spec", "brute_force_verifiable"), "yes"), ["type verification_spec.brute_force_verifiable"]),
        (broken(SPEC_ROW, ("target_weakness", "fault_type"), "style"), ["value target_weakness.fault_type"]),
        (broken(SPEC_ROW, ("language_constraint", "target_languages"), ["a", None]), ["type language_constraint.target_languages[1]"]),
        (broken(broken(SPEC_ROW, ("spec_id",), drop=True), ("diversity_tags", "data_structure"), 1),
         ["missing spec_id", "type diversity_tags.data_structure"]),
    ]
    checked, told = violations(spark, [row for row, _ in cases], SPEC, nested_gate.SPEC_RULES)
    for (_, expected), found in zip(cases, told):
        assert found == expected
    assert [r.spec_id for r in nested_gate.typed(checked, SPEC).collect()] == ["s1"]


def test_nested_gate_of_lists_of_rows_and_of_maps(spark):
    weakness = {
        "rank": 1, "fault_type": fixed.FAULT_TYPES[0], "sub_tags": ["a"], "frequency": 2, "sample_task_ids": [1], "trainability": 0.5,
        "collective_diagnosis": {"refined_root_cause": "r", "capability_cliff": "c", "misdiagnosed_ids": [], "misdiagnosis_corrections": {"1": "x"},
                                 "cluster_coherence": 1},
    }
    report = {"weaknesses": [weakness, weakness], "rankings": {"by_frequency": [1], "by_difficulty": [1], "by_trainability": [1]},
              "causal_chains": [{"root": "r", "downstream": [], "training_priority": "p"}], "tag_mappings": {"a": "b"}}
    deep = ("weaknesses", 1, "collective_diagnosis")
    _, told = violations(spark, [
        report, broken(report, (*deep, "cluster_coherence"), 1.5), broken(report, (*deep, "misdiagnosis_corrections"), {"7": 3}),
        broken(report, ("tag_mappings",), {"a": None}), broken(report, ("causal_chains", 0, "root"), drop=True),
        broken(report, ("weaknesses", 0, "extra"), 1), broken(report, ("tag_mappings",), []),
    ], REPORT, nested_gate.REPORT_RULES)
    inner = "weaknesses[1].collective_diagnosis"
    assert told == [
        [], [f"value {inner}.cluster_coherence"], [f"type {inner}.misdiagnosis_corrections.7"], ["type tag_mappings.a"],
        ["missing causal_chains[0].root"], ["unknown weaknesses[0].extra"], ["type tag_mappings"],
    ]
