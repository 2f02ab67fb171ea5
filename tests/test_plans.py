import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from weakspot.operators import collective as co
from weakspot.operators import diversity as dv
from weakspot.functions.language import primary_language
from weakspot.operators import merges as mg
from weakspot.operators.diagnose import analyzer_payload
from weakspot.operators.repair import batch_rediagnoser, ladder, repaired
from weakspot.operators.summary import cost_estimate
from weakspot.plans.aggregate import aggregate
from weakspot.plans.diagnose import diagnose
from weakspot.plans.run import Hooks, plan_stages, run, same_model
from weakspot.plans.synthesize import Settings, synthesize
from weakspot.schemas import DIAGNOSIS, EVENT_LOG, SPEC, TASK
from weakspot.sources.artifacts import RunStore


def tasks(spark, rows):
    base = {"content": "", "canonical_solution": "", "completion": "", "test_code": "", "labels": {}, "accepted": False,
            "metrics": "{}", "extra": "{}"}
    return spark.createDataFrame([tuple({**base, **r}[f] for f in TASK.fieldNames()) for r in rows], TASK)


def diagnoses(spark, rows):
    base = {"fault_type": "implementation", "sub_tags": ["logic_error"], "severity": "low", "description": "d",
            "evidence": ("def solve_all(x): return x", "Use `solve_all` with the sum", "assert solve_all(1) == 2"),
            "enriched_labels": {}, "confidence": 0.9, "diagnosis_source": "model_deep", "prompt_version": "v"}
    return spark.createDataFrame([tuple({**base, **r}[f] for f in DIAGNOSIS.fieldNames()) for r in rows], DIAGNOSIS)


TASKS = [
    {"task_id": 1, "completion": "SyntaxError: invalid syntax"},
    {"task_id": 2, "completion": "wrong format"},
    {"task_id": 3, "completion": "AssertionError"},
    {"task_id": 4, "completion": "fine"},
]


def test_default_diagnosis_and_resume(spark):
    table = tasks(spark, TASKS)
    got = {r["task_id"]: (r["fault_type"], r["sub_tags"], r["diagnosis_source"]) for r in diagnose(table).collect()}
    assert got == {
        1: ("implementation", ["syntax_error"], "rule_confirmed_by_model"),
        2: ("surface", ["output_format_mismatch"], "rule_only"),
        3: ("implementation", ["deep_analysis"], "model_deep"),
        4: ("implementation", ["deep_analysis"], "model_deep"),
    }
    old = diagnoses(spark, [{"task_id": 4, "sub_tags": ["Pass"]}, {"task_id": 99}])
    again = diagnose(table, existing=old).collect()
    assert sorted(r["task_id"] for r in again) == [1, 2, 3, 4, 99]
    assert [r["diagnosis_source"] for r in again if r["task_id"] == 4] == ["non_failure"]


def test_analyzers_see_their_tasks_only(spark):
    def analyzer(tag):
        def run(batches):
            for pdf in batches:
                yield pd.DataFrame([{
                    "task_id": r.task_id, "fault_type": "surface", "sub_tags": [tag], "severity": "low", "description": r.completion,
                    "evidence": {"wrong_line": "w", "correct_approach": "c", "failed_test": "t"}, "enriched_labels": {"k": "v"},
                    "confidence": 0.5, "diagnosis_source": "model_deep", "prompt_version": "x"} for r in pdf.itertuples()],
                    columns=DIAGNOSIS.fieldNames())
        return run

    rows = tasks(spark, [*TASKS, {"task_id": 5, "completion": "```py\nx\n```"}])
    got = {r["task_id"]: r["sub_tags"][0] for r in diagnose(rows, deep=analyzer("Logic Error"), confirm=analyzer("missing-colon")).collect()}
    assert got == {1: "syntax_error", 2: "output_format_mismatch", 3: "logic_error", 4: "logic_error", 5: "markdown_formatting"}


def test_payload_names_language_and_cuts(spark):
    rows = tasks(spark, [{"task_id": 1, "content": "a b", "canonical_solution": "s " * 200, "labels": {"programming_language": "go"}}])
    payload = json.loads(analyzer_payload(rows, 100).first()["payload"])
    assert payload["programming_language"] == "go" and payload["canonical_solution"] == ""
    assert payload["truncation_info"] == {
        "completion_truncated": False, "canonical_solution_truncated": True, "test_code_truncated": False}


def test_ladder_levels(spark):
    assert ladder("auto", True)[0] == "exec_api" and ladder("auto") == ["cross_model", "self_check"]
    assert ladder("self_check") == ["self_check"]
    rows = diagnoses(spark, [{"task_id": 1, "confidence": 0.9}])
    row = repaired(rows, "exec_api", verifiers={"exec_api": F.lit("failed")}).first()
    assert row["confidence"] == 0.5 and row["enriched_labels"] == {
        "verification_level": "exec_api", "verification_status": "unverified"}
    with pytest.raises(Exception, match="No verification path"):
        repaired(rows, verifiers={"self_check": F.lit(None).cast("string")}).collect()


def test_rediagnosed_rows_may_pass(spark):
    rows = diagnoses(spark, [{"task_id": 1}, {"task_id": 2}])
    verdict = F.when((F.col("task_id") == 1) & (F.col("description") == "d"), "failed").otherwise("passed")
    fixed = repaired(rows, verifiers={"self_check": verdict}, rediagnose=lambda df: df.withColumn("description", F.lit("e")))
    assert {(r["task_id"], r["description"], r["enriched_labels"]["verification_status"]) for r in fixed.collect()} == {
        (1, "e", "passed"), (2, "d", "passed")}


def test_collective_answers_merge_tags(spark):
    rows = diagnoses(spark, [
        {"task_id": 1, "fault_type": "modeling", "sub_tags": ["off_by_one"]},
        {"task_id": 2, "fault_type": "modeling", "sub_tags": ["loop"]},
        {"task_id": 3, "fault_type": "modeling", "sub_tags": ["missing_colon"]},
        {"task_id": 4, "fault_type": "surface", "sub_tags": []},
    ])

    def analyze(batches):
        for pdf in batches:
            out = []
            for key, payload in zip(pdf["cluster_key"], pdf["payload"]):
                tag = json.loads(payload)["sub_tags"][0]
                merges = [{"source_tag": "loop", "target_tag": "missing_colon", "confirmed": True}] if tag == "off_by_one" else []
                answer = {"refined_root_cause": f"why {tag}", "capability_cliff": "c", "misdiagnosed_ids": ["3"],
                          "cluster_coherence": 0.5, "semantic_merges": merges}
                out.append((key, "not json" if tag == "off_by_one" and '"siblings":[]' in payload else json.dumps(answer)))
            yield pd.DataFrame(out, columns=["cluster_key", "answer"])

    events = []
    found = aggregate(rows, collective=analyze, on_events=lambda e: events.extend(co.failure_events(e).collect()))
    got = {(r["fault_type"], r["sub_tags"][0]): (r["rank"], r["frequency"], r["collective_diagnosis"]["refined_root_cause"])
           for r in found.weaknesses.collect()}
    assert got[("modeling", "syntax_error")] == (2, 2, "why missing_colon")
    assert got[("modeling", "logic_error")][:2] == (1, 1)
    assert got[("surface", "unknown")][:2] == (3, 1)
    assert {r["source"]: r["target"] for r in found.tag_map.collect()} == {
        "off_by_one": "logic_error", "loop": "syntax_error", "missing_colon": "syntax_error", "unknown": "logic_error"}
    assert events == []


def test_bad_answers_fall_back_to_the_default(spark):
    def analyze(batches):
        for pdf in batches:
            yield pd.DataFrame({"cluster_key": pdf["cluster_key"], "answer": "nothing"})

    seen = []
    found = aggregate(diagnoses(spark, [{"task_id": 1}]), collective=analyze, on_events=lambda e: seen.extend(co.failure_events(e).collect()))
    cause = found.weaknesses.first()["collective_diagnosis"]["refined_root_cause"]
    assert cause.startswith("Grouped by implementation/logic_error (verification_status=passed")
    assert [(r["error_type"], r["attempts"]) for r in seen] == [("collective_parse_failure", 2)]


def test_every_syntax_pattern_is_reached_through_its_hint(spark):
    """A text for each pattern of each family, and prose that holds the hints only."""
    texts = [
        ("python", "def f(x)"), ("python", "a\n import os, re "), ("r", "f <- function (x)"), ("r", "function(x) x"),
        ("java", "public static int f("), ("java", "System.out.println ("), ("typescript", "function f(a: number"),
        ("typescript", "let x: number ="), ("typescript", "interface Shape"), ("javascript", "import a from 'b';"),
        ("javascript", 'import a from "b"'), ("javascript", "function f ("), ("javascript", "console.log ("), ("javascript", "const x = ("), ("cpp", " #include <map>"),
        ("cpp", "std::map"), ("go", "func f("), ("go", "package main"), ("rust", "fn f("), ("rust", "let mut x"),
        ("unknown", "imports let the package functions (so): mutual = constant"), ("unknown", ""), ("unknown", "pythons ergo"),
        ("go", "written in Go"), ("cpp", "some C++x"), ("cpp", "cpp"), ("rust", "Ru\u017ft"), ("python", "java or Python"),
    ]
    rows = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["l"] for r in rows.select("i", primary_language(F.col("t")).alias("l")).collect()}
    assert [(got[i], t) for i, (_, t) in enumerate(texts)] == texts


def test_closure_takes_as_many_rounds_as_its_longest_chain_needs(spark, monkeypatch):
    """A chain of 40 links, 300 short ones, a cycle of 3 with a tail of 17, against following the edges."""
    edges = {f"a{i}": f"a{i + 1}" for i in range(40)} | {f"s{i}": f"e{i}" for i in range(300)}
    edges |= {"c0": "c1", "c1": "c2", "c2": "c0"} | {f"t{i}": f"t{i + 1}" for i in range(16)} | {"t16": "c1"}
    rows = spark.createDataFrame(list(edges.items()), "source string, target string")
    written, tables = mg.written, []
    monkeypatch.setattr(mg, "written", lambda df, label: tables.append(label) or written(df, label))

    def end(tag):
        path = [tag]
        while path[-1] in edges:
            following = edges[path[-1]]
            if following in path:
                return following  # where the path enters the cycle; itself for a tag on it
            path.append(following)
        return path[-1]

    assert {r["source"]: r["target"] for r in mg.closure(rows).collect()} == {t: end(t) for t in edges}
    assert tables.count("repeat") == 7  # 4, 16, 64 steps and one more to see it, then 64 again
    tables.clear()
    short = rows.filter("source LIKE 's%'")
    assert mg.closure(short).count() == 300 and tables.count("repeat") == 1


def test_closure_of_chains_cycles_and_tails(spark):
    edges = {"a": "b", "b": "c", "c": "c", "x": "y", "y": "z", "z": "x", "t": "x", "s": "t", "q": "w"}
    chain = {f"n{i}": f"n{i + 1}" for i in range(40)}
    rows = spark.createDataFrame(list({**edges, **chain}.items()), "source string, target string")
    got = {r["source"]: r["target"] for r in mg.closure(rows).collect()}
    assert {k: got[k] for k in edges} == {
        "a": "c", "b": "c", "c": "c", "x": "x", "y": "y", "z": "z", "t": "x", "s": "x", "q": "w"}
    assert {got[k] for k in chain} == {"n40"}


def test_causal_hook(spark):
    hook = co.causal_hook(lambda pdf: pd.DataFrame({"root": [pdf["tag"].iloc[0]], "downstream": [[]], "training_priority": ["p"]}))
    found = aggregate(diagnoses(spark, [{"task_id": 1}]), causal=hook)
    assert found.chains.first()["root"] == "logic_error"


def test_estimate(spark):
    rows = tasks(spark, [
        {"task_id": 1, "content": "a b c d", "canonical_solution": "ok", "completion": "x y", "test_code": "assert True"},
        {"task_id": 2, "content": "alpha beta", "canonical_solution": "ok", "completion": "theta", "test_code": "assert True"},
        {"task_id": 3, "content": "one two three", "canonical_solution": "ok", "completion": "four five six", "test_code": "assert True"}])
    row = cost_estimate(rows).first()
    assert (row["estimated_model_calls"], row["estimated_input_tokens"], row["estimated_output_tokens"], row["estimated_seconds"]) == (7, 52, 184, 4)
    none = cost_estimate(rows.limit(0)).first()
    assert (none["estimated_model_calls"], none["estimated_seconds"]) == (0, 0)


@pytest.mark.parametrize("args, want", [
    (("diagnose", 3, None, None, None), (True, True, True)),
    (("diagnose", 3, 3, 2, 4), (False, False, False)),
    (("diagnose", 3, 2, 2, 4), (True, True, True)),
    (("diagnose", 3, 3, 0, 4), (False, True, True)),
    (("diagnose", 3, 3, 2, 0), (False, False, True)),
    (("aggregate", 3, 1, 2, 4), (False, True, True)),
    (("synthesize", 3, 3, 2, 4), (False, False, True)),
])
def test_stage_planning(args, want):
    assert tuple(plan_stages(*args)) == want


def test_same_model_warning():
    assert same_model("m", "m") and not same_model("m", "n") and not same_model("", "")


FAILING = [
    {"task_id": 1}, {"task_id": 2, "sub_tags": ["markdown_formatting"], "fault_type": "surface"},
    {"task_id": 3, "sub_tags": ["pass"], "diagnosis_source": "non_failure"},
]


def test_default_specs_are_accepted(spark):
    rows = diagnoses(spark, FAILING)
    made = synthesize(aggregate(rows), rows)
    specs = made.specs.orderBy("spec_id").collect()
    assert [s["spec_id"] for s in specs] == [f"spec-{n:04d}" for n in range(1, 9)]
    assert specs[0]["problem_spec"]["must_cover"] == ["Require the exact output semantics specified by the task."]
    assert made.events.count() == 0
    tags = [(s["target_weakness"]["root_cause"], *s["diversity_tags"]) for s in specs]
    assert all(sum(x == y for x, y in zip(a[1:], b[1:])) <= 1 for i, a in enumerate(tags) for b in tags[:i] if a[0] == b[0])


def test_generator_is_retried_and_backed_up(spark):
    def generate(batches):
        for pdf in batches:
            out = []
            for key, payload in zip(pdf["slot_key"], pdf["payload"]):
                ask = json.loads(payload)
                good = ask["repair_context"]["mode"] != "initial_generation"
                out.append((key, json.dumps({
                    "algorithm_type": "a", "difficulty": "hard", "narrative_theme": "n", "constraints": "1 to 5", "key_trap": "uses solve_all",
                    "must_cover": "one; two", "must_avoid": ["x"], "verification_spec": "yes", "generation_hints": f"retry {good}",
                    "language_constraint": "python"}) if not key.endswith("#2") else "garbage"))
            yield pd.DataFrame(out, columns=["slot_key", "answer"])

    def check(batches):
        for pdf in batches:
            retried = ["retry True" in s for s in pdf["spec"]]
            yield pd.DataFrame({"slot_key": pdf["slot_key"], "accepted": retried, "reason": ["needs prose"] * len(pdf),
                                "missing_contracts": [[]] * len(pdf)})

    rows = diagnoses(spark, FAILING)
    made = synthesize(aggregate(rows), rows, generate=generate, check=check)
    specs = made.specs.collect()
    assert {s["generation_hints"]["solution_approach"] for s in specs} == {"retry True"}
    events = {(e["weakness"], e["event_type"], e["error_type"]) for e in made.events.collect()}
    # unusable answers go to the fallback, which the external check turns down here
    assert events == {("logic_error", None, "spec_generation_failed"), ("markdown_formatting", None, "spec_generation_failed")}


def test_plan_walks_around_earlier_specs(spark):
    rows = spark.createDataFrame([("k", 3)], "key string, n_slots int")
    old = spark.createDataFrame([("k", "k", "array", "small", 1, "s1"), ("other", "k", "tree", "medium", 2, "s2")],
                                "key string, narrative_theme string, data_structure string, constraint_scale string, seq bigint, spec_id string")
    got = [tuple(r["diversity_tags"]) for r in dv.plan(rows, old).orderBy("slot").collect()]
    assert got == [("k", "tree", "medium"), ("k", "graph", "large"), ("k_2", "array", "medium")]
    short = dv.plan(rows, old, ["k"], adaptive=False, structures=["array"])
    assert dv.unfilled(rows, short).first()["planned"] < 3


def test_run_end_to_end_and_resume(spark, tmp_path):
    named = [{**t, "completion": t["completion"] + " in go_on_now"} for t in TASKS]
    table = tasks(spark, [*named, {"task_id": 6, "completion": "def go_on(x): return x", "test_code": "assert go_on(1)"}])
    first = run(spark, table.filter("task_id < 4"), str(tmp_path), "r1", settings=Settings(top_n=2)).first()
    assert first["stages_executed"] == ["diagnose", "aggregate", "synthesize"] and first["input_count"] == 3
    summary = first["summary"]
    assert (summary["diagnosed"], summary["rule_screened"], summary["model_analyzed"], summary["skipped"]) == (3, 2, 1, 0)
    assert summary["specs_generated"] == sum(summary["specs_by_weakness"].values()) > 0
    same = run(spark, table.filter("task_id < 4"), str(tmp_path), "r1", settings=Settings(top_n=2)).first()
    assert same["stages_executed"] == []
    more = run(spark, table, str(tmp_path), "r1", settings=Settings(top_n=2)).first()
    assert more["stages_executed"] == ["diagnose", "aggregate", "synthesize"] and more["summary"]["diagnosed"] == 5
    store = RunStore(spark, str(tmp_path), "r1")
    ids = [r["task_id"] for r in store.read("diagnoses", DIAGNOSIS).collect()]
    assert sorted(ids) == [1, 2, 3, 4, 6]
    assert store.read("specs", SPEC).count() == more["summary"]["specs_generated"]
    assert store.read_or_empty("events", EVENT_LOG).filter("stage <> 'synthesize'").count() == 0
    with pytest.raises(ValueError, match="Duplicate task_id"):
        run(spark, table.union(table), str(tmp_path), "r2")


def test_each_task_keeps_one_diagnosis_whatever_an_analyzer_answers(spark):
    def odd_analyzer(batches):
        """Leaves one task out, answers one twice with a foreign value, one outside the taxonomy, and one nobody asked for."""
        for pdf in batches:
            out = []
            for task in [*pdf["task_id"], 77]:
                row = {"task_id": task, "fault_type": "surface", "sub_tags": ["logic_error"], "severity": "low", "description": "d",
                       "evidence": {"wrong_line": "w", "correct_approach": "c", "failed_test": "t"}, "enriched_labels": {"k": "v"},
                       "confidence": 0.5, "diagnosis_source": "model_deep", "prompt_version": "x"}
                if task == 2:
                    continue
                out.append(row)
                if task == 3:
                    out.append({**row, "fault_type": "foreign", "confidence": 9.0})
                if task == 4:
                    row["sub_tags"] = ["no such tag"]
                if task == 5:
                    row["severity"] = "awful"
            yield pd.DataFrame(out, columns=DIAGNOSIS.fieldNames())

    events = []
    found = diagnose(
        tasks(spark, [{"task_id": i, "completion": "fine"} for i in range(1, 6)]), deep=odd_analyzer,
        on_events=lambda e: events.extend(e.collect()),
    ).collect()
    assert {r["task_id"]: r["sub_tags"][0] for r in found} == {1: "logic_error", **dict.fromkeys([2, 3, 4, 5], "deep_analysis")}
    assert len(found) == 5
    told = {r["task_id"]: r["message"] for r in events}
    assert told[2] == "not answered" and told[3] == "answered in several ways" and told[5].startswith("invalid: severity")
    assert sorted(told) == [2, 3, 4, 5]


def test_analyzers_see_every_diagnosis_of_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(co, "CHUNK_ROWS", 10)
    rows = diagnoses(spark, [{"task_id": i} for i in range(60)] + [{"task_id": 100, "sub_tags": ["off_by_one"]}])

    def analyze(batches):
        for pdf in batches:
            out = []
            for key, payload in zip(pdf["cluster_key"], pdf["payload"]):
                told = json.loads(payload)
                if told["sub_tags"] == ["off_by_one"]:
                    continue  # never answered
                ids = [d["task_id"] for d in told["diagnoses"]]
                out.append((key, json.dumps({"refined_root_cause": "why", "capability_cliff": "c", "misdiagnosed_ids": ids,
                                             "cluster_coherence": 0.5, "semantic_merges": []})))
            yield pd.DataFrame(out, columns=["cluster_key", "answer"])

    groups = spark.createDataFrame(
        [("implementation", "logic_error", 60, [0], 0), ("implementation", "off_by_one", 1, [100], 100)],
        "fault_type string, tag string, frequency long, sample_task_ids array<long>, min_task_id long",
    ).withColumns({"statuses": F.array(F.lit("passed")), "levels": F.array(F.lit("self_check"))})
    found = co.analyzed(groups, rows, None, analyze)
    got = {r["tag"]: r for r in found.clusters.collect()}
    assert sorted((r["tag"], r["task_id"]) for r in found.details.collect()) == [("logic_error", i) for i in range(60)]
    assert got["logic_error"]["rows_seen"] == 60 and got["logic_error"]["problem"] is None
    assert got["off_by_one"]["problem"] == "not answered" and got["off_by_one"]["narrative"]["refined_root_cause"]


def test_answers_of_many_chunks_merge_by_partial_aggregates(spark):
    n = 10_000
    answered = spark.range(n).select(
        F.lit("modeling").alias("fault_type"), F.lit("loop").alias("tag"), F.col("id").cast("int").alias("chunk"), F.lit(2).cast("bigint").alias("rows_seen"),
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("bad "), F.col("id").cast("string"))).alias("problem"),
        F.when(F.col("id") % 5 != 0, F.struct(
            F.concat(F.lit("why "), F.col("id").cast("string")).alias("refined_root_cause"), F.lit("c").alias("capability_cliff"),
            F.array(F.col("id"), F.lit(7).cast("bigint")).alias("misdiagnosed_ids"),
            F.create_map(F.lit("7"), F.concat(F.lit("to "), F.col("id").cast("string"))).alias("misdiagnosis_corrections"),
            F.when(F.col("id") % 2 == 0, 0.25).otherwise(0.75).alias("cluster_coherence"),
            F.array(F.struct(F.lit("a").alias("source_tag"), (F.col("id") % 3).cast("string").alias("target_tag"), F.lit(True).alias("confirmed"))).alias("semantic_merges"),
        )).alias("clean"),
    )
    joined = co.joined_answers(answered)
    assert "collect" not in joined._jdf.queryExecution().toString()
    row = joined.first()
    assert row["rows_seen"] == 2 * n and row["problem"] == "bad 0"
    assert row["answer"]["refined_root_cause"] == "why 1" and row["answer"]["cluster_coherence"] == pytest.approx(0.5)
    details = co.told_details(answered)
    assert details.filter("task_id IS NOT NULL").count() == n * 4 // 5
    assert [tuple(r) for r in details.filter("about IS NOT NULL").collect()] == [("modeling", "loop", None, "7", "to 1")]
    groups = spark.createDataFrame([("modeling", "loop", 1)], "fault_type string, tag string, min_task_id long")
    merges = {r["target_tag"]: r["position"] for r in co.told_proposals(answered, groups).collect()}
    assert merges == {"1": 2**31, "2": 2 * 2**31, "0": 3 * 2**31}


def verifier(answers):
    """A batch verifier that remembers nothing and answers by task; a list is several answers."""
    def check(batches):
        for pdf in batches:
            told = [(t, s) for t in pdf["task_id"] for s in (answers[t] if isinstance(answers.get(t), list) else [answers.get(t, "left out")])]
            yield pd.DataFrame([x for x in told if x[1] != "left out"], columns=["task_id", "status"])
    return check


def test_batch_verifiers_in_a_ladder(spark):
    rows = diagnoses(spark, [{"task_id": i, "confidence": 0.9} for i in range(1, 9)])
    first = verifier({1: "passed", 2: "failed", 3: None, 4: ["passed", "failed"], 5: "great", 6: ["passed", "passed"], 7: [None, "failed"], 99: "passed"})
    second = verifier({1: "failed", 3: "failed", 4: "passed"})
    events = []
    found = repaired(rows, "exec_api", verifiers={"exec_api": first, "cross_model": second}, on_events=lambda e: events.extend(e.collect()))
    got = {r["task_id"]: (r["enriched_labels"]["verification_level"], r["enriched_labels"]["verification_status"], r["confidence"]) for r in found.collect()}
    assert got == {
        1: ("exec_api", "passed", 0.9), 2: ("exec_api", "unverified", 0.5), 3: ("cross_model", "unverified", 0.5), 4: ("cross_model", "passed", 0.9),
        5: ("self_check", "passed", 0.9), 6: ("exec_api", "passed", 0.9), 7: ("exec_api", "unverified", 0.5), 8: ("self_check", "passed", 0.9)}
    assert {(r["task_id"], r["message"]) for r in events} == {(4, "exec_api: answered in several ways"), (5, "exec_api: no such status: great")}
    with pytest.raises(Exception, match="No verification path"):
        repaired(rows, "self_check", verifiers={"self_check": verifier({})}).collect()


def test_batch_rediagnoser_is_gated(spark):
    rows = diagnoses(spark, [{"task_id": i} for i in range(1, 5)])

    def again(batches):
        for pdf in batches:
            out = [r for r in pdf.to_dict("records") if r["task_id"] != 4]  # one left out
            for r in out:
                r["description"], r["severity"] = "again", "awful" if r["task_id"] == 3 else "high"
            yield pd.DataFrame(out, columns=DIAGNOSIS.fieldNames())

    events = []
    check = F.when(F.col("description") == "again", "passed").otherwise("failed")
    found = repaired(rows, verifiers={"self_check": check}, rediagnose=batch_rediagnoser(again, lambda e: events.extend(e.collect())))
    assert {r["task_id"]: (r["severity"], r["enriched_labels"]["verification_status"]) for r in found.collect()} == {
        1: ("high", "passed"), 2: ("high", "passed"), 3: ("low", "unverified"), 4: ("low", "unverified")}
    assert {(r["task_id"], r["message"]) for r in events} == {(3, "invalid: severity"), (4, "not answered")}


def test_a_run_calls_hooks_and_logs_what_they_answer_badly(spark, tmp_path):
    def deep(batches):
        for pdf in batches:
            yield pd.DataFrame([], columns=DIAGNOSIS.fieldNames())  # answers nothing

    def collective(batches):
        for pdf in batches:
            yield pd.DataFrame({"cluster_key": pdf["cluster_key"], "answer": "nothing"})

    hooks = Hooks(deep=deep, collective=collective, verifiers={"cross_model": verifier({i: "odd" for i in range(10)})})
    row = run(spark, tasks(spark, [{"task_id": 1, "completion": "AssertionError in go_on"}, {"task_id": 2, "completion": "fine"}]), str(tmp_path), "r",
              settings=Settings(top_n=1), hooks=hooks, prompt_versions={"diagnose": "v2"}).first()
    assert row["prompt_versions"] == {"diagnose": "v2"} and row["stages_executed"] == ["diagnose", "aggregate", "synthesize"]
    log = RunStore(spark, str(tmp_path), "r").read("events", EVENT_LOG).collect()
    kinds = {(r["stage"], r["error_type"]) for r in log}
    assert kinds >= {("diagnose", "analyzer_answer_rejected"), ("aggregate", "collective_parse_failure"), ("aggregate", "verifier_answer_rejected")}
    assert all(r["cluster"]["task_ids"] for r in log if r["stage"] != "synthesize")
