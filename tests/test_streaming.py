import json

from weakspot.plans.diagnose import diagnose
from weakspot.schemas import DIAGNOSIS, TASK
from weakspot.sources.artifacts import RunStore
from weakspot.streaming import ingest


def put(folder, name, ids):
    rows = [{"task_id": i, "content": "c", "canonical_solution": "", "completion": "KeyError" if i % 2 else "ok", "test_code": "",
             "labels": {}, "accepted": False, "metrics": "{}", "extra": "{}"} for i in ids]
    (folder / name).write_text("\n".join(map(json.dumps, rows)), encoding="utf-8")


def test_ingest_keeps_ids_unique_and_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    store = RunStore(spark, str(tmp_path / "out"), "live")
    log = ingest.ProgressLog()
    spark.streams.addListener(log)
    put(folder, "a.json", [1, 2, 2, 3])
    put(folder, "b.json", [3, 4])
    for extra in ([], [4, 5, 1]):
        if extra:
            put(folder, "c.json", extra)
        query = ingest.start(ingest.task_stream(spark, str(folder), 1), store, str(tmp_path / "ck"))
        query.awaitTermination(120)
        assert query.exception() is None
    spark.streams.removeListener(log)
    stored = store.read("diagnoses", DIAGNOSIS).collect()
    batch = diagnose(spark.read.schema(TASK).json(str(folder)).dropDuplicates(["task_id"])).collect()
    assert sorted(map(str, stored)) == sorted(map(str, batch)) and len(stored) == 5


def test_bad_and_differing_rows_are_set_aside(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "a.json", [1, 2])
    good = (folder / "a.json").read_text(encoding="utf-8").splitlines()
    changed = good[1].replace('"KeyError"', '"other"').replace('"ok"', '"other"')
    (folder / "a.json").write_text("\n".join([*good, "{broken", "", '{"task_id": 7}', good[0], changed, '[1]']), encoding="utf-8")
    store = RunStore(spark, str(tmp_path / "out"), "live")
    for _ in range(2):
        ingest.start(ingest.task_stream(spark, str(folder)), store, str(tmp_path / "ck")).awaitTermination(120)
    assert sorted(r["task_id"] for r in store.read("diagnoses", DIAGNOSIS).collect()) == [1, 2]
    aside = ingest.set_aside(store).collect()
    assert sorted(r["raw"] for r in aside) == sorted(["{broken", '{"task_id": 7}', "[1]", max(good[1], changed)])
    assert all(r["problem"] and r["file"].endswith("a.json") for r in aside)


def line(task_id, completion="ok", **more):
    return json.dumps({"task_id": task_id, "content": "c", "canonical_solution": "", "completion": completion, "test_code": "",
                       "labels": {"a": "1", "b": "2"}, "accepted": False, "metrics": "{}", "extra": "{}", **more})


def frame(spark, *lines):
    return spark.createDataFrame([("f", text) for text in lines], "file string, raw string")


def told(store):
    return sorted((r["batch"], json.loads(r["raw"])["completion"], r["problem"]) for r in ingest.set_aside(store).collect())


def ids(store):
    return sorted(r["task_id"] for r in store.read("diagnoses", DIAGNOSIS).collect())


def test_an_id_keeps_its_content_across_batches(spark, tmp_path):
    store = RunStore(spark, str(tmp_path), "live")
    run = ingest.diagnose_batch(store, buckets=8)
    run(frame(spark, line(1), line(2)), 0)
    reordered = json.dumps(dict(reversed(json.loads(line(1, labels={"b": "2", "a": "1"})).items())))
    run(frame(spark, line(1), reordered, line(2, "changed"), line(3), line(3, "zz")), 1)
    run(frame(spark, line(3, "zz"), line(2, "changed"), line(4)), 2)
    assert ids(store) == [1, 2, 3, 4]
    earlier, beside = "another row with this task_id came earlier", "another row has this task_id"
    assert told(store) == [(1, "changed", earlier), (1, "zz", beside), (2, "changed", earlier), (2, "zz", earlier)]


def test_ids_and_digests_are_not_sent_to_the_driver(spark, tmp_path):
    # files, as their size is what Spark guesses by
    frame(spark, line(1), line(1, "changed"), line(2)).write.parquet(str(tmp_path / "lines"))
    spark.createDataFrame([(2, "x")], "task_id long, digest string").write.parquet(str(tmp_path / "known"))
    lines, known = spark.read.parquet(str(tmp_path / "lines")), spark.read.parquet(str(tmp_path / "known"))
    for before in (None, known):
        rows, bad = ingest.sorted_out(lines, before)
        for told_apart in (rows, bad):
            assert "Broadcast" not in told_apart._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["task_id"] for r in rows.collect()) == ([1] if before else [1, 2])
        assert bad.count() == (2 if before else 1)


def test_a_batch_lost_at_any_write_is_replaced(spark, tmp_path, monkeypatch):
    store = RunStore(spark, str(tmp_path), "live")
    run = ingest.diagnose_batch(store, buckets=8)
    run(frame(spark, line(1)), 0)
    batch = frame(spark, line(1, "changed"), line(2), line(5))
    for lost in (ingest.QUARANTINE, ingest.LEDGER, None):
        with monkeypatch.context() as patch:
            if lost == ingest.LEDGER:
                patch.setattr(ingest.Ledger, "add", lambda *_: 1 / 0)
            elif lost:
                write = RunStore.write_part
                patch.setattr(RunStore, "write_part", lambda self, df, name, part: 1 / 0 if name == lost else write(self, df, name, part))
            try:
                run(batch, 1)
            except ZeroDivisionError:
                assert lost
    run(batch, 1)  # done, and run again all the same
    assert ids(store) == [1, 2, 5] and told(store) == [(1, "changed", "another row with this task_id came earlier")]
    run(frame(spark, line(2), line(5, "late")), 2)
    assert ids(store) == [1, 2, 5] and told(store)[-1][0] == 2


def test_a_batch_reads_the_buckets_of_its_ids_only(spark, tmp_path):
    store = RunStore(spark, str(tmp_path), "live")
    ledger = ingest.Ledger(store, 64)
    ingest.diagnose_batch(store, buckets=64)(frame(spark, *[line(i) for i in range(200)]), 0)
    some = spark.createDataFrame([(3,), (4,), (999,)], "task_id long")
    touched = {r[0] for r in some.select(ledger.bucket()).collect()}
    read = ledger.before(some, "none")
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in read.inputFiles()} <= touched
    assert {3, 4} <= {r["task_id"] for r in read.collect()}


def test_ids_of_an_older_log_are_taken(spark, tmp_path):
    store = RunStore(spark, str(tmp_path), "live")
    row = {"task_id": 1, "content": "", "canonical_solution": "", "completion": "KeyError", "test_code": "", "labels": {},
           "accepted": False, "metrics": "{}", "extra": "{}"}
    store.write(diagnose(spark.createDataFrame([tuple(row[f] for f in TASK.fieldNames())], TASK)), "diagnoses")
    ingest.diagnose_batch(store, buckets=4)(frame(spark, line(1), line(2)), 0)
    assert ids(store) == [1, 2] and told(store) == []
