"""Numbered lines, extracted sources, calls with a stub, polling with timers, versions."""

from __future__ import annotations

import json
import threading
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quirework.functions import markup
from quirework.operators import calls
from quirework.plans import services
from quirework.sources import extracted, lines, works
from quirework.sources.versions import Conflict, IdsDiffer, VersionedTable


def test_lines_are_numbered_over_many_splits(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    texts = {f"f{k}": [f"{k} line {i} " + "x" * (i % 90) for i in range(700 * k)] for k in range(4)}
    for name, rows in texts.items():
        (folder / name).write_text("".join(f"{r}\n" for r in rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = lines.numbered_lines(spark, str(folder))
        got = {}
        for r in found.collect():
            got.setdefault(r["path"].rsplit("/", 1)[-1], {})[r["line_no"]] = r["line"]
        assert got == {n: dict(enumerate(rows, 1)) for n, rows in texts.items() if rows}
        assert found.rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_json_lines_tell_path_and_line(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"id": "a", "n": 1}\n\n  \n{"id": "b"\n{"id": "c", "n": "x"}\n')
    schema = StructType.fromDDL("id string, n long")
    rows = {r["line_no"]: (r["row"] and tuple(r["row"]), r["error"]) for r in lines.jsonl_rows(spark, str(path), schema).collect()}
    assert rows == {1: (("a", 1), None), 4: (None, "invalid JSON"), 5: (("c", None), None)}
    with pytest.raises(PySparkException, match=r"a\.jsonl:4: invalid JSON"):
        lines.strict_jsonl(spark, str(path), schema).collect()
    assert lines.strict_jsonl(spark, f"{tmp_path}/none", schema).collect() == []
    assert lines.jsonl_rows(spark, f"{tmp_path}/none", schema).first()["line_no"] == 0
    found = lines.error_findings(lines.jsonl_rows(spark, str(path), schema), "json_errors").first()
    assert (found["code"], found["severity"], found["n"], found["samples"][0]["line_no"]) == ("json_errors", "fail", 1, 4)


def test_extracted_works(spark, tmp_path):
    work = {
        "work_id": "w",
        "page_count": 2,
        "toc": [{"level": 1, "title": "  مقدمة ", "page": 1}, {"index": 7, "level": 2, "title": "باب 2", "page": 2}],
        "pages": [
            {"pdf_page": 1, "width": 400.0, "height": 600.0, "blocks": [{"id": "w.b1", "number": 1, "bbox": [1, 2, 3, 4], "text": "a", "clean_text": "A"}, {"bbox": [1, 2], "text": "b  c ."}]},
            {"pdf_page": 2, "width": 400.0, "height": 600.0, "blocks": []},
        ],
    }
    (tmp_path / "raw.json").write_text(json.dumps(work, indent=1))
    works = extracted.raw_works(spark, f"{tmp_path}/raw.json")
    rows = [(r["block_id"], r["number"], r["x0"], r["y1"], r["text"]) for r in extracted.blocks(works).orderBy("number").collect()]
    assert rows == [("w.b1", 1, 1.0, 4.0, "A"), ("w.p0001.b002", 2, 1.0, None, "b c.")]
    assert [(r["index"], r["level"], r["title"], r["key"]) for r in extracted.outline(works).orderBy("index").collect()] == [(1, 1, "مقدمة", "مقدمة"), (7, 2, "باب 2", "باب2")]
    plan = extracted.outline(works)._jdf.queryExecution().executedPlan().toString()
    assert "blocks" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_tool_output(spark, tmp_path):
    (tmp_path / "meta.json").write_text(json.dumps([{"value": {"kind": "passage", "id": "p1", "page": 3}}, {"value": {"kind": "passage", "id": "p1", "page": 2, "physical_page": 9}}, {"value": {"kind": "other", "id": "x", "page": 1}}, {"value": {"kind": "passage", "id": "", "page": 1}}]))
    assert [tuple(r) for r in extracted.page_entries(spark, f"{tmp_path}/meta.json").collect()] == [("p1", 2, 9)]
    (tmp_path / "info.txt").write_text("Title:  A: B\nno colon\nPages: 12\nPages: 13\n")
    assert extracted.file_info(spark, f"{tmp_path}/info.txt").first()["info"] == {"Title": "A: B", "Pages": "12"}
    (tmp_path / "text.txt").write_text("one\nline\f\ftwo\f")
    got = {r["page"]: r["text"] for r in extracted.page_texts(spark, f"{tmp_path}/text.txt").collect()}
    assert got == {1: "one\nline", 2: "", 3: "two"} or got == {1: "one\nline", 2: "", 3: "two\n"}
    docs = extracted.as_documents(spark, ["a b", "c"]).collect()
    assert [tuple(r) for r in docs] == [("0", "a b"), ("1", "c")] and extracted.as_documents(spark, "a b").first()["text"] == "a b"
    assert extracted.as_documents(spark, f"file://{tmp_path}/info.txt").first()["text"].startswith("Title")


MODELS = [*services._MODELS, "late"]


def requests(spark, n=3):
    rows = spark.createDataFrame([(f"s{k}", f"text {k}") for k in range(n)], "id string, text string")
    listed = calls.matrix(rows, MODELS)
    return listed.withColumn("messages", F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))))


def test_calls_retry_give_up_and_go_on(spark):
    policy = calls.Policy(retries=2, pause=0.001, deadline=3, required="translation")
    done = calls.call_rows(requests(spark).repartition(4, "id", "model"), services.offline_model, policy=policy).collect()
    assert len(done) == 3 * len(MODELS)
    by = {}
    for r in done:
        by.setdefault(r["model"], []).append((r["ok"], r["attempts"], r["error"]))
        if r["ok"]:
            assert json.loads(r["answer"])["translation"] == r["text"].upper()
    assert {x[:2] for x in by["good"]} == {(True, 1)} and {x[:2] for x in by["plain"]} == {(True, 2)} and {x[:2] for x in by["busy"]} == {(True, 3)}
    assert {x for x in by["down"]} == {(False, 3, "HTTP 503: ")} and {x[:2] for x in by["denied"]} == {(False, 1)} and {x[:2] for x in by["broken"]} == {(False, 3)}
    assert {x[2] for x in by["late"]} == {"row deadline exceeded after 3s"} and all(x[2].startswith("empty translation") for x in by["empty"])
    with pytest.raises(PySparkException):
        calls.call_rows(requests(spark, 1).where("model = 'denied'"), services.offline_model, policy=policy, go_on=False).collect()


def test_matrix_cuts_texts(spark):
    rows = spark.createDataFrame([("a", "one two  three"), ("b", "x"), ("c", None)], "id string, text string")
    got = {(r["id"], r["model"]): (r["text"], r["truncated"], r["source_length"]) for r in calls.matrix(rows, ["m", "n"], longest=8).collect()}
    assert len(got) == 6 and got["a", "m"] == ("one two", True, 7) and got["b", "n"] == ("x", False, 1) and got["c", "m"] == (None, False, 0)


def test_broken_runs_go_on_with_what_is_left(spark, tmp_path):
    asked = requests(spark, 6).where("model in ('good', 'down')")
    policy = calls.Policy(retries=0, pause=0)
    seen = []

    def run(rows):
        seen.append(rows.count())
        if len(seen) == 3:
            raise RuntimeError("lost")
        return calls.call_rows(rows, services.offline_model, policy=policy)

    with pytest.raises(RuntimeError):
        calls.saved_in_parts(asked, ["id", "model"], f"{tmp_path}/out", run, parts=4)
    held = spark.read.parquet(f"{tmp_path}/out/run=*")
    good = held.where("ok").count()
    assert held.count() == sum(seen[:2])
    seen_before, whole = len(seen), calls.saved_in_parts(asked, ["id", "model"], f"{tmp_path}/out", run, parts=4).collect()
    assert len(whole) == 12 and sum(r["ok"] for r in whole) == 6
    assert sum(seen[seen_before:]) == 12 - good


def test_versions_are_published_once(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", "id")
    assert table.version() == 0
    with pytest.raises(FileNotFoundError):
        table.read()
    rows = spark.range(20).selectExpr("concat('p', id) AS id", "id AS page", "map('print', named_struct('page', id)) AS refs")
    assert table.publish(rows, 0) == 1
    moved = lambda old: old.withColumn("page", F.when(F.col("page") < 5, F.col("page") + 100).otherwise(F.col("page")))
    assert table.sync(moved, dry_run=True).changed == 5 and table.version() == 1
    assert table.sync(moved).__dict__ == {"version": 2, "changed": 5}
    assert table.sync(moved).__dict__ == {"version": 2, "changed": 0}
    assert table.read(1).where("page >= 100").count() == 0 and table.read().where("page >= 100").count() == 5
    with pytest.raises(IdsDiffer):
        table.sync(lambda old: old.where("page < 50"))
    with pytest.raises(IdsDiffer):
        table.sync(lambda old: old.drop("refs"))
    assert table.version() == 2


def test_of_two_writers_one_is_told(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", "id")
    table.publish(spark.range(5).selectExpr("id", "0 AS by"), 0)
    out = []

    def write(k):
        mine = VersionedTable(spark, f"file://{tmp_path}/t", "id")
        try:
            out.append(("won", mine.publish(spark.range(5).selectExpr("id", f"{k} AS by"), 1)))
        except Conflict:
            out.append(("lost", k))

    threads = [threading.Thread(target=write, args=(k,)) for k in (1, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(x[0] for x in out) == ["lost", "won"] and table.version() == 2
    winner = ({1, 2} - {k for x, k in out if x == "lost"}).pop()
    assert {r["by"] for r in table.read().collect()} == {winner}
    with pytest.raises(Conflict):
        table.publish(spark.range(1).selectExpr("id", "9 AS by"), 1)


def polling_query(spark, folder, make_poll, batches, timeout):
    from quirework.streaming import polling

    for name, value in polling.STATE_STORE.items():
        spark.conf.set(name, value)
    source = f"{folder}/in"
    if not (folder / "in").exists():
        spark.createDataFrame([(b,) for b in batches], "batch string").write.json(source)
    found = polling.polled(spark.readStream.schema("batch string").json(source), make_poll, interval=0.5, timeout=timeout)
    out = found.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    return out.trigger(processingTime="1 second").start()


def answers(spark, folder):
    try:
        return sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").select("batch", "request", "answer", "error").collect())
    except PySparkException:
        return []


def wait(query, until, seconds=180):
    began = time.time()
    while not until() and time.time() - began < seconds:
        assert query.exception() is None, query.exception()
        time.sleep(0.5)


def test_polling_goes_on_after_a_stop(spark, tmp_path):
    ready = str(tmp_path / "ready")

    def make_poll():
        def poll(batch):
            import os

            return [(f"{batch}-{k}", f"answer {k}", None) for k in range(2)] if os.path.exists(ready) else None

        return poll

    query = polling_query(spark, tmp_path, make_poll, ["a", "b"], 3600)
    wait(query, lambda: query.lastProgress is not None and query.lastProgress["batchId"] >= 3)
    query.stop()
    assert answers(spark, tmp_path) == []
    open(ready, "w").close()
    query = polling_query(spark, tmp_path, make_poll, ["a", "b"], 3600)
    wait(query, lambda: len(answers(spark, tmp_path)) >= 4)
    query.stop()
    assert answers(spark, tmp_path) == [(b, f"{b}-{k}", f"answer {k}", None) for b in ("a", "b") for k in range(2)]


def test_polling_gives_up_in_time(spark, tmp_path):
    query = polling_query(spark, tmp_path, lambda: lambda batch: None, ["never"], 2)
    wait(query, lambda: answers(spark, tmp_path))
    query.stop()
    assert answers(spark, tmp_path) == [("never", "", None, "batch timed out")]


def test_work_folders_and_configuration(spark, tmp_path):
    for name in ("a/book.yml", "b/book.yml", "a/editions/print/page-map.json", "b/editions/web/page-map.json", "b/translations/en/passages.jsonl"):
        path = tmp_path / "books" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("id: x\nmodel: old\n  nested: no\n# note: no\n")
    root = f"{tmp_path}/books"
    assert sorted((r["work"], r["k"]) for r in works.work_files(spark, root, "book.yml", "k").collect()) == [("a", None), ("b", None)]
    assert sorted((r["work"], r["k"]) for r in works.work_files(spark, root, "editions/*/page-map.json", "k").collect()) == [("a", "print"), ("b", "web")]
    assert [(r["work"], r["k"]) for r in works.work_files(spark, root, "translations/*/passages.jsonl", "k").collect()] == [("b", "en")]
    assert works.work_files(spark, root, "none/*.x", "k").collect() == []
    held = works.read_config(spark, f"{root}/a/book.yml")
    new, changed = works.upserted_config(held, {"id": "y", "model": "new", "lang": "en", "empty": None}, forced=("model",))
    assert {r["key"]: r["value"] for r in new.collect()} == {"id": "x", "model": "new", "lang": "en", "empty": None} and changed == 3
    again, changed = works.upserted_config(new, {"id": "y", "model": "new", "lang": "de", "empty": None}, forced=("model",))
    assert changed == 0 and again.count() == 4
    assert works.read_config(spark, f"{root}/none").collect() == []
    schema = StructType.fromDDL("id string, n int")
    assert [tuple(r) for r in works.read_json_or_empty(spark, f"{root}/none.json", schema).collect()] == [(None, None)]


def test_front_matter_and_documents(spark, tmp_path):
    rows = spark.createDataFrame([("w", "T", None), ("v", None, "deep")], "work_id string, title string, heading_profile string")
    lines_of = {}
    for r in works.front_matter(rows).orderBy("at").collect():
        lines_of.setdefault(r["work_id"], []).append(r["line"])
    assert lines_of["w"][:3] == ["---", "work_id: w", "title_ar: T"] and lines_of["w"][-2:] == ["---", ""] and len(lines_of["w"]) == 8
    assert lines_of["v"][2] == "title_ar: " and "heading_profile: deep" in lines_of["v"]
    works.write_document(rows.where("work_id = 'v'"), f"{tmp_path}/doc")
    text = "\n".join(r["value"] for r in spark.read.text(f"{tmp_path}/doc").collect())
    assert json.loads(text) == {"work_id": "v", "title": None, "heading_profile": "deep"} and text.count("\n") >= 3
    with pytest.raises(ValueError):
        works.write_document(rows, f"{tmp_path}/other")


def test_margins(spark):
    rows = spark.createDataFrame([("", 100.0, 120.0), ("text", 37.0, 50.0), ("text", 100.0, 565.0), ("12 Sha mela.org", 100.0, 120.0), ("١ 2", 100.0, 120.0), ("text 2", 100.0, 120.0), ("text", 38.0, 564.0)], "t string, y0 double, y1 double")
    got = [r["m"] for r in rows.select(markup.is_margin(F.col("t"), F.col("y0"), F.col("y1"), F.lit(600.0)).alias("m")).collect()]
    assert got == [True, True, True, True, True, False, False]
