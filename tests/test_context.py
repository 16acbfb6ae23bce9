"""Prompts, routing, caches and answers on literal rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.operators import context

SEGMENT = "struct<span_id:string,kind:string,ref:string,review_required:boolean,start:int,end:int,reason:string,text:string>"


def test_context_guidance_and_messages(spark):
    rows = spark.createDataFrame([(1, "matn", [("S1", "ayah", None, True, 0, 3, "r", "x" * 200)]), (2, "quote", []), (3, None, None)], f"id int, role string, segments array<{SEGMENT}>")
    got = {r["id"]: r for r in rows.select("id", context.semantic_context(F.col("segments")).alias("c"), context.guidance(F.col("segments"), F.col("role")).alias("g")).collect()}
    assert got[1]["c"][0]["text_preview"] == "x" * 119 + "..." and got[1]["c"][0]["ref"] == "" and got[3]["c"] is None
    assert [len(got[k]["g"]) for k in (1, 2, 3)] == [5, 3, 0] and context.GUIDANCE_QUOTE in got[2]["g"]
    (m,) = rows.where("id = 2").select(context.messages(F.lit("be brief"), F.struct(F.lit("x").alias("task"))).alias("m")).collect()
    assert [(x["role"], x["content"]) for x in m["m"]] == [("system", "be brief"), ("user", '{"task":"x"}')]


def test_section_counts(spark):
    sections = spark.createDataFrame([("A", ["p1", "p2"]), ("B", ["p3"])], "section string, passage_ids array<string>")
    notes = spark.createDataFrame([("p1", "body", [("ayah",)]), ("p2", "body", None)], "id string, kind string, segments array<struct<kind:string>>")
    got = {r["section"]: r["counts"] for r in context.section_counts(sections, notes).collect()}
    assert got == {"A": {"kind:body": 2, "segment:ayah": 1}}


def test_routing_and_cache(spark):
    rows = spark.createDataFrame([("gemini-x", "q1"), ("gpt-4", "q2"), ("other", "q1")], "model string, prompt string")
    assert {r["model"]: r["provider"] for r in context.routed(rows, "model", [("^gemini", "a"), ("^g", "b")]).collect()} == {"gemini-x": "a", "gpt-4": "b", "other": "none"}
    key = rows.select(F.sha2(F.to_json(F.struct("model", "prompt")), 256).alias("key"), F.lit("yes").alias("answer")).limit(1)
    answered, left, batch = context.split_by_cache(rows, key, ["model", "prompt"], least_batch=2)
    assert answered.count() == 1 and left.count() == 2 and batch


def test_examples_extractions_and_stale_revisions(spark):
    aligned = spark.createDataFrame([(1, "exact"), (2, "fuzzy"), (3, "none")], "id int, status string")
    codes = lambda **k: {(r["id"], r["severity"]) for r in context.checked_examples(aligned, **k).collect()}
    assert codes() == {(3, "warn")} and codes(level="ERROR", strict=True) == {(2, "fail"), (3, "fail")} and codes(level="OFF") == set()
    answers = spark.createDataFrame([(1, '{"extractions": [{"drug": "b", "drug_index": 2}, {"drug": "a", "drug_index": 1}]}'), (2, "no json")], "id int, answer string")
    assert [(r["extraction_text"], r["position"]) for r in context.extractions(answers, "id", "answer").orderBy("position").collect()] == [("a", 1), ("b", 2)]
    revisions = spark.createDataFrame([("p", "t", "old"), ("q", "t", "same")], "passage_id string, target string, base_value string")
    now = spark.createDataFrame([("p", "t", "new"), ("q", "t", "same")], "passage_id string, target string, value string")
    assert [r["passage_id"] for r in context.stale_revisions(revisions, now).collect()] == ["p"]
