"""Queries on calls of an offline model, on files with bad lines, and on tables in versions."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quirework.operators import calls
from quirework.plans.registry import register
from quirework.session import shared_path, table
from quirework.sources import lines
from quirework.sources.versions import VersionedTable


def offline_model() -> calls.Client:
    """A stand-in for a service, by the model's name: upper-cases texts, or fails as services do."""
    seen: dict[str, int] = {}

    def client(payload: dict) -> str:
        model, text = payload["model"], payload["messages"][-1]["content"]
        seen[model + text] = seen.get(model + text, 0) + 1
        if model == "busy" and seen[model + text] % 3:
            raise calls.CallFailed(429, "slow down")
        if model == "plain" and "response_format" in payload:
            raise calls.CallFailed(400, "no response format")
        if model in ("down", "denied"):
            raise calls.CallFailed({"down": 503, "denied": 401}[model])
        if model == "broken":
            raise KeyError("choices")
        if model == "late":
            time.sleep(20)
        said = " " if model == "empty" else text.upper().replace("\\", "\\\\").replace('"', '\\"')
        return f'Sure: {{"translation": "{said}"}} done'

    return client


_MODELS = ["good", "busy", "plain", "down", "denied", "broken", "empty"]


@register(
    "model_matrix",
    f"""
    WITH s AS (SELECT DISTINCT role || ' ' || turn AS id, role || ' ' || turn AS said FROM conversations),
    m AS (SELECT id, said, unnest(['{"', '".join(_MODELS)}']) AS model FROM s)
    SELECT id, model, model IN ('good', 'busy', 'plain') AS ok, CASE WHEN model IN ('good', 'busy', 'plain') THEN upper(said) END AS translation,
      CASE model WHEN 'good' THEN 1 WHEN 'plain' THEN 2 WHEN 'denied' THEN 1 WHEN 'empty' THEN 1 ELSE 3 END::INTEGER AS attempts,
      CASE model WHEN 'down' THEN 'HTTP 503: ' WHEN 'denied' THEN 'HTTP 401: ' WHEN 'broken' THEN '''choices''' WHEN 'empty' THEN 'empty translation: {{"translation": " "}}' END AS error FROM m
    """,
)
def model_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of turns of all conversations, sent to each of several offline models, with retries and errors as data."""
    kind = F.concat_ws(" ", "role", F.col("turn").cast("string"))
    samples = table(spark, sf_dir, "conversations").select(kind.alias("id"), kind.alias("text")).distinct()
    asked = calls.matrix(samples, _MODELS).withColumn("messages", F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))))
    done = calls.call_rows(asked, offline_model, policy=calls.Policy(retries=2, pause=0.001, required="translation"))
    return done.select("id", "model", "ok", F.get_json_object("answer", "$.translation").alias("translation"), "attempts", "error")


@register(
    "json_error_lines",
    """
    WITH d AS (SELECT CASE WHEN doc_id % 29 = 3 THEN 'bad' WHEN doc_id % 29 = 4 THEN 'blank' WHEN doc_id % 29 = 5 THEN 'wrong' ELSE 'good' END AS kind, lang, doc_id FROM documents)
    SELECT lang, count(*) FILTER (WHERE kind <> 'blank')::BIGINT AS rows, count(*) FILTER (WHERE kind = 'bad')::BIGINT AS errors, count(*) FILTER (WHERE kind IN ('good', 'wrong'))::BIGINT AS parsed,
      coalesce(sum(doc_id) FILTER (WHERE kind = 'good'), 0)::BIGINT AS ids FROM d WHERE lang IS NOT NULL GROUP BY lang HAVING rows > 0
    """,
)
def json_error_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines of a file set per language, some broken, blank or of a wrong type: rows and errors as read."""
    k = F.col("doc_id") % 29
    good = F.to_json(F.struct(F.col("doc_id").alias("id"), "text"))
    line = F.when(k == 3, F.substring(good, F.lit(1), F.length(good) - 1)).when(k == 4, " ").when(k == 5, '{"id": "none"}').otherwise(good)
    path = shared_path(spark, "json-lines")
    table(spark, sf_dir, "documents").where("lang is not null").select("lang", line.alias("value")).write.partitionBy("lang").text(path)
    rows = lines.jsonl_rows(spark, f"{path}/*", StructType.fromDDL("id long, text string"))
    lang = F.regexp_extract("path", "/lang=([^/]*)/", 1).alias("lang")
    return rows.groupBy(lang).agg(
        F.count("*").alias("rows"),
        F.count("error").alias("errors"),
        F.count("row").alias("parsed"),
        F.coalesce(F.sum("row.id"), F.lit(0)).alias("ids"),
    )


@register(
    "version_syncs",
    """
    WITH n AS (SELECT count(DISTINCT doc_id) AS n, count(DISTINCT doc_id) FILTER (WHERE doc_id % 7 = 2) AS moved FROM documents)
    SELECT 1::BIGINT AS step, 1::BIGINT AS version, n::BIGINT AS changed FROM n UNION ALL SELECT 2, CASE WHEN moved > 0 THEN 2 ELSE 1 END, moved FROM n UNION ALL SELECT 3, CASE WHEN moved > 0 THEN 2 ELSE 1 END, 0 FROM n
    """,
)
def version_syncs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages published, synced with a page map that moves every seventh, and synced again: versions and changed rows."""
    held = VersionedTable(spark, shared_path(spark, "versions"), "id")
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), (F.floor(F.col("doc_id") / 4) + 1).alias("page")).distinct()
    steps = [(1, held.publish(rows, 0), held.read().count())]
    moved = lambda old: old.withColumn("page", F.when((F.col("id") % 7 == 2) & (F.col("page") < 10**9), F.col("page") + 10**9).otherwise(F.col("page")))
    for step in (2, 3):
        done = held.sync(moved)
        steps.append((step, done.version, done.changed))
    return spark.createDataFrame(steps, "step long, version long, changed long")
