"""Calls of a model for each row, by a client that the caller injects: retries, deadlines, errors as data, saved parts.

A client is what ``make_client()`` returns on an executor, once for each batch of rows: a function from a payload (``model``,
``messages``, ``temperature``, and ``response_format`` while the service takes it) to the answer's text. It raises
``CallFailed`` with the service's status, or any other exception. Nothing here knows a service; tests give a stub.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as Late
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quirework.functions import text as T
from quirework.sources.readers import exists

Client = Callable[[dict], str]
#: Statuses that are tried again.
RETRIED = frozenset({408, 409, 429, 500, 502, 503, 504})
RESULT = "ok boolean, answer string, error string, attempts int, latency_seconds double"


class CallFailed(Exception):
    """The service answered with a status of its own instead of a result."""

    def __init__(self, status: int, body: str = ""):
        super().__init__(f"HTTP {status}: {body}")
        self.status = status


@dataclass(frozen=True)
class Policy:
    """``retries`` further attempts, after pauses of 1, 2, 4 … seconds up to ``longest_pause``; ``deadline`` seconds for a
    row with all its attempts (0: none). ``required`` is a field that an answer must have."""

    retries: int = 2
    longest_pause: float = 8
    pause: float = 1
    deadline: float = 0
    temperature: float = 0
    required: str | None = None


def json_object(text: str) -> dict:
    """The JSON object that a text is, or that stands between its first and last brace."""
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        begin, end = text.find("{"), text.rfind("}")
        if 0 <= begin < end:
            return json.loads(text[begin : end + 1])
        raise


def attempt(client: Client, payload: dict, policy: Policy, until: float | None = None) -> tuple[dict | None, str | None, int]:
    """(answer, error, attempts) of one payload. A service that refuses the response format gets the payload without it;
    statuses outside ``RETRIED`` end the attempts. ``until`` (a monotonic time) ends them too."""
    error = "no attempt"
    for k in range(policy.retries + 1):
        try:
            answer = json_object(client(payload))
            if policy.required and not str(answer.get(policy.required) or "").strip():
                return None, f"empty {policy.required}: {json.dumps(answer, ensure_ascii=False, sort_keys=True)}", k + 1
            return answer, None, k + 1
        except CallFailed as failed:
            error = str(failed)
            if failed.status == 400 and "response_format" in payload:
                payload = {name: value for name, value in payload.items() if name != "response_format"}
            elif failed.status not in RETRIED:
                return None, error, k + 1
        except Exception as other:  # what a client raises is a row's error, not the job's
            error = str(other) or type(other).__name__
        if k < policy.retries:
            wait = min(policy.pause * 2**k, policy.longest_pause)
            if until is not None and time.monotonic() + wait >= until:
                return None, error, k + 1
            time.sleep(wait)
    return None, error, policy.retries + 1


def call_rows(rows: DataFrame, make_client: Callable[[], Client], model: str = "model", messages: str = "messages", policy: Policy = Policy(), go_on: bool = True) -> DataFrame:
    """``rows`` with ``ok``, ``answer`` (JSON), ``error``, ``attempts`` and ``latency_seconds``.

    Rows are read in batches and called one by one; a partition has one call open at a time, so the number of partitions is
    the number of calls at once. A row whose deadline passes is an error; its call is left behind. Without ``go_on`` the
    first error fails the query.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, pool = make_client(), ThreadPoolExecutor(1)
        for batch in batches:
            out = []
            for name, said in zip(batch[model], batch[messages]):
                given = [m if isinstance(m, dict) else m.asDict() for m in (said if said is not None else [])]
                payload = {"model": name, "messages": given, "temperature": policy.temperature, "response_format": {"type": "json_object"}}
                began = time.monotonic()
                if policy.deadline > 0:
                    called = pool.submit(attempt, client, payload, policy, began + policy.deadline)
                    try:
                        answer, error, tried = called.result(policy.deadline)
                    except Late:
                        answer, error, tried = None, f"row deadline exceeded after {policy.deadline:g}s", 0
                        pool.shutdown(wait=False, cancel_futures=True)
                        client, pool = make_client(), ThreadPoolExecutor(1)
                else:
                    answer, error, tried = attempt(client, payload, policy)
                if error is not None and not go_on:
                    raise RuntimeError(error)
                said_back = None if answer is None else json.dumps(answer, ensure_ascii=False, sort_keys=True)
                out.append((error is None, said_back, error, tried, round(time.monotonic() - began, 3)))
            yield pd.concat([batch.reset_index(drop=True), pd.DataFrame(out, columns=["ok", "answer", "error", "attempts", "latency_seconds"]).astype({"attempts": "int32"})], axis=1)
        pool.shutdown(wait=False, cancel_futures=True)

    kinds = StructType([*rows.schema.fields, *StructType.fromDDL(RESULT).fields])
    return rows.mapInPandas(run, kinds)


def matrix(samples: DataFrame, models: list[str], key: str = "id", text: str = "text", longest: int | None = None, preview: int = 1200) -> DataFrame:
    """``samples`` once for each model of a list, with ``source_length``, ``truncated`` and ``preview``; texts are cut at
    ``longest`` characters first."""
    cut = F.when(F.length(text) > longest, F.rtrim(F.substring(text, 1, longest))).otherwise(F.col(text)) if longest else F.col(text)
    long = F.coalesce(F.length(text) > longest, F.lit(False)) if longest else F.lit(False)
    told = samples.withColumns({"truncated": long, text: cut})
    told = told.withColumns({"source_length": F.coalesce(F.length(text), F.lit(0)), "preview": T.truncate(F.coalesce(F.col(text), F.lit("")), preview)})
    return told.withColumn("model", F.explode(F.array(*map(F.lit, models))))


def saved_in_parts(requests: DataFrame, keys: list[str], path: str, run: Callable[[DataFrame], DataFrame], parts: int = 8, only_ok: bool = True) -> DataFrame:
    """``run(requests)`` written below ``path`` part by part, and read back.

    A run that broke goes on where it was: requests whose keys have a row there (with ``only_ok``, one that is ok) aren't run
    again. Each part is one write, so it is there whole or not at all. Of several rows of a key the best and latest counts.
    """
    spark = requests.sparkSession
    for part in range(parts):
        left = requests.where(F.pmod(F.xxhash64(*keys), F.lit(parts)) == part)
        if exists(spark, f"{path}/*/_SUCCESS"):
            held = spark.read.parquet(f"{path}/run=*")
            left = left.join(held.where("ok") if only_ok and "ok" in held.columns else held, keys, "left_anti")
        if not left.isEmpty():
            run(left).withColumn("_saved", F.current_timestamp()).write.parquet(f"{path}/run={part}-{time.time_ns()}")
    if not exists(spark, f"{path}/*/_SUCCESS"):
        return run(requests.limit(0))
    held = spark.read.parquet(f"{path}/run=*")
    names = [c for c in held.columns if c not in ("_saved", "run")]
    rank = [F.col("ok").cast("int")] if "ok" in names else []
    best = held.groupBy(*keys).agg(F.max_by(F.struct(*names), F.struct(*rank, "_saved")).alias("r"))
    return best.select("r.*")
