"""Calls of a model as an operator: a deterministic one in SQL, and any Python callable over partitions."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterator, MutableMapping
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

USAGE = "struct<input_tokens:bigint,output_tokens:bigint,cached_tokens:bigint,total_tokens:bigint>"
COMPLETION = f"text string, usage {USAGE}, cost string, latency_ms bigint, error string"
#: Tries, the base of waits between them in seconds, and the HTTP statuses that are tried again.
TRIES, BACKOFF, RETRIED = 4, 1.5, (429, 500, 502, 503, 504)


class Limiter:
    """At most rpm calls in any 60 seconds: a call of exactly 60 seconds ago no longer counts."""

    def __init__(self, rpm: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        if rpm <= 0:
            raise ValueError("rpm must be above 0")
        self.most, self.clock, self.sleep, self.calls, self.lock = max(1, int(rpm)), clock, sleep, deque(), threading.Lock()

    def wait(self) -> None:
        while True:
            with self.lock:
                now = self.clock()
                while self.calls and now - self.calls[0] >= 60:
                    self.calls.popleft()
                if len(self.calls) < self.most:
                    self.calls.append(now)
                    return
                rest = 60 - (now - self.calls[0])
            self.sleep(rest)


def dummy(rows: DataFrame, keys: str | None = None) -> DataFrame:
    """The deterministic model: a fixed reasoning, or null answers to the keys; 10 tokens in, 5 out, no cost. All SQL."""
    usage = F.struct(*(F.lit(n).cast("long").alias(k) for k, n in (("input_tokens", 10), ("output_tokens", 5), ("cached_tokens", 0), ("total_tokens", 15))))
    text = F.lit("Dummy reasoning.") if keys is None else dummy_reply(F.col(keys))
    return rows.withColumn("completion", F.struct(text.alias("text"), usage.alias("usage"), F.lit("0").alias("cost"), F.lit(1).cast("long").alias("latency_ms"), F.lit(None).cast("string").alias("error")))


def dummy_reply(keys: Column) -> Column:
    one = lambda k: F.concat(F.lit('{"key":"'), k, F.lit('","value":null,"cited_text":"","comment":"dummy","confidence":null}'))
    return F.concat(F.lit('{"results":['), F.array_join(F.transform(keys, one), ","), F.lit("]}"))


def asked_keys(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("key='([^']+)'"), F.lit(1))


_NOTHING = {"text": None, "usage": None, "cost": None, "latency_ms": None, "error": None}


def error_text(e: BaseException) -> str:
    """An error's kind, status, text and cause, those that there are."""
    cause = e.__cause__ or e.__context__
    parts = [type(e).__name__, getattr(e, "status_code", None), str(e) or None, f"caused by {type(cause).__name__}: {cause}" if cause else None]
    return " | ".join(str(p) for p in parts if p is not None)


def called(call: Callable[[dict], dict], row: dict, clock: Callable[[], float] = time.monotonic) -> dict:
    """A completion by a callable: an error is one too, and time is taken where the callable didn't."""
    began = clock()
    try:
        got = _NOTHING | call(row)
    except Exception as e:
        got = _NOTHING | {"error": error_text(e)}
    return got | ({"latency_ms": int((clock() - began) * 1000)} if got["latency_ms"] is None else {})


def complete(rows: DataFrame, call: Callable[[dict], dict], *, rpm: float | None = None, concurrency: int = 1, tasks: int | None = None, columns: tuple[str, ...] = ("cid", "messages")) -> DataFrame:
    """rows with completion, by a callable of a row's columns (cid is the idempotency key).

    A task makes up to `concurrency` calls at a time. With `tasks`, rows are dealt over so many, and rpm and concurrency are
    of all of them together; without, of each task. An error is a row with error set, never a lost one. Write the
    result before anything else reads it, so no call is paid twice.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    if tasks:
        rows, rpm, concurrency = rows.repartition(tasks), rpm and rpm / tasks, max(1, concurrency // tasks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = Limiter(rpm) if rpm else None

        def one(row: dict) -> dict:
            if limiter:
                limiter.wait()
            return called(call, row)

        with ThreadPoolExecutor(concurrency) as pool:
            for pdf in batches:
                yield pdf.assign(completion=list(pool.map(one, pdf[list(columns)].to_dict("records"))))

    return rows.mapInPandas(run, f"{fields}, completion struct<{COMPLETION.replace(' string', ':string').replace(' bigint', ':bigint').replace('usage ', 'usage:')}>")


def probed(rows: DataFrame, call: Callable[[dict], dict], *, columns: tuple[str, ...] = ("cid", "messages"), **how) -> DataFrame:
    """As complete(), but the first call (by cid) is made alone: if it fails, no other is made and all rows have its error."""
    first = rows.orderBy("cid").limit(1).collect()
    if not first:
        return complete(rows, call, columns=columns, **how)
    got = called(call, first[0].asDict(recursive=True))
    kind = complete(rows, call, columns=columns, **how).schema["completion"].dataType
    known = rows.sparkSession.createDataFrame([(first[0]["cid"], got)], T.StructType([T.StructField("__cid", T.StringType()), T.StructField("completion", kind)]))
    if got["error"] is not None:
        return rows.crossJoin(F.broadcast(known.select("completion")))
    mine = rows.join(F.broadcast(known), F.col("cid") == F.col("__cid")).drop("__cid")
    return mine.unionByName(complete(rows.where(F.col("cid") != F.lit(first[0]["cid"])), call, columns=columns, **how))


def with_retries(send: Callable[[], tuple[int, object]], sleep: Callable[[float], None] = time.sleep, missing: tuple[int, ...] = ()) -> object:
    """What send returns with a good status; a passing failure (RETRIED, or a broken connection) is tried again, up to TRIES tries.

    A status in `missing` means that there's nothing (None); any other bad one is an error.
    """
    for attempt in range(TRIES):
        last = attempt == TRIES - 1
        try:
            status, body = send()
        except OSError:
            if last:
                raise
            status = None
        if status in missing:
            return None
        if status is not None and status < 400:
            return body
        if status is not None and (last or status not in RETRIED):
            raise RuntimeError(f"status {status} after {attempt + 1} tries")
        sleep(BACKOFF**attempt)
    raise AssertionError


def batch_status(provider: Column, status: Column) -> Column:
    """A provider's status as done, failed or running."""
    openai = F.when(status == "completed", "done").when(status.isin("failed", "expired", "cancelled"), "failed").otherwise("running")
    return F.when(provider == "anthropic", F.when(status == "ended", "done").otherwise("running")).otherwise(openai)


class BatchPending(Exception):
    """A batch isn't ready; a later call with the same key goes on with it."""


def park_or_collect(state: MutableMapping[str, str], key: str, submit: Callable[[], str], poll: Callable[[str], str], collect: Callable[[str], DataFrame], keep: bool = False) -> DataFrame:
    """Submits a batch once, asks for it once a call; its key stays while it runs and goes when it has failed or is done, unless keep says that the
    caller takes it away once it has kept the results."""
    if key not in state:
        state[key] = submit()
    batch = state[key]
    status = poll(batch)
    if status == "running":
        raise BatchPending(f"batch {batch} is running")
    if status == "failed" or not keep:
        del state[key]
    if status == "failed":
        raise RuntimeError(f"batch {batch} failed")
    return collect(batch)


class BatchProvider(Protocol):
    """A provider of asynchronous batches; what runs the requests is its own business."""

    def submit(self, lines: DataFrame) -> str: ...

    def poll(self, batch: str) -> str: ...

    def collect(self, batch: str) -> DataFrame: ...


def provider_of(name: str, known: dict[str, Callable[[], BatchProvider]]) -> BatchProvider:
    """The provider of a name; one that isn't known is an error."""
    if name.lower() not in known:
        raise ValueError(f"no batch provider {name!r}; known: {sorted(known)}")
    return known[name.lower()]()


def batched(state: MutableMapping[str, str], key: str, provider: BatchProvider, lines: DataFrame, keep: bool = False) -> DataFrame:
    """A batch's results, once it is done; before, BatchPending is raised and the next call with the key goes on."""
    return park_or_collect(state, key, lambda: provider.submit(lines), provider.poll, provider.collect, keep)


def without(rows: DataFrame, error: str) -> DataFrame:
    """rows with a completion that is an error."""
    none = lambda kind: F.lit(None).cast(kind)
    return rows.withColumn("completion", F.struct(none("string").alias("text"), none(USAGE).alias("usage"), none("string").alias("cost"), none("bigint").alias("latency_ms"), F.lit(error).alias("error")))


def with_batch_results(rows: DataFrame, results: DataFrame, provider: str, model: str, prices: DataFrame | None = None) -> DataFrame:
    """rows with completion, by a batch's results (cid, text, error, and counts of tokens that it tells); a cid without one is an error."""
    n = lambda c: (F.coalesce(F.col(c), F.lit(0)) if c in results.columns else F.lit(0)).cast("bigint")
    told = results.select("cid", "text", "error", n("input_tokens").alias("input_tokens"), n("output_tokens").alias("output_tokens"), n("cached_tokens").alias("cached_tokens"))
    told = told.withColumns({"provider": F.lit(provider), "model": F.lit(model)})
    told = told.withColumn("cost", F.lit(None).cast("string")) if prices is None else batch_cost(told, prices)
    usage = F.struct("input_tokens", "output_tokens", "cached_tokens", (F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"))
    said = told.select("cid", F.struct("text", usage.cast(USAGE).alias("usage"), "cost", F.lit(None).cast("bigint").alias("latency_ms"), "error").alias("__c"))
    lost = without(rows.limit(0), "").schema["completion"].dataType
    nothing = F.struct(*(F.lit("no result in the batch" if f.name == "error" else None).cast(f.dataType).alias(f.name) for f in lost))
    return rows.join(said, "cid", "left").withColumn("completion", F.coalesce("__c", nothing)).drop("__c")


def submitted_lines(lines: DataFrame, path: str) -> str:
    """Writes a batch's request lines (column value) as text files; the path that a provider uploads."""
    lines.select("value").write.text(path)
    return path


def worth_warming(*, cache: bool, cache_first: str, n_requests: int, provider: str, submitted: bool) -> bool:
    """Whether a batch's shared start should be put into the provider's cache before the batch is submitted."""
    return cache and cache_first == "questions" and n_requests > 1 and provider.lower() == "anthropic" and not submitted


def warmed(send: Callable[[], object]) -> bool:
    """Makes the warming call; a failure is no reason not to go on."""
    try:
        send()
    except Exception:
        return False
    return True


def batch_cost(rows: DataFrame, prices: DataFrame) -> DataFrame:
    """rows (provider, model, input_tokens, output_tokens, cached_tokens) with cost at batch prices; null for a model without prices.

    prices: provider, model, input, output, cached: dollars of a million tokens.
    """
    per = prices.select("provider", "model", *(F.col(c).cast("decimal(12,6)").alias(f"__{c}") for c in ("input", "output", "cached")))
    n = lambda c: F.coalesce(F.col(f"{c}_tokens"), F.lit(0)).cast("decimal(12,0)")
    cost = sum((n(c) * F.col(f"__{c}") for c in ("output", "cached")), n("input") * F.col("__input")) * F.lit("0.000001").cast("decimal(7,6)")
    return rows.join(per, ["provider", "model"], "left").withColumn("cost", cost.cast("decimal(18,8)").cast("string")).drop("__input", "__output", "__cached")
