"""Where answers go: a bulk endpoint called by partitions, a dry run, a quarantine of replies that couldn't be read, a log file."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import replies
from . import complete

OUTCOME = "run bigint, paper bigint, n_items int, n_rejected int, rejected string, error string"
Send = Callable[[int, list[dict]], tuple[int, dict]]


def as_json(items: DataFrame, kind: str = "answer") -> DataFrame:
    """run, paper, version, body: the JSON object of each item, absent costs left out, the value as a token of its own."""
    name = "extraction" if kind == "answer" else "resolution"
    plain = [c for c in items.columns if c not in ("run", "value", "status", "detail", "question_version")]
    rest = F.to_json(F.struct(*plain, F.col("status").alias(f"{name}_status"), F.col("detail").alias(f"{name}_detail")))
    body = F.concat(F.lit('{"value":'), F.coalesce("value", F.lit("null")), F.lit(","), F.substr(rest, F.lit(2)))
    return items.select("run", "paper", F.col("question_version").alias("version"), body.alias("body"))


def post(items: DataFrame, send: Send) -> DataFrame:
    """Posts items (as_json), the items of one run and paper in one call, and tells how each call went.

    send takes a run and its items' JSON and returns a status and a body with `errors`, the items that were refused: those
    are told, not raised. Statuses that pass are tried again; a call that fails for good leaves its items unposted. The
    endpoint upserts, so a task that runs again does no harm.
    """

    def calls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(run: int, paper: int, bodies: list[str]) -> tuple:
            try:
                answer = complete.with_retries(lambda: send(run, bodies)) or {}
            except Exception as e:
                return run, paper, len(bodies), 0, None, complete.error_text(e)
            refused = answer.get("errors") or []
            return run, paper, len(bodies), len(refused), "; ".join(map(str, refused)) or None, None

        held: tuple[int, int] | None = None
        bodies: list[str] = []
        out = []
        for pdf in batches:
            for run, paper, body in zip(pdf["run"], pdf["paper"], pdf["body"], strict=True):
                if held is not None and held != (run, paper):
                    out.append(done(*held, bodies))
                    bodies = []
                held = run, paper
                bodies.append(body)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in OUTCOME.split(", ")])
            out = []
        if held is not None:
            yield pd.DataFrame([done(*held, bodies)], columns=[c.split()[0] for c in OUTCOME.split(", ")])

    return items.repartition("run", "paper").sortWithinPartitions("run", "paper", "version").mapInPandas(calls, OUTCOME)


def dry_run(items: DataFrame) -> DataFrame:
    """What would be posted, a line an item."""
    place = F.concat(F.lit(" dispute_item="), F.col("dispute_item").cast("string")) if "dispute_item" in items.columns else F.lit("")
    line = F.concat(F.lit("paper="), F.col("paper").cast("string"), place, F.lit(" q="), F.col("question_key"), F.lit(" value="), F.coalesce("value", F.lit("null")))
    return items.select("run", "paper", line.alias("line"))


def quarantine(formatted: DataFrame) -> DataFrame:
    """Groups whose reply lacked a key: cid, the keys that failed, the reply, the reasoning before it."""
    rows = replies.with_results(formatted, "completion.text", "keys", "__r")
    failed = rows.where(F.col("completion.error").isNull() & (F.size(replies.failed_keys(F.col("__r"))) > 0))
    return failed.select("cid", F.transform(replies.failed_keys(F.col("__r")), lambda r: r["key"]).alias("failed_keys"), F.col("completion.text").alias("reply"), "pass1_text")


def run_log(path: str, name: str = "inkgrid") -> logging.Logger:
    """The library's logger, appending to a file on the driver."""
    log = logging.getLogger(name)
    if not any(getattr(h, "baseFilename", None) == path for h in log.handlers):
        handler = logging.FileHandler(path, mode="a", encoding="utf-8")
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        log.addHandler(handler)
    log.setLevel(logging.INFO)
    return log

