"""Texts of papers from a remote store, by a callable that asks for one, or as a format that Spark reads."""

from __future__ import annotations

import importlib
import json
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from ..operators import complete


def fetched(papers: DataFrame, get: Callable[[int], tuple[int, dict | None]]) -> DataFrame:
    """paper_id and markdown of each paper, asked for by the tasks. get gives a status and a body with `markdown`.

    A status of 404, an empty text and a call that fails for good are no text (null); passing failures are tried again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(paper: int) -> str | None:
            try:
                return (complete.with_retries(lambda: get(paper), missing=(404,)) or {}).get("markdown") or None
            except Exception:
                return None

        for pdf in batches:
            yield pd.DataFrame({"paper_id": pdf["paper_id"], "markdown": [one(int(p)) for p in pdf["paper_id"]]})

    return papers.select(F.col("paper_id").cast("long").alias("paper_id")).mapInPandas(run, "paper_id long, markdown string")


def with_fetched(papers: DataFrame, texts: DataFrame, get: Callable[[int], tuple[int, dict | None]]) -> DataFrame:
    """Texts that were looked up (paper_id, markdown), and of those papers that have none, what the store has now. Keep the result before it's used."""
    missing = papers.join(texts.where("markdown is not null and markdown <> ''").select("paper_id"), "paper_id", "left_anti")
    return fetched(missing, get)


# -- the same as a format that Spark reads: partitions of ids, pushed-down filters, calls at a time


def named(place: str) -> Callable:
    """The function of "package.module:name"."""
    module, _, name = place.partition(":")
    found = getattr(importlib.import_module(module), name, None) if name else None
    if not callable(found):
        raise ValueError(f"no function {place!r}; give package.module:name")
    return found


def nowhere(paper: int) -> tuple[int, dict | None]:
    """A store that has no text."""
    return 404, None


@dataclass
class Ids(InputPartition):
    """The ids that a task asks for."""

    ids: Sequence[int]

    def __init__(self, ids: Sequence[int]) -> None:
        super().__init__(None)
        self.ids = ids


class RemoteTexts(DataSource):
    """spark.read.format("remote_texts"): paper_id, markdown, error. A paper without a text (404, an empty one) has neither, a call that failed for good its error.

    Options: get, "package.module:name" of a function of an id that gives a status and a body with `markdown`; ids, a JSON list, or low and high,
    a range of ids of which high is out; partitions (8), tasks that the ids are dealt over; concurrency (4), calls at a time in a
    task; retries wait as elsewhere. Filters by paper_id (equal, in a list, from, to) leave ids out before they're dealt.
    """

    @classmethod
    def name(cls) -> str:
        return "remote_texts"

    def schema(self) -> str:
        return "paper_id long, markdown string, error string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return RemoteReader({k: str(v) for k, v in self.options.items()})


class RemoteReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        named(options["get"])  # a wrong name is told before a job runs
        self.get, self.concurrency, self.n = options["get"], max(1, int(options.get("concurrency", 4))), max(1, int(options.get("partitions", 8)))
        self.ids: Sequence[int] = sorted({int(i) for i in json.loads(options["ids"])}) if "ids" in options else range(int(options["low"]), int(options["high"]))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes filters by paper_id; the others are Spark's."""
        for f in filters:
            mine = getattr(f, "attribute", None) == ("paper_id",)
            if mine and isinstance(f, In):
                wanted = {int(v) for v in f.value if v is not None}
                self.ids = sorted(i for i in wanted if i in self.ids)
            elif mine and isinstance(f, EqualTo) and f.value is not None:
                self.ids = [int(f.value)] if int(f.value) in self.ids else []
            elif mine and isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                at = (bisect_right if isinstance(f, (GreaterThan, LessThanOrEqual)) else bisect_left)(self.ids, int(f.value))
                self.ids = self.ids[at:] if isinstance(f, (GreaterThan, GreaterThanOrEqual)) else self.ids[:at]
            elif not (mine and isinstance(f, IsNotNull)):
                yield f

    def partitions(self) -> list[Ids]:
        n = min(self.n, len(self.ids))
        return [Ids(self.ids[i * len(self.ids) // n : (i + 1) * len(self.ids) // n]) for i in range(n)] or [Ids([])]

    def read(self, partition: Ids) -> Iterator[tuple]:
        """Rows in the order of their ids; as many calls are under way as concurrency says, whatever the number of ids."""
        get = named(self.get)

        def one(paper: int) -> tuple:
            try:
                return paper, (complete.with_retries(lambda: get(paper), missing=(404,)) or {}).get("markdown") or None, None
            except Exception as e:
                return paper, None, complete.error_text(e)

        waiting: deque[Future] = deque()
        with ThreadPoolExecutor(self.concurrency) as pool:
            for paper in partition.ids:
                waiting.append(pool.submit(one, paper))
                if len(waiting) > self.concurrency:
                    yield waiting.popleft().result()
            while waiting:
                yield waiting.popleft().result()


def registered(spark: SparkSession) -> SparkSession:
    """spark, which knows the format remote_texts from now on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RemoteTexts)
    return spark
