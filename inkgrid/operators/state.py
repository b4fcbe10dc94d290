"""State of cells as an append-only log with snapshots: each change is a row, the last row of a key is its state.

A change is one append: a folder of Parquet files under log/, which counts from the moment that an empty file of its name stands
under commits/. The name holds the append's sequence number, its writer and the runs (the first key) that it has rows of, so a
reader of one run leaves the others' folders out without opening them. Of rows of a key the last is that of the highest sequence
number; of writers that took the same one, that of the larger writer's name; of rows of one append, the later one.

compact() writes a snapshot, the last row of each key, in folders by run, and then, as its manifest, a file with the names of
the appends that it covers. A reader takes the newest snapshot with a manifest and the appends that it doesn't cover, so it sees the same state
before, during and after. Nothing is changed in place; vacuum() removes what the newest snapshot replaces once it's old enough for no reader to use it.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator, Mapping, MutableMapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATUSES = ("pending", "pass1_done", "done", "posted", "failed", "skipped")
_BODY = (("status", T.StringType()), ("payload_json", T.StringType()), ("batch_group_id", T.StringType()), ("error", T.StringType()))
#: An append of more runs than this, or of unknown ones, is read for every run. So many appends beside the snapshot are compacted when a run begins.
MOST_RUNS, MOST_APPENDS = 8, 64
_ORDER = (("updated_at", T.TimestampType()), ("seq", T.LongType()), ("writer", T.StringType()), ("row_no", T.LongType()), ("gone", T.BooleanType()))


def latest(log: DataFrame, keys: Sequence[str], order: Column | str = "seq") -> DataFrame:
    """The last row of each key: one aggregation with partial maxima, no sort."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row")).select(*keys, "__row.*").select(*log.columns)


#: Fixed value: Spark's setting that lets shuffle files go when an execution ends. Sessions inside freed(): how often, and the setting that they had.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: dict[str, tuple[int, str | None]] = {}
_LOCK = threading.Lock()


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed inside go once it has ended, not whenever the driver happens to collect its garbage.

    The setting comes back when the last thread leaves. What another thread executes meanwhile loses its files too: executed again, it writes them anew.
    """
    session = spark._jsparkSession.sessionUUID()
    with _LOCK:
        n, was = _FREEING.get(session) or (0, spark.conf.get(_FREED, None))
        _FREEING[session] = n + 1, was
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _LOCK:
            n, was = _FREEING.pop(session)
            if n > 1:
                _FREEING[session] = n - 1, was
            elif was is None:
                spark.conf.unset(_FREED)
            else:
                spark.conf.set(_FREED, was)


class Files:
    """Names and small texts under a folder, by Spark's own file systems, so that a path may be of any store that Spark knows."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.path = spark._jvm, path
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return sorted(x.getPath().getName() for x in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def age(self, name: str) -> float:
        """Seconds since a file was written."""
        return time.time() - self.fs.getFileStatus(self._at(name)).getModificationTime() / 1000

    def put(self, name: str, lines: Sequence[str] = ()) -> None:
        """A file that wasn't there, whole from the start: written beside and renamed where it holds anything."""
        if not lines:
            self.fs.create(self._at(name), False).close()
            return
        out = self.fs.create(self._at(f"{name}.tmp"), True)
        out.write(bytearray("\n".join(lines).encode()))
        out.close()
        if not self.fs.rename(self._at(f"{name}.tmp"), self._at(name)):
            raise FileExistsError(name)

    def lines(self, name: str) -> list[str]:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("\n")
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


class StateTable:
    """The log at a path. Keys are bigints, but those of `texts`; `carried` are further bigints of a row, such as the paper of a disputed item."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ("run_id", "paper_id", "version_id"), carried: Sequence[str] = (), texts: Sequence[str] = ()) -> None:
        self.spark, self.path, self.keys, self.carried, self.files = spark, path, list(keys), list(carried), Files(spark, path)
        kind = {k: T.StringType() if k in texts else T.LongType() for k in (*self.keys, *self.carried)}
        self.schema = T.StructType([T.StructField(k, t) for k, t in (*kind.items(), *_BODY, *_ORDER)])
        #: Snapshots have folders by the first key where that is a run.
        self.by_run = len(self.keys) > 1 and kind[self.keys[0]] == T.LongType()
        self.writer = uuid.uuid4().hex
        self._mine: dict[int, str] = {}
        self._told: dict[int, Observation] = {}

    # -- reading

    def snapshot(self) -> str | None:
        """The newest snapshot with a manifest."""
        found = [n.removesuffix(".covers") for n in self.files.names("snapshots") if n.endswith(".covers")]
        return max(found, default=None)

    def appends(self, snapshot: str | None, runs: Sequence[int] | None = None) -> list[str]:
        """Names of the appends that a snapshot doesn't cover, of some runs or all."""
        covered = set(self.files.lines(f"snapshots/{snapshot}.covers")) if snapshot else set()
        wanted = None if runs is None else {str(r) for r in runs}
        return [n for n in self.files.names("commits") if n not in covered and (wanted is None or (of := n.split("~")[2]) == "all" or wanted & set(of.split(".")))]

    def _rows(self, names: Sequence[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/log/{n}" for n in names))

    def log(self, runs: Sequence[int] | None = None, *, snapshot: str | None = "", names: Sequence[str] | None = None) -> DataFrame:
        """The rows that the state follows from, of some runs or all: the snapshot's and those of the appends beside it."""
        snapshot = self.snapshot() if snapshot == "" else snapshot
        rows = self._rows(self.appends(snapshot, runs) if names is None else names)
        if snapshot:
            kept = self.spark.read.schema(self.schema).parquet(f"{self.path}/snapshots/{snapshot}").select(*self.schema.names)
            rows = kept.unionByName(rows)
        return rows if runs is None else rows.where(F.col(self.keys[0]).isin(list(runs)))

    def last(self, log: DataFrame) -> DataFrame:
        """The state that rows of the log tell."""
        return latest(log, self.keys, F.struct("seq", "writer", "row_no")).where("not gone")

    def view(self, runs: Sequence[int] | None = None) -> DataFrame:
        return self.last(self.log(runs)).drop("gone", "writer", "row_no")

    def by_paper(self, log: DataFrame) -> DataFrame:
        """The state that rows of the log tell, dealt out once: by paper where that is a key, so what groups or joins it by paper deals nothing out again."""
        return self.last(log.repartition("paper_id") if "paper_id" in self.keys else log)

    def thin(self, log: DataFrame) -> DataFrame:
        """The state that rows of the log tell, with empty payloads; those that are null stay null."""
        return self.last(log.withColumn("payload_json", F.when(F.col("payload_json").isNotNull(), "")))

    def ordered(self) -> DataFrame:
        """The state in the order of its keys."""
        return self.view().orderBy(*self.keys)

    def others_since(self, seen: Sequence[str], runs: Sequence[int] | None = None) -> list[str]:
        """Appends of other writers that came after a list of appends was made."""
        known = set(seen)
        return [n for n in self.appends(None, runs) if n not in known and n.split("~")[1] != self.writer]

    # -- writing

    def _next(self) -> int:
        names = [*self.files.names("commits")[-1:], *(s for s in [self.snapshot()] if s)]
        return max((int(n.split("~")[0]) for n in names), default=0) + 1

    def _append(self, rows: DataFrame, status: Column | str, *, payload: Column | None = None, group: Column | None = None, error: Column | None = None, gone: bool = False, runs: Sequence[int] | None = None, observed: Mapping[str, Column] | None = None) -> int:
        """Returns the sequence number of the append, for appended() and told(). runs: the first keys that rows have, where the caller knows them."""
        seq = self._next()
        none = F.lit(None).cast("string")
        status = F.lit(status) if isinstance(status, str) else status
        given = {"status": status, "payload_json": payload, "batch_group_id": group, "error": error}
        given |= {"updated_at": F.current_timestamp(), "seq": F.lit(seq), "writer": F.lit(self.writer), "row_no": F.monotonically_increasing_id(), "gone": F.lit(gone)}
        known = {c.lower() for c in rows.columns}
        given |= {k: F.col(k) if k.lower() in known else None for k in (*self.keys, *self.carried)}
        out = rows.select(*((none if given[f.name] is None else given[f.name]).cast(f.dataType).alias(f.name) for f in self.schema))
        if observed:
            self._told[seq] = Observation()
            out = out.observe(self._told[seq], *(c.alias(n) for n, c in observed.items()))
        of = "all" if not runs or len(runs) > MOST_RUNS else ".".join(str(int(r)) for r in runs)
        name = f"{seq:012d}~{self.writer}~{of}~{uuid.uuid4().hex[:8]}"  # a try that was lost may have left its folder
        with freed(self.spark):
            out.write.parquet(f"{self.path}/log/{name}")
        self.files.put(f"commits/{name}")
        self._mine[seq] = name
        return seq

    def appended(self, seq: int) -> DataFrame:
        """The rows of an append."""
        return self._rows([self._mine[seq]] if seq in self._mine else [n for n in self.files.names("commits") if int(n.split("~")[0]) == seq])

    def told(self, seq: int) -> dict[str, int]:
        """What was observed while an append was written."""
        return self._told.pop(seq).get

    def compact(self) -> str:
        """Writes a snapshot of the state as it is now; its name. Appends that come meanwhile stand beside it; deleted keys keep their last row."""
        was = self.snapshot()
        names = self.appends(was)
        if was and not names:
            return was
        covered = [*(self.files.lines(f"snapshots/{was}.covers") if was else []), *names]
        there = set(self.files.names("commits"))
        name = f"{max(int(n.split('~')[0]) for n in [*names, was or '0']):012d}~{uuid.uuid4().hex}"
        rows = latest(self.log(snapshot=was, names=names), self.keys, F.struct("seq", "writer", "row_no"))
        rows = rows.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys)
        (rows.write.partitionBy(self.keys[0]) if self.by_run else rows.write).parquet(f"{self.path}/snapshots/{name}")
        self.files.put(f"snapshots/{name}.covers", [n for n in covered if n in there] or ["-"])
        return name

    def compact_if_long(self, most: int = MOST_APPENDS) -> None:
        if len(self.appends(self.snapshot())) > most:
            self.compact()

    def vacuum(self, older_than: float = 86_400.0) -> None:
        """Removes snapshots and appends that the newest snapshot replaces, once its manifest is so many seconds old."""
        newest = self.snapshot()
        if newest is None or self.files.age(f"snapshots/{newest}.covers") < older_than:
            return
        covered = set(self.files.lines(f"snapshots/{newest}.covers"))
        for n in self.files.names("commits"):
            if n in covered:
                self.files.remove(f"commits/{n}")
                self.files.remove(f"log/{n}")
        for n in self.files.names("snapshots"):
            if n.removesuffix(".covers") < newest:
                self.files.remove(f"snapshots/{n}")

    def _known(self, rows: DataFrame) -> DataFrame:
        return self.view().join(rows.select(*self.keys).distinct(), self.keys)

    def save(self, rows: DataFrame, status: Column | str = "done", *, runs: Sequence[int] | None = None, observed: Mapping[str, Column] | None = None) -> int:
        """rows: keys, payload_json, batch_group_id, perhaps error. Replaces whole rows, so an earlier error is gone."""
        error = F.col("error") if "error" in rows.columns else None
        return self._append(rows, status, payload=F.col("payload_json"), group=F.col("batch_group_id"), error=error, runs=runs, observed=observed)

    def save_pass1(self, rows: DataFrame) -> int:
        return self.save(rows, "pass1_done")

    def upsert_pending(self, rows: DataFrame) -> None:
        """Only keys that have no row."""
        self._append(rows.dropDuplicates(self.keys).join(self.view().select(*self.keys), self.keys, "left_anti"), "pending")

    def mark_skipped(self, rows: DataFrame, reason: str = "") -> None:
        self._append(rows, "skipped", error=F.lit(reason))

    def mark_failed(self, rows: DataFrame, error: str) -> None:
        """Only keys that have a row; the payload stays."""
        self._append(self._known(rows), "failed", payload=F.col("payload_json"), group=F.col("batch_group_id"), error=F.lit(error))

    def mark_posted(self, rows: DataFrame, *, runs: Sequence[int] | None = None, whole: bool = False) -> None:
        """Only keys that have a row. whole: rows are the state's own, so nothing is looked up."""
        self._append(rows if whole else self._known(rows), "posted", payload=F.col("payload_json"), group=F.col("batch_group_id"), error=F.col("error"), runs=runs)

    def replace_payload(self, rows: DataFrame, *, whole: bool = False, observed: Mapping[str, Column] | None = None) -> int:
        """rows: keys, payload_json. Only keys that have a row; they are done again. whole: rows are the state's own but for the payload, so nothing is looked up."""
        known = rows if whole else self._known(rows).drop("payload_json").join(rows.select(*self.keys, "payload_json"), self.keys)
        return self._append(known, "done", payload=F.col("payload_json"), group=F.col("batch_group_id"), error=F.col("error"), observed=observed)

    def reset(self, run_ids: Sequence[int]) -> None:
        """Forgets the rows of runs (the first key); no runs: nothing happens."""
        if run_ids:
            self._append(self.view().where(F.col(self.keys[0]).isin(list(run_ids))), "pending", gone=True)

    def unposted(self) -> DataFrame:
        return unposted(self.view())

    def postable(self) -> DataFrame:
        return postable(self.view())

    def pass1(self) -> DataFrame:
        return pass1(self.view())


def resolutions(spark: SparkSession, path: str) -> StateTable:
    """The state of disputed items: one row an arbiter run and item, with the item's paper and question version."""
    return StateTable(spark, path, ("arbiter_run_id", "dispute_item_id"), ("paper_id", "version_id"))


def by_paper_version(resolved: DataFrame) -> DataFrame:
    """Resolutions as states of cells: run_id, paper_id, version_id, status. A cell of several items is as complete as the last of them."""
    return latest(resolved.select(F.col("arbiter_run_id").alias("run_id"), "paper_id", "version_id", "status", "dispute_item_id"), ("run_id", "paper_id", "version_id"), "dispute_item_id")


def unposted(states: DataFrame) -> DataFrame:
    return states.where("status = 'done' and payload_json is not null")


def postable(states: DataFrame) -> DataFrame:
    return states.where("status in ('done', 'posted') and payload_json is not null")


def pass1(states: DataFrame) -> DataFrame:
    return states.where("status = 'pass1_done' and payload_json is not null")


def filtered(states: DataFrame, **ids: int | None) -> DataFrame:
    """Rows of the ids that are given (run_id=, paper_id=, ...), in the order of the keys."""
    for column, value in ids.items():
        if value is not None:
            states = states.where(F.col(column) == value)
    return states.orderBy(*(c for c in ("run_id", "paper_id", "version_id") if c in states.columns))


def regrouped(states: DataFrame) -> DataFrame:
    """Rows with group_key: their batch_group_id, or one of their own."""
    return states.withColumn("group_key", F.coalesce(F.nullif(F.col("batch_group_id"), F.lit("")), F.concat(F.lit("solo_"), F.col("version_id").cast("string"))))


class JobState(MutableMapping):
    """Names and values that outlast a session, such as the ids of submitted batches: a mapping over a StateTable of texts.

    It's read anew whenever an append has come, this one's or another's.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.table = StateTable(spark, path, ("name",), texts=("name",))
        self._seen: list[str] | None = None
        self._known: dict[str, str] = {}

    def _now(self) -> dict[str, str]:
        names = self.table.files.names("commits")
        if names != self._seen:
            self._known, self._seen = {r["name"]: r["payload_json"] for r in self.table.view().collect()}, names
        return self._known

    def _put(self, name: str, value: str | None, gone: bool = False) -> None:
        row = self.table.spark.createDataFrame([(name, value)], "name string, value string")
        self.table._append(row, "done", payload=F.col("value"), gone=gone)

    def __getitem__(self, name: str) -> str:
        return self._now()[name]

    def __setitem__(self, name: str, value: str) -> None:
        self._put(name, value)

    def __delitem__(self, name: str) -> None:
        self[name]
        self._put(name, None, gone=True)

    def __iter__(self) -> Iterator[str]:
        return iter(sorted(self._now()))

    def __len__(self) -> int:
        return len(self._now())


class SourceTexts:
    """Texts of papers that were looked up; the last lookup counts, and one that found none is a miss, to be tried again."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.table = StateTable(spark, path, ("paper_id",))

    def save(self, rows: DataFrame) -> None:
        """rows: paper_id, markdown."""
        self.table._append(rows, "done", payload=F.col("markdown"))

    def view(self) -> DataFrame:
        return self.table.view().select("paper_id", F.col("payload_json").alias("markdown"))

    def count(self) -> int:
        return self.table.view().count()
