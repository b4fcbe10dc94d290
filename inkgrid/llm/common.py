"""What the training-data operators share: cut points, cached token encoding, small column helpers."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A sort key for a missing doc_id: below every other id.
NO_ID = -(2**63)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it's unset and all of Spark runs on this machine, one beside the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and read again from the shared folder; lost executors don't matter afterwards."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, **options: str) -> tuple[DataFrame, str]:
    """As cut(), as Parquet, which compresses wide rows: the table read again, and its path for removed(). options: the writer's."""
    path = os.path.join(shared_dir(df.sparkSession), f"part-of-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Takes a table of written() away, once nothing that is still to be computed reads it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def whole(text: str | Column) -> Column:
    """A text, or the empty text for none."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), 0)


def free_name(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them as long as df has such a column."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out


#: So many rows of two numbers are sent to all executors at most; more are joined by an exchange.
SENT_ROWS = 500_000


def sent(small: DataFrame) -> DataFrame:
    """A cut table of a few numbers a row, marked for broadcast if it has SENT_ROWS at most."""
    return F.broadcast(small) if small.count() <= SENT_ROWS else small


def runs(batches, *keys: str):
    """Runs of rows with equal keys, of rows that come sorted by the keys: one pandas frame each."""
    import pandas as pd

    held = []
    for pdf in batches:
        if not len(pdf):
            continue
        same = pd.concat([pdf[k].eq(pdf[k].shift()) for k in keys], axis=1).all(axis=1).to_numpy()
        starts = [*(~same).nonzero()[0], len(pdf)]
        if not same[0] and starts[0] != 0:
            starts.insert(0, 0)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            part = pdf.iloc[a:b]
            if a == 0 and held and all(held[0][k].iloc[0] == part[k].iloc[0] for k in keys):
                held.append(part)
                continue
            if held:
                yield pd.concat(held) if len(held) > 1 else held[0]
            held = [part]
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]
