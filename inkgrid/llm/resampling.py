"""Importance resampling towards a target: rows are drawn by how much likelier their n-grams are in the target than in the corpus.

Matrix. A text's features are its runs of 1 to LONGEST words, hashed into BUCKETS buckets; the matrix has a row a document, a column a
bucket, and counts the features. Hardly any entry of a row is set, so blocks of rows are kept as compressed sparse rows: the columns of
the entries in order, their counts, and where each row starts. The blocks are Parquet in the shared folder, written once from the texts, which
nothing reads again. Sums of columns, of the corpus and of the target, are the two distributions; the gain of a bucket is the logarithm
of their smoothed ratio. The product of the matrix and the gains, over the count of a row's features, is its weight.

Draw. A weight gets Gumbel noise from a hash of the id, and the highest sums win: a draw without replacement, the same each time. Ranks
come from a sort by ranges of the sums: a row's rank is its place in its range plus the rows of the ranges before.

What a task holds: GROUP blocks (of about BLOCK entries each; one text adds BUCKETS at most), a batch of Arrow, whose bytes Spark bounds,
and one text's words. What goes through the driver: two distributions of BUCKETS numbers, and a number a range.

Nulls: a null text has no words; a null doc_id hashes as the empty text and sorts last among ties. Rows stay rows, repeated ones too, each
counted and drawn by itself (those of one id have the same noise). An empty table gives an empty result; an empty target or a bucket that
nothing hits is smoothed. Other columns are not read. A very long text takes memory for its words and features once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BUCKETS, LONGEST = 10_000, 2
#: Entries of a block, about; blocks of a row group. Spark's reader holds a row group's blocks at once, and its writer those that it collects.
BLOCK, GROUP = 100_000, 16
#: The draw: the share of the rows that have LEAST words, in per cent, and the seed of the noise.
SHARE, LEAST, SEED = 25, 20, 7
#: A gain is in thousandths.
UNIT = 1000

_OTHER = bytes(b for b in range(128) if not (48 <= b < 58 or 97 <= b < 123 or 65 <= b < 91))
_AS_WORDS = bytes.maketrans(_OTHER + bytes(range(65, 91)), b" " * len(_OTHER) + bytes(range(97, 123)))


def words(text: bytes | None) -> list[bytes]:
    """ASCII capitals in lower case, cut at what is neither an ASCII letter or digit nor beyond ASCII."""
    return (text or b"").translate(_AS_WORDS).split()


def features(said: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each run of 1 to longest words. A run's checksum goes on from that of the run without its last word."""
    sums, out = list(map(crc32, said)), []
    spaced = [b" " + w for w in said]
    for n in range(1, longest + 1):
        if n > 1:
            sums = list(map(crc32, spaced[n - 1 :], sums))
        out.append(np.array(sums, np.uint32) % np.uint32(buckets))
    return np.concatenate(out)


ROWS = "block long, ids array<bigint>, n_words array<bigint>, n_features array<bigint>, starts binary, columns binary, counts binary"


def _column_type(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 2**16 else "<u4")


def csr_blocks(texts: Iterable[tuple[int | None, bytes | None]], first: int = 0, longest: int = LONGEST, buckets: int = BUCKETS) -> Iterator[dict]:
    """Rows of ROWS, of the texts in their order, numbered from `first`."""
    kind = _column_type(buckets)

    def block() -> dict:
        return {
            "block": number, "ids": ids, "n_words": n_words, "n_features": n_features, "starts": np.array(starts, "<i8").tobytes(),
            "columns": b"".join(columns), "counts": b"".join(counts),
        }

    number, ids, n_words, n_features, starts, columns, counts = first, [], [], [], [0], [], []
    for i, text in texts:
        said = words(text)
        # of 16-bit numbers a stable sort is one by digits
        hit = np.sort(features(said, longest, buckets).astype(kind), kind="stable")
        at = np.flatnonzero(np.concatenate([[True], hit[1:] != hit[:-1]])) if hit.size else np.zeros(0, np.int64)
        ids.append(i)
        n_words.append(len(said))
        n_features.append(hit.size)
        columns.append(hit[at].tobytes())
        counts.append(np.diff(at, append=hit.size).astype("<u4").tobytes())
        starts.append(starts[-1] + at.size)
        if starts[-1] >= BLOCK:
            yield block()
            number, ids, n_words, n_features, starts, columns, counts = number + 1, [], [], [], [0], [], []
    if ids:
        yield block()


@dataclass(frozen=True)
class Matrix:
    """Documents by buckets, as blocks of compressed sparse rows in the shared folder."""

    blocks: DataFrame
    path: str
    buckets: int = BUCKETS

    @staticmethod
    def build(docs: DataFrame, id_col: Column, text_col: Column, *, longest: int = LONGEST, buckets: int = BUCKETS) -> Matrix:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            texts = (x for b in batches for x in zip(b.column("id").to_pylist(), b.column("text"), strict=True))
            for row in csr_blocks(((i, t.as_py()) for i, t in texts), TaskContext.get().partitionId() << 32, longest, buckets):
                yield pa.RecordBatch.from_pylist([row], schema=_ROWS_ARROW)

        texts = docs.select(id_col.cast("long").alias("id"), text_col.cast("string").cast("binary").alias("text"))
        return Matrix(*common.written(texts.mapInArrow(run, ROWS), **{"compression": "zstd", "parquet.block.row.count.limit": str(GROUP)}), buckets)

    def column_sums(self) -> np.ndarray:
        """The sum of each column: each task's sums, then theirs."""
        buckets, kind = self.buckets, _column_type(self.buckets)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(buckets, np.int64)
            for b in batches:
                for c, n in zip(b.column("columns"), b.column("counts"), strict=True):
                    # counts stay below 2**53 in a block
                    total += np.bincount(np.frombuffer(c.as_py(), kind), np.frombuffer(n.as_py(), "<u4"), minlength=buckets).astype(np.int64)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

        sums = self.blocks.select("columns", "counts").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
        out = np.zeros(self.buckets, np.int64)
        for r in sums.collect():  # of `buckets` rows at most
            out[r["bucket"]] = r["n"]
        return out

    def times(self, vector: np.ndarray) -> DataFrame:
        """Each row's product with a vector of whole numbers: block, row (its place there), id, n_words, n_features, product."""
        vector, kind = np.asarray(vector, np.int64), _column_type(self.buckets)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in b.to_pylist():
                    parts = vector[np.frombuffer(r["columns"], kind)] * np.frombuffer(r["counts"], "<u4")
                    so_far, starts = np.concatenate([[0], np.cumsum(parts)]), np.frombuffer(r["starts"], "<i8")
                    n = len(r["ids"])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(n, r["block"]), pa.int64()), pa.array(np.arange(n), pa.int32()), pa.array(r["ids"], pa.int64()), pa.array(r["n_words"], pa.int64()),
                        pa.array(r["n_features"], pa.int64()), pa.array(so_far[starts[1:]] - so_far[starts[:-1]], pa.int64()),
                    ], ["block", "row", "id", "n_words", "n_features", "product"])

        return self.blocks.mapInArrow(run, "block long, row int, id long, n_words long, n_features long, product long")


_ROWS_ARROW = pa.schema([
    ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())), ("n_features", pa.list_(pa.int64())),
    ("starts", pa.binary()), ("columns", pa.binary()), ("counts", pa.binary()),
])


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, by its counts: the logarithm of its share of the target over that of the corpus, in thousandths, each count one more."""
    s, t, n = corpus.astype(float), target.astype(float), float(corpus.size)
    return np.floor(UNIT * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def noise(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 8 hexadecimal digits of a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-UNIT * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, *order: Column) -> tuple[DataFrame, str]:
    """rows with rank, from 1, in the order of columns that leave no ties: sorted by ranges, each range counted. Written; its path too."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    part = F.spark_partition_id()
    placed, path = common.written(placed.withColumns({"__part": part, "__at": F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33) + 1}))
    below, before = [], 0
    for r in placed.groupBy("__part").count().orderBy("__part").collect():  # a row a range
        below.append((r["__part"], before))
        before += r["count"]
    offsets = rows.sparkSession.createDataFrame(below, "__part int, __below long")
    return placed.join(F.broadcast(offsets), "__part").withColumn("rank", F.col("__at") + F.col("__below")).drop("__part", "__at", "__below"), path


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", *,
    share: int = SHARE, least: int = LEAST, seed: int = SEED, longest: int = LONGEST, buckets: int = BUCKETS,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row; rank is null where a row isn't among the share that is drawn."""
    spark = docs.sparkSession
    matrix = Matrix.build(docs, F.col(id_col), F.col(text_col), longest=longest, buckets=buckets)
    wanted = Matrix.build(target, F.lit(0), F.col(target_col), longest=longest, buckets=buckets)
    gain = gains(matrix.column_sums(), wanted.column_sums())
    weight = F.expr("coalesce((product - pmod(product, nullif(n_features, 0))) div nullif(n_features, 0), 0)")
    rows = matrix.times(gain).withColumnRenamed("id", "doc_id").withColumn("weight", weight).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).drop("product")
    rows, scored = common.written(rows)
    common.removed(spark, matrix.path)
    common.removed(spark, wanted.path)
    able = F.col("n_words") >= least
    drawn = rows.where(able).count() * share // 100
    told, _ = ranked(rows, F.desc(able), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("block"), F.asc("row"))
    common.removed(spark, scored)
    told = told.withColumn("rank", F.when(able & (F.col("rank") <= drawn), F.col("rank")))
    return told.select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {"op11_resampling": op11_resampling}
#: The same rows in DuckDB, which has no crc32: its table of 256 steps and its rounds over a feature's bytes are written out.
ORACLES = {
    "op11_resampling": r"""
with tab as (select list(c order by i) as t from (select i, list_reduce(list_prepend(i, [0,0,0,0,0,0,0,0]::bigint[]), lambda c, z: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as c from (select unnest(range(256)) as i))),
d as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
df as (select doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f from d),
bf as (select unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f from b),
dn as (select doc_id, f, count(*) as n from df group by all),
bn as (select f, count(*) as n from bf group by all),
u as (select f, hex(encode(f)) as h from (select distinct f from dn union select f from bn)),
k as (select f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h) + 1, 2), lambda i: (instr('0123456789ABCDEF', h[i]) - 1) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 1)), lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) % 10000 as bucket from u, tab),
s as (select bucket, sum(n) as n from dn join k using (f) group by all),
t as (select bucket, sum(n) as n from bn join k using (f) group by all),
g as (select bucket, floor(1000 * ln((coalesce(t.n, 0)::double + 1) * ((select sum(n) from s)::double + 10000) / ((coalesce(s.n, 0)::double + 1) * ((select sum(n) from t)::double + 10000))))::bigint as gain from s full join t using (bucket)),
wt as (select doc_id, sum(n)::bigint as n_features, floor(sum(n * gain)::double / sum(n)::double)::bigint as weight from dn join k using (f) join g using (bucket) group by all),
x as (select d.doc_id, len(d.w) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight, ('0x' || substring(sha256('7:' || d.doc_id), 1, 8))::bigint as h from d left join wt using (doc_id)),
y as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score from x),
r as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from y where n_words >= 20)
select y.doc_id, n_features, weight, score, case when place <= 25 * n // 100 then place end as rank from y left join r using (doc_id)
"""
}
