"""Near-duplicate embeddings by rotated binary codes with correction factors.

A random rotation (fixed by the dimension) turns a unit vector o into P o; its code is the signs, its factor
f = sum |P o| / sqrt(D). For another unit vector q whose rotated components are rounded at random to QUERY_BITS bits,
<signs / sqrt(D), P q> / f is an unbiased estimate of <o, q>, computed by counting bits; it errs by more than
EPSILON sqrt((1 - f^2) / (f^2 (D - 1))) hardly ever. Pairs whose estimate plus that bound reaches the threshold are
computed exactly, in double precision; all others are done.

Which pairs are estimated: signs of further rotations make TABLES keys of `bits` bits each; vectors meet where they
share a key. A pair at the threshold shares a bit with probability 1 - acos(t) / pi, and tables are added until
such a pair is missed with probability MISS at most; closer pairs are missed far less. bits grows with the number of
vectors so that a bucket holds about BUCKET; the work then grows much slower than the number of pairs. A bucket over SPLIT
rows is split into parts, and pairs of parts are compared in tasks of their own. No pair leaves its task: only
counts and the links of a spanning forest do.

A pair that shares several keys belongs to the first table in which it does. Keys come from sums of whole numbers, exact in
doubles in any order, so they can be found again for the few vectors of verified pairs and needn't travel with all.

Equal vectors are one class, compared once. There is a result for each row, also of repeated ids (rows of their own) and of
none (a component's smallest id is that of its rows with one; null if it has none). Nulls: a vector that is null, zero or holds null or
non-finite numbers links with nothing; vectors of different lengths don't link. An empty table gives an empty result.
Other columns are not read. Very long vectors only make wider rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, graphs

THRESHOLD = 0.9
EPSILON = 4.0
QUERY_BITS = 4
MISS = 1e-3
BUCKET, SPLIT = 512, 2000
WORD = 64
#: Components of unit vectors and rotations are whole numbers of 1 / GRID where keys are made.
GRID = float(2**22)


def rotation(dim: int, number: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def shape(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """bits of a key and tables, for n vectors."""
    bits = max(4, min(30, round(math.log2(max(n, 1) / BUCKET)))) if n > BUCKET else 4
    met = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - met))


def _words(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    pad = -signs.shape[1] % WORD
    return np.packbits(np.pad(signs, ((0, 0), (0, pad))), axis=1, bitorder="little").view("<u8")


_rotations: dict[tuple[int, int], np.ndarray] = {}


def _turn(dim: int, number: int) -> np.ndarray:
    if (dim, number) not in _rotations:
        _rotations[dim, number] = rotation(dim, number)
    return _rotations[dim, number]


def keys_of(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The keys of unit vectors, a column a table."""
    dim, need = unit.shape[1], bits * tables
    whole = np.rint(unit * GRID)
    signs = np.concatenate([whole @ np.rint(_turn(dim, k) * GRID).T >= 0 for k in range(1, 1 + -(-need // dim))], 1)
    return signs[:, :need].reshape(len(unit), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


_CODED = "row long, vec long, dim int, name string, data binary, code binary, factor double, keys array<long>"


def _coded(bits: int, tables: int, kind: str):
    """Rows by number, with the code, the factor and the keys of each vector that can link; the others have no name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task = TaskContext.get()
        start = (task.partitionId() if task else 0) << 33
        for pdf in batches:
            pdf = pdf.assign(row=np.arange(start, start + len(pdf)), vec=pdf["vec"].astype("Int64"))
            start += len(pdf)
            good, raw = [], []
            for i, e in enumerate(pdf["embedding"]):
                if e is not None and len(e):
                    v = np.array([math.nan if y is None else y for y in e], np.float64)
                    if np.isfinite(v).all() and v.any() and math.isfinite(float(v @ v)) and float(v @ v) > 0:
                        good.append(i)
                        raw.append(v)
            bad = np.setdiff1d(np.arange(len(pdf)), good)
            yield pdf.iloc[bad][["row", "vec"]].assign(dim=0, name=None, data=None, code=None, factor=0.0, keys=None)
            for dim in sorted({v.size for v in raw}):
                here = [k for k, v in enumerate(raw) if v.size == dim]
                x = np.stack([raw[k] for k in here])
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                turned = unit @ _turn(dim, 0).T
                out = pdf.iloc[[good[k] for k in here]][["row", "vec"]].reset_index(drop=True)
                data = x.astype(kind)
                out["dim"], out["name"] = dim, [f"{dim}:{xxhash.xxh128_hexdigest((d + 0.0).tobytes())}" for d in data]
                out["data"], out["code"] = [d.tobytes() for d in data], [c.tobytes() for c in _words(turned >= 0)]
                out["factor"] = np.abs(turned).sum(1) / math.sqrt(dim)
                out["keys"] = list(keys_of(_unit(data.astype(np.float64)), bits, tables))
                yield out

    return run


def _unit(x: np.ndarray) -> np.ndarray:
    return np.stack([v / math.sqrt(float((v * v).sum())) for v in x])


class Codes:
    """Vectors of one bucket, ready to be estimated against each other."""

    def __init__(self, pdf: pd.DataFrame, kind: str) -> None:
        self.x = np.stack([np.frombuffer(d, kind) for d in pdf["data"]]).astype(np.float64)
        self.norms = np.linalg.norm(self.x, axis=1)
        self.code = np.stack([np.frombuffer(c, "<u8") for c in pdf["code"]])
        self.factor = pdf["factor"].to_numpy()
        self.dim = self.x.shape[1]
        self.bound = EPSILON * np.sqrt(np.maximum(0, 1 - self.factor**2) / (self.factor**2 * max(1, self.dim - 1)))

    def queries(self, rows: slice, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bit planes of rotated unit vectors, rounded at random; their lowest values and steps."""
        q = (self.x[rows] / self.norms[rows, None]) @ _turn(self.dim, 0).T
        low = q.min(1, keepdims=True)
        step = np.maximum((q.max(1, keepdims=True) - low) / (2**QUERY_BITS - 1), 1e-12)
        level = np.minimum(np.floor((q - low) / step + draw.random(q.shape)).astype(np.int64), 2**QUERY_BITS - 1)
        return np.stack([_words((level >> b & 1).astype(bool)) for b in range(QUERY_BITS)]), low[:, 0], step[:, 0]

    def estimates(self, rows: slice, draw: np.random.Generator) -> np.ndarray:
        """Estimated cosines of rows with all vectors: <signs, q> = 2 (sum of q where the code has a one) - sum of q."""
        planes, low, step = self.queries(rows, draw)
        ones = np.bitwise_count(self.code).sum(1, dtype=np.int64)
        inside = sum((np.bitwise_count(planes[b][:, None, :] & self.code[None]).sum(2, dtype=np.int64) << b) for b in range(QUERY_BITS))
        total = sum(np.bitwise_count(planes[b]).sum(1, dtype=np.int64) << b for b in range(QUERY_BITS))
        with_one = low[:, None] * ones[None] + step[:, None] * inside
        return (2 * with_one - (low * self.dim + step * total)[:, None]) / math.sqrt(self.dim) / self.factor[None]


def _compare(threshold: float, kind: str, bits: int, tables: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in common.runs(batches, "table", "key", "cell"):
            if len(g) < 2:
                continue
            codes, draw = Codes(g, kind), np.random.default_rng(1)
            row, size, slot, cell, table = g["row"].to_numpy(), g["size"].to_numpy(), g["slot"].to_numpy(), g["cell"].iloc[0], int(g["table"].iloc[0])
            across = cell // 2**20 != cell % 2**20
            links = np.zeros(len(g), np.int64)
            root = np.arange(len(g))
            forest = []

            def top(i: int, root: np.ndarray = root) -> int:
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for a in range(0, len(g), 256):
                rows = slice(a, min(a + 256, len(g)))
                i, j = np.nonzero(codes.estimates(rows, draw) + codes.bound[None] >= threshold)
                i += a
                keep = (i < j) & ((slot[i] != slot[j]) if across else True)
                i, j = i[keep], j[keep]
                for b in range(0, i.size, 65536):
                    x, y = i[b : b + 65536], j[b : b + 65536]
                    hit = np.einsum("ij,ij->i", codes.x[x], codes.x[y]) / (codes.norms[x] * codes.norms[y]) >= threshold
                    x, y = x[hit], y[hit]
                    if table and x.size:  # other tables leave a pair to its first
                        some, at = np.unique(np.concatenate([x, y]), return_inverse=True)
                        keys = keys_of(_unit(codes.x[some]), bits, table + 1)
                        first = (keys[at[: x.size]] == keys[at[x.size :]]).argmax(1) == table
                        x, y = x[first], y[first]
                    np.add.at(links, x, size[y])
                    np.add.at(links, y, size[x])
                    for p, q in zip(x.tolist(), y.tolist(), strict=True):
                        if (s := top(p)) != (t := top(q)):
                            root[max(s, t)] = min(s, t)
                            forest.append((row[p], 0, row[q]))
            some = links.nonzero()[0]
            yield pd.DataFrame([*((row[k], links[k], None) for k in some), *forest], columns=["row", "links", "other"]).astype({"row": "int64", "links": "int64", "other": "Int64"})

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """vec, n_links, component of every row."""
    item = vectors.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(item, T.FloatType) else "<f8"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec"), F.col(vector_col).cast(T.ArrayType(item if kind == "<f4" else T.DoubleType())).alias("embedding"))
    bits, tables = shape(rows.count(), threshold)
    coded, coded_path = common.written(rows.mapInPandas(_coded(bits, tables, kind), _CODED))
    named = coded.where("name is not null")
    classes = named.groupBy("name").agg(F.min("row").alias("first"), F.count("*").alias("size"), F.min("vec").alias("least"))
    members = common.cut(coded.select("row", "vec", "name").join(classes, "name", "left").select("row", "vec", "first", "size", "least"))
    leads = common.cut(members.where("row = first and size > 1").select("row", "size"))
    copies = common.cut(members.where("row <> first").select(F.col("row").alias("gone")))
    alone = named.join(common.sent(copies), F.col("row") == F.col("gone"), "left_anti").join(common.sent(leads), "row", "left").withColumn("size", F.coalesce("size", F.lit(1)))

    met = alone.select("row", "size", "dim", "data", "code", "factor", F.posexplode("keys").alias("table", "key"))
    met = met.withColumn("key", F.xxhash64("dim", "key")).drop("dim")
    counts = named.select("dim", F.posexplode("keys").alias("table", "key")).groupBy("dim", "table", "key").agg(F.count("*").alias("n")).where(F.col("n") > SPLIT)
    large = common.cut(counts.select("table", F.xxhash64("dim", "key").alias("key"), F.ceil(F.col("n") / SPLIT).alias("parts")))
    met = met.join(common.sent(large), ["table", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    met = met.withColumn("slot", F.pmod(F.xxhash64("row", F.lit(3)), F.col("parts")))
    cells = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda o: F.least(o, F.col("slot")) * 2**20 + F.greatest(o, F.col("slot")))
    met = met.withColumn("cell", F.explode(cells)).drop("parts")
    met = met.repartition("table", "key", "cell").sortWithinPartitions("table", "key", "cell")
    found = common.cut(met.mapInPandas(_compare(threshold, kind, bits, tables), "row long, links long, other long"))
    common.removed(vectors.sparkSession, coded_path)
    links = found.groupBy("row").agg(F.sum("links").alias("links")).withColumnRenamed("row", "first")
    comps = graphs.components(found.where("other is not null").select(F.col("row").alias("a"), F.col("other").alias("b"))).withColumnsRenamed({"node": "first", "component": "comp"})
    told = members.where("row = first").select("first", "least").join(links, "first", "left").join(comps, "first", "left").withColumn("comp", F.coalesce("comp", "first"))
    smallest = told.groupBy("comp").agg(F.min("least").alias("component"))
    told = common.cut(told.join(smallest, "comp").select("first", "links", "component"))
    out = members.join(told, "first", "left")
    return out.select("vec", F.coalesce(F.col("size") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"), F.when(F.col("first").isNull(), F.col("vec")).otherwise(F.col("component")).alias("component"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(common.read(spark, sf_dir, "embeddings"))
    return rows.select(F.col("vec").alias("vec_id"), "n_links", F.col("component").alias("component_id"), F.col("vec").eqNullSafe(F.col("component")).alias("kept"))


QUERIES = {"op6_embeddings": op6_embeddings}
#: The same rows in DuckDB, by every pair of vectors.
ORACLES = {
    "op6_embeddings": r"""
with recursive v as (select vec_id, embedding::double[] as x from embeddings),
f as (select vec_id, x, sqrt(list_sum(list_transform(x, lambda y: y * y))) as n from v where x is not null and list_count(x) = len(x) and len(list_filter(x, lambda y: isfinite(y))) = len(x)),
e as (select a.vec_id as a, b.vec_id as b from f a join f b on a.vec_id < b.vec_id where a.n > 0 and b.n > 0 and list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.9),
l as (select a, b from e union all select b, a from e),
r as (select vec_id, vec_id as c from embeddings union select r.vec_id, l.b from r join l on l.a = r.c),
d as (select a as vec_id, count(*) as n from l group by a)
select r.vec_id, coalesce(any_value(d.n), 0)::bigint as n_links, min(r.c) as component_id, r.vec_id = min(r.c) as kept from r left join d using (vec_id) group by r.vec_id
"""
}
