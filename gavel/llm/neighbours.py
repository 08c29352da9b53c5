"""Nearest neighbours on shifted space-filling curves (operator 10).

Vectors are projected by a random rotation of their own for every curve and put,
shifted, on a Hilbert curve. Each curve is cut into key ranges by quantiles of a
bounded sample; a query meets the vectors of its own range and of the two beside
it, in numpy blocks that score by cosine in double precision, and the best of
all curves merge. Every vector is on every curve: nothing is left out.

Equal vectors are one point with its few smallest ids, so copies neither fill a
range nor are compared with each other. Ranges are shares of all vectors (the
share sets the recall) and are split by hash into groups of bounded size.

Neighbours of unstructured high-dimensional vectors are hardly nearer than other
vectors; to keep a recall there any index has to look at a fixed share of the
data, and so does this one: `ranges` is a number, not a size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavel.llm.tables import stored


@dataclass(frozen=True)
class CurveParams:
    nearest: int = 5
    curves: int = 16
    dimensions: int = 16  # of a projection
    ranges: int = 36  # key ranges of a curve; a query sees three of them
    least: int = 512  # points a range has at least, on average
    sample: int = 4096  # vectors that rotations' scales and range bounds are fitted on
    group: int = 4096  # points or queries that meet in one group, about
    seed: int = 7


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of every row of cells (integers under 2**bits) on the Hilbert curve, as a 64-bit key.

    Gray-code form: exchanges and inversions turn coordinates into the
    transposed key, whose bits are then interleaved.
    """
    x = cells.astype(np.int64).copy()
    d = x.shape[1]
    top = 1 << (bits - 1)
    level = top
    while level > 1:
        low = level - 1
        for i in range(d):
            high = (x[:, i] & level) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            x[:, i] ^= swap
        level >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    level = top
    while level > 1:
        flip ^= np.where(x[:, -1] & level, level - 1, 0)
        level >>= 1
    x ^= flip[:, None]
    key = np.zeros(len(x), np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << np.uint64(1) | (x[:, i] >> b & 1).astype(np.uint64)
    return key


class Curves:
    """Rotations, scales, shifts and range bounds, fitted on a sample of vectors."""

    def __init__(self, sample: np.ndarray, params: CurveParams) -> None:
        random = np.random.default_rng(params.seed)
        size = sample.shape[1]
        self.d = min(params.dimensions, size)
        self.bits = min(16, 64 // self.d)
        unit = self._unit(sample)
        self.turn, self.low, self.span, self.shift, self.bounds = [], [], [], [], []
        for _ in range(params.curves):
            self.turn.append(np.linalg.qr(random.normal(size=(size, size)))[0][:, : self.d])
            seen = unit @ self.turn[-1]
            low, high = np.quantile(seen, [0.01, 0.99], axis=0)
            self.low.append(low)
            self.span.append(np.maximum(high - low, 1e-12))
            self.shift.append(random.random(self.d) * 0.5)
            key = np.sort(self._key(unit, len(self.turn) - 1))
            self.bounds.append(key[np.arange(1, params.ranges) * len(key) // params.ranges])

    @staticmethod
    def _unit(vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)

    def _key(self, unit: np.ndarray, curve: int) -> np.ndarray:
        place = (unit @ self.turn[curve] - self.low[curve]) / self.span[curve]
        cells = np.clip((place + self.shift[curve]) / 1.5 * (1 << self.bits), 0, (1 << self.bits) - 1)
        return hilbert(cells.astype(np.int64), self.bits)

    def ranges(self, vectors: np.ndarray) -> Iterator[np.ndarray]:
        """The range of every vector on each curve."""
        unit = self._unit(vectors)
        for curve in range(len(self.turn)):
            yield np.searchsorted(self.bounds[curve], self._key(unit, curve), side="right")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, vec of the rows that take part, one a vec_id."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where("vec_id is not null and embedding is not null").where(fine & F.exists("embedding", lambda x: x != 0))
    return rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("vec"))


def points_of(usable: DataFrame, ids: int) -> DataFrame:
    """point, vec, ids: one row a distinct vector; point is its least id, ids its smallest ones."""
    copies = Window.partitionBy("vec").orderBy("vec_id")
    few = usable.withColumn("at", F.row_number().over(copies)).where(F.col("at") <= ids)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("point"), "vec", "ids"
    )


def nearest(vectors: DataFrame, every: int = 50, params: CurveParams = CurveParams()) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id is divisible by `every`, against all rows.

    Rows with a null id or vector, a null or non-finite component, or a zero
    vector take no part, nor do vectors of another length than most. A
    repeated id counts once, with its least vector. Ties go to the smaller
    vec_id. With fewer candidates than asked for all are returned; an empty
    table gives an empty result.
    """
    spark = vectors.sparkSession
    keep = params.nearest + 1  # the query's own vector is among them
    usable = stored(usable_vectors(vectors), "usable")
    points = points_of(usable, keep)
    size = usable.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    result = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return spark.createDataFrame([], result)
    points = points.where(F.size("vec") == size["size"])
    asked = usable.where((F.col("vec_id") % every == 0) & (F.size("vec") == size["size"]))
    asking = asked.select("vec").distinct().withColumn("asked", F.lit(True))
    points = stored(points.join(asking, "vec", "left").withColumn("asked", F.coalesce("asked", F.lit(False))), "points")
    total, queries = points.agg(F.count("*"), F.count_if("asked")).first()
    # Bounded: `sample` vectors, the first by hash.
    sample = np.array([r.vec for r in points.orderBy(F.xxhash64("point"), "point").limit(params.sample).select("vec").collect()], np.float64)
    if not len(sample):
        return spark.createDataFrame([], result)
    params = replace(params, ranges=max(1, min(params.ranges, total // params.least)))
    curves = Curves(sample, params)
    splits = -(-total // (params.ranges * params.group))
    query_splits = -(-3 * queries // (params.ranges * params.group)) or 1
    number = points.schema["vec"].dataType.simpleString()
    names = ["curve", "range", "split", "query_split", "is_query", "point", "vec"]
    placed = f"curve int, range int, split int, query_split int, is_query boolean, point long, vec {number}"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch, which, curve, at, split, query_split, is_query):
            n = len(which)
            fill = lambda v: pa.array(np.broadcast_to(v, n).astype(np.int32))
            picked = batch.take(pa.array(which))
            return pa.RecordBatch.from_arrays(
                [fill(curve), pa.array(at.astype(np.int32)), fill(split), fill(query_split), pa.array(np.full(n, is_query)),
                 picked.column("point"), picked.column("vec")], names,
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("point").to_numpy()
            every_one = np.arange(len(ids))
            asks = np.flatnonzero(batch.column("asked").to_numpy(zero_copy_only=False))
            for curve, at in enumerate(curves.ranges(_matrix(batch.column("vec")))):
                for q in range(query_splits):
                    yield rows(batch, every_one, curve, at, ids % splits, q, False)
                for side in (-1, 0, 1):
                    near = at[asks] + side
                    ok = (near >= 0) & (near < params.ranges)
                    which = asks[ok]
                    for s in range(splits):
                        yield rows(batch, which, curve, near[ok], s, ids[which] // every % query_splits, True)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        is_query = table.column("is_query").combine_chunks().to_numpy(zero_copy_only=False)
        if not is_query.any() or is_query.all():
            return
        ids = table.column("point").combine_chunks().to_numpy()
        vec = _matrix(table.column("vec").combine_chunks())
        order = np.flatnonzero(~is_query)[np.argsort(ids[~is_query], kind="stable")]
        own, at = vec[order], ids[order]
        unit = Curves._unit(own)
        asks = np.flatnonzero(is_query)
        for a in range(0, len(asks), 512):
            part = asks[a : a + 512]
            rough = Curves._unit(vec[part]) @ unit.T
            n = min(keep + 4, len(at))
            # A few more than asked for, scored exactly, so rounding of the product decides nothing.
            top = np.argpartition(-rough, n - 1, axis=1)[:, :n] if n < len(at) else np.tile(np.arange(n), (len(part), 1))
            score = _cosine(vec[part][:, None, :], own[top])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids[part], n)), pa.array(at[top].reshape(-1)), pa.array(score.reshape(-1))], ["query", "point", "score"]
            )

    found = (
        points.select("point", "vec", "asked").mapInArrow(place, placed)
        .groupBy("curve", "range", "split", "query_split")
        .applyInArrow(lambda table: pa.Table.from_batches(list(best(table.to_batches())) or [_nothing()]), "query long, point long, score double")
        .groupBy("query", "point").agg(F.max("score").alias("score"))
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    found = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= keep)
    # Ties between points need all their ids before the cut; both lists have `keep` entries at most.
    lists = (
        found.join(points.select("point", "ids"), "point")
        .groupBy("query")
        .agg(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("far"), i.alias("vec_id"))))).alias("all"))
        .select("query", F.slice(F.sort_array("all"), 1, keep).alias("all"))
    )
    named = asked.join(points.select("vec", F.col("point").alias("query")), "vec").select(F.col("vec_id").alias("query_id"), "query")
    answers = named.join(lists, "query").select(
        "query_id", F.posexplode(F.slice(F.filter("all", lambda x: x["vec_id"] != F.col("query_id")), 1, params.nearest)).alias("at", "x")
    )
    return answers.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.far")).alias("score"))


def _nothing() -> pa.RecordBatch:
    empty = pa.array([], pa.int64())
    return pa.RecordBatch.from_arrays([empty, empty, pa.array([], pa.float64())], ["query", "point", "score"])
