"""Approximate nearest neighbours by collision counting with virtual rehashing.

Every vector is projected on fixed lines, and each line keeps its vectors sorted. A query opens a window around its own
place on every line and walks outward: what a wider window adds on a line is counted, and nothing is looked at twice. A
vector in the windows of enough lines has collided. Windows widen level by level (virtual rehashing: no table is built
anew) until enough vectors collided, and those are verified exactly in double precision. Largest inner product becomes
smallest distance by one added dimension, sqrt(M^2 - |x|^2) with M the largest norm; for projections only, vectors
are divided by the largest component, so no square over- or underflows.

The index is built once and stored: blocks of BLOCK vectors with their order on each line. Queries, packed in chunks of
QUERIES, are shuffled to the blocks; a task holds one block and one chunk at a time, and each block answers with its k
best, which are merged by query. Odd input: vectors that are null, empty, zero or hold null or non-finite components
take no part, every other one does; only vectors of one dimension are compared; repeated rows are candidates of their
own, but rows with the query's id are none; a repeated query row is asked once, and two vectors under one id are
answered together; ties go to the smaller id; with fewer candidates than asked for, all are returned; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintora.llm._io import small_batches, stored, trim

#: Vectors indexed together; places on a line fit 16 bits.
BLOCK = 16_384
#: Queries shuffled together.
QUERIES = 1024
LINES = 64
#: Share of the lines on which a vector must fall into the window.
COLLISIONS = 0.75
#: Half width of the first window in standard deviations of the projections, and its growth.
FIRST, GROWTH = 1.15, 1.15
#: A block's windows widen until this share of its vectors collided, and at least as many as asked for.
VERIFY = 0.2

INDEX = "block long, dimension int, ids binary, vectors binary, orders binary"
CHUNK = "dimension int, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score double"


def lines(dimension: int, count: int = LINES) -> np.ndarray:
    """Fixed directions, orthogonal in groups of `dimension`."""
    rng = np.random.default_rng(20_240_229)
    bases = [np.linalg.qr(rng.standard_normal((dimension, dimension)))[0] for _ in range(-(-count // dimension))]
    return np.concatenate(bases)[:count]


def _places(vectors: np.ndarray, scale: float, most: float, asked: bool = False) -> np.ndarray:
    """Places on the lines, line by line. most: the largest scaled norm of the vectors.

    Vectors get the added dimension. Queries, which have none, are brought to that norm: a query's length changes
    no order of inner products, and a short one would lie about as far from every vector.
    """
    if asked:
        v = vectors / np.abs(vectors).max(1, keepdims=True)
        v, rest = v * (most / np.sqrt((v * v).sum(1, keepdims=True))), np.zeros(len(v))
    else:
        v = vectors / scale
        rest = np.sqrt(np.maximum(most * most - (v * v).sum(1), 0))
    return np.ascontiguousarray((np.concatenate([v, rest[:, None]], 1) @ lines(v.shape[1] + 1).T).T)


class Block:
    """Some vectors and their order on each line."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, scale: float, most: float, orders: np.ndarray | None = None):
        self.ids, self.vectors, self.scale, self.most = ids, vectors, scale, most
        places = _places(vectors, scale, most)
        self.orders = np.argsort(places, 1, kind="stable").astype(np.uint16) if orders is None else orders
        self.sorted = np.take_along_axis(places, self.orders.astype(np.int64), 1)
        self.unit = max(float(places.std()), 1e-12)

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query id, ids, scores) of the nearest vectors found for each query."""
        n, count = len(self.ids), len(self.sorted)
        need, hits = min(n, k + 1 + int(VERIFY * n)), int(np.ceil(COLLISIONS * count))
        at = _places(queries, self.scale, self.most, asked=True)
        spread = float(np.abs(self.sorted).max() + np.abs(at).max()) + 1
        widths = [FIRST * self.unit]
        while widths[-1] < spread:
            widths.append(widths[-1] * GROWTH)
        # the last window holds everything, also where rounding would leave a vector out
        edge: dict[int, tuple[list, list]] = {len(widths) - 1: ([[0] * count] * len(queries), [[n] * count] * len(queries))}

        def edges(level: int) -> tuple[list, list]:
            """Where each query's window begins and ends on each line."""
            if level not in edge:
                low = np.stack([np.searchsorted(s, a - widths[level], "left") for s, a in zip(self.sorted, at)], 1)
                high = np.stack([np.searchsorted(s, a + widths[level], "right") for s, a in zip(self.sorted, at)], 1)
                edge[level] = low.tolist(), high.tolist()
            return edge[level]

        for q in range(len(queries)):
            seen = np.zeros(n, np.int64)
            before = None
            for level in range(len(widths)):
                low, high = (e[q] for e in edges(level))
                if before is None:
                    added = [o[a:b] for o, a, b in zip(self.orders, low, high)]
                else:
                    added = [part for o, a, b, c, d in zip(self.orders, low, *before, high) for part in (o[a:b], o[c:d])]
                before = low, high
                seen += np.bincount(np.concatenate(added), minlength=n)
                found = np.flatnonzero(seen >= hits)
                if len(found) >= need:
                    break
            found = found[self.ids[found] != ids[q]]
            with np.errstate(over="ignore", invalid="ignore"):
                rough = self.vectors[found] @ queries[q]
                if len(found) > k and np.isfinite(rough).all():  # ties at the edge stay in until ids are compared
                    slack = 1e-9 * (np.abs(rough).max() + 1)
                    found = found[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - slack]
                # summed row by row: equal vectors get equal scores wherever they lie, which a matrix product doesn't promise
                score = (self.vectors[found] * queries[q]).sum(1)
            best = np.lexsort((self.ids[found], -score))[:k]
            yield int(ids[q]), self.ids[found[best]], score[best]


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows with an id and a vector that takes part; the vector as array<double>, its dimension and largest component."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector"), F.size(v).alias("dimension"))
    # a null component makes the largest null, which no comparison accepts; NaN counts as larger than any number
    largest = F.aggregate("vector", F.lit(0.0), lambda a, x: F.when(x.isNull() | a.isNull(), None).otherwise(F.greatest(a, F.abs(x))))
    return rows.withColumn("largest", largest).where("dimension > 0 AND largest > 0 AND largest < double('Infinity')")


def _packed(rows: DataFrame, size: int, schema: str, make) -> DataFrame:
    """Rows (vec_id, vector, dimension) as rows of `size` vectors of one dimension; make gives a row's columns."""
    names = [f.split(" ")[0] for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = [kinds[f.split(" ")[1]] for f in schema.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        made = 0

        def row(d: int, ids: np.ndarray, data: np.ndarray) -> pa.RecordBatch:
            nonlocal made
            made += 1
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(make(made, d, ids, data), types)], names=names)

        for batch in batches:
            dims = batch.column("dimension").to_numpy()
            for d in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == d))
                waiting.setdefault(d, []).append((some.column("vec_id").to_numpy(), some.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)))
                while sum(len(x[0]) for x in waiting[d]) >= size:
                    ids, data = (np.concatenate(x) for x in zip(*waiting[d]))
                    waiting[d] = [(ids[size:], data[size:])]
                    yield row(d, ids[:size], data[:size])
        for d, parts in waiting.items():
            ids, data = (np.concatenate(x) for x in zip(*parts))
            if len(ids):
                yield row(d, ids, data)
        trim()

    return rows.select("vec_id", "vector", "dimension").mapInArrow(pack, schema)


def build(rows: DataFrame, shape: dict[int, tuple[float, float]], count: int) -> DataFrame:
    """The stored index of usable rows: one row for each block. shape: scale and largest scaled norm by dimension."""

    def block(made: int, d: int, ids: np.ndarray, data: np.ndarray):
        from pyspark import TaskContext

        at = (TaskContext.get().partitionId() << 32) + made
        return at, d, ids.astype("<i8").tobytes(), data.astype("<f8").tobytes(), Block(ids, data, *shape[d]).orders.astype("<u2").tobytes()

    return stored(_packed(rows.repartition(max(1, -(-count // BLOCK))), BLOCK, INDEX, block), "vector-index")


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each query row, by largest inner product."""
    small_batches(vectors.sparkSession)
    rows = usable(vectors, vector)
    asked = usable(queries, vector).dropDuplicates(["vec_id", "vector"])
    facts = rows.groupBy("dimension").agg(F.max("largest").alias("scale"), F.count("*").alias("n"))  # a row for each dimension
    scaled = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / F.col("scale")) * (x / F.col("scale")))
    norms = rows.join(F.broadcast(facts), "dimension").groupBy("dimension", "scale", "n").agg(F.max(scaled).alias("square")).collect()
    shape = {r["dimension"]: (r["scale"], float(r["square"]) ** 0.5) for r in norms}
    index = build(rows, shape, sum(r["n"] for r in norms))
    chunks = _packed(asked, QUERIES, CHUNK, lambda made, d, ids, data: (d, ids.astype("<i8").tobytes(), data.astype("<f8").tobytes()))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's own row comes before the chunks that are asked of it."""
        now = None
        for batch in batches:
            for row in batch.to_pylist():
                d = row["dimension"]
                ids, data = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vectors"], "<f8").reshape(-1, d)
                if row["orders"] is not None:
                    now = Block(ids, data, *shape[d], np.frombuffer(row["orders"], "<u2").reshape(-1, len(ids)))
                    continue
                got = [*now.search(ids, data, k)]
                who = np.repeat(np.array([g[0] for g in got], np.int64), [len(g[1]) for g in got])
                yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(np.concatenate([g[1] for g in got])), pa.array(np.concatenate([g[2] for g in got]))], names=["query_id", "vec_id", "score"])
        trim()

    # a row for each BLOCK vectors: the blocks' names are small
    sent = chunks.join(F.broadcast(index.select("block", "dimension")), "dimension").withColumn("chunk", F.lit(1))
    both = index.withColumn("chunk", F.lit(0)).unionByName(sent, allowMissingColumns=True)
    near = both.repartition("block").sortWithinPartitions("block", "chunk").mapInArrow(look, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
