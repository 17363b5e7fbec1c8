"""Links between embeddings: an exact range join in cells around pivots.

Cosine of at least c means a distance of at most sqrt(2 - 2c) between unit vectors. Each
vector lives in the cell of its nearest pivot, and a cell is packed into blocks. Two vectors
are no further apart on a line than in space: on the line through the pivots of two cells most
vectors of one cell are out of the range of most of the other, whole cells first, then vectors
in their order on the line. What is left is compared.

Every block meets every other once, in tasks that read two parts of the table of blocks. No
vector is shuffled for that, so the disk in use grows with the table, however many cells a
vector has to be compared with.
"""

from __future__ import annotations

import hashlib
import math
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from faremill.llm.components import components
from faremill.llm.storage import discard, written
from faremill.llm.words import give_back


@dataclass(frozen=True)
class Range:
    """least: cosine of a link; cell: residents that a cell has on average, as long as
    that takes at most `pivots` pivots; block: residents of a cell that one block holds;
    step: residents compared at once; side: bytes of blocks that a task reads of either part.
    All but `least` only decide how the work is split."""

    least: float = 0.95
    cell: int = 4096
    pivots: int = 1024
    block: int = 2048
    step: int = 128
    side: int = 32 << 20

    @property
    def reach(self) -> float:
        return math.sqrt(2 - 2 * self.least) + 1e-9


def matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Rows of numbers from binary columns of equal length."""
    n = len(column)
    if not n:
        return np.zeros((0, 0))
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(n, -1)


def known_by(batches):
    """(vec_id, digest, bytes): null digests where a vector links with nothing."""
    for batch in batches:
        numbers, digests = stored(batch.column(1))
        sizes = pa.array([None if x is None else len(x) for x in numbers], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), sizes], names=["vec_id", "digest", "bytes"]
        )


def usable(batches):
    """(vec_id, digest, numbers) of the vectors that can link."""
    for batch in batches:
        numbers, digests = stored(batch.column(1))
        out = pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), pa.array(numbers, pa.binary())],
            names=["vec_id", "digest", "numbers"],
        )
        yield out.filter(out.column(1).is_valid())


def stored(column: pa.ListArray) -> tuple[list[bytes | None], list[bytes | None]]:
    """Of each vector its numbers as they came and the digest of its unit vector; null where it
    links with nothing."""
    numbers: list[bytes | None] = [None] * len(column)
    digests: list[bytes | None] = [None] * len(column)
    values, ends = column.values, np.asarray(column.offsets, dtype=np.int64)
    lengths = np.where(np.asarray(column.is_valid()), np.diff(ends), 0)
    absent = np.concatenate(([0], np.cumsum(np.asarray(values.is_null()))))
    lengths[absent[ends[1:]] > absent[ends[:-1]]] = 0
    flat = values.to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        for at in range(0, len(rows), 1024):
            some = rows[at : at + 1024]
            x = flat[ends[some][:, None] + np.arange(length)]
            good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            some, x = some[good], np.ascontiguousarray(x[good])
            for row, own, unit in zip(some.tolist(), x, units(x), strict=True):
                numbers[row] = own.tobytes()
                digests[row] = hashlib.md5(unit.tobytes(), usedforsecurity=False).digest()
    return numbers, digests


def units(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in doubles, each by itself."""
    x = x.astype("<f8")
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt(np.square(x).sum(axis=1, keepdims=True))


def nearest(batches, pivots: np.ndarray, kind: str):
    """(vec_id, n, numbers, cell): the cell of the nearest pivot."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            cell = (units(matrix(part.column(2), kind)).astype(np.float32) @ pivots.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(cell.astype(np.int32))], names=["vec_id", "n", "numbers", "cell"]
            )


def dealt(batches, first: np.ndarray, pieces: np.ndarray):
    """(block, cell, vec_id, n, numbers): blocks of a cell are numbered on from its first."""
    for batch in batches:
        cell, hashed = np.asarray(batch.column(3)), np.asarray(batch.column(4))
        block = first[cell] + hashed % pieces[cell]
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.astype(np.int32)), *(batch.column(i) for i in (3, 0, 1, 2))],
            names=["block", "cell", "vec_id", "n", "numbers"],
        )


def packed(batches):
    """(block, cell, ids, sizes, numbers): one row for each block; rows come by block."""

    def row():
        ids, sizes = (np.concatenate([np.asarray(x.column(i)) for x in parts]).astype("<i8") for i in (2, 3))
        numbers = b"".join(y for x in parts for y in x.column(4).to_pylist())
        return pa.RecordBatch.from_arrays(
            [
                parts[0].column(0).slice(0, 1),
                parts[0].column(1).slice(0, 1),
                *(pa.array([x], pa.binary()) for x in (ids.tobytes(), sizes.tobytes(), numbers)),
            ],
            names=["block", "cell", "ids", "sizes", "numbers"],
        )

    parts: list[pa.RecordBatch] = []
    for batch in batches:
        block = np.asarray(batch.column(0))
        edges = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)]))
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if low == high:
                continue
            part = batch.slice(low, high - low)
            if parts and parts[0].column(0)[0] != part.column(0)[0]:
                yield row()
                parts = []
            parts.append(part)
    if parts:
        yield row()


class Side:
    """The blocks that a task has of one part of the table, one after the other."""

    def __init__(self, rows: list[tuple[int, int, bytes, bytes, bytes]], pivots: np.ndarray, kind: str):
        self.block, self.cell = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(2))
        self.id, self.size = (np.frombuffer(b"".join(r[i] for r in rows), dtype="<i8") for i in (2, 3))
        lengths = np.array([len(r[2]) // 8 for r in rows])
        self.edge = np.concatenate(([0], np.cumsum(lengths)))
        self.place = np.concatenate([(r[0] << 32) + np.arange(n) for r, n in zip(rows, lengths.tolist(), strict=True)])
        self.numbers = np.frombuffer(b"".join(r[4] for r in rows), dtype=kind).reshape(len(self.id), -1)
        rows.clear()  # their bytes are copied
        self.pivots = pivots[self.cell]
        self.links = np.zeros(len(self.id), dtype=np.int64)

    def rows(self, k: int) -> slice:
        return slice(int(self.edge[k]), int(self.edge[k + 1]))

    def units(self, k: int) -> np.ndarray:
        return units(self.numbers[self.rows(k)])

    def narrow(self) -> tuple[np.ndarray, np.ndarray]:
        """All unit vectors in single precision, and their products with their own pivots."""
        x = np.empty(self.numbers.shape, dtype=np.float32)
        own = np.empty(len(x), dtype=np.float32)
        for k in range(len(self.block)):
            part = self.rows(k)
            x[part] = self.units(k)
            own[part] = x[part] @ self.pivots[k]
        return x, own


class Meeting:
    """Compares the blocks of two parts; each two blocks in one task of all."""

    def __init__(self, left: Side, right: Side, plan: Range):
        self.left, self.right, self.plan = left, right, plan
        self.narrow, self.own = right.narrow()
        self.error = (self.narrow.shape[1] + 2) * 2.0**-24  # of a product in single precision
        self.label = np.arange(len(left.id) + len(right.id))
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0
        self.whole = np.zeros(len(left.id), dtype=bool)  # rows of blocks that met themselves

    def run(self) -> None:
        left, right = self.left, self.right
        p, q = left.pivots.astype(np.float64), right.pivots.astype(np.float64)
        # pivots are rounded, so their lengths count where they almost meet
        apart = np.square(p).sum(axis=1)[:, None] + np.square(q).sum(axis=1) - 2 * (p @ q.T)
        # on the line through two pivots, times their distance
        limit = (np.sqrt(np.maximum(apart, 0.0)) + 1e-7) * self.plan.reach + 8 * self.error
        s, t = left.block[:, None], right.block[None, :]
        mine = (s == t) | ((s < t) == ((s + t) % 2 == 0)) & (s != t)
        for at in range(0, len(left.block), 16):
            some = range(at, min(at + 16, len(left.block)))
            across = self.own[:, None] - self.narrow @ left.pivots[at : at + 16].T
            closest = np.minimum.reduceat(across, right.edge[:-1], axis=0).T
            for k in some:
                unit = left.units(k)
                x = unit.astype(np.float32)
                along = (x @ left.pivots[k])[:, None] - x @ right.pivots.T
                meet = mine[k] & (along.min(axis=0) + closest[k - at] <= limit[k])
                for j in np.flatnonzero(meet).tolist():
                    self.meet(k, j, x, unit, along[:, j], across[right.rows(j), k - at], limit[k, j])

    def meet(self, k, j, narrow, unit, along, across, limit) -> None:
        """Links of two blocks; along and across: places of their vectors on the line."""
        left, right = self.left, self.right
        a0, b0 = left.rows(k).start, right.rows(j).start
        same = left.block[k] == right.block[j]
        line = left.cell[k] != right.cell[j]
        if line:
            x, y = np.flatnonzero(along <= limit - across.min()), np.flatnonzero(across <= limit - along.min())
            x, y = x[np.argsort(along[x])], y[np.argsort(across[y])]
        else:
            x, y = np.arange(len(along)), np.arange(len(across))
        theirs, far, other = self.narrow[b0 + y], across[y], None
        for at in range(0, len(x), self.plan.step):
            some, to = x[at : at + self.plan.step], len(y)
            if line:
                to = int(np.searchsorted(far, limit - along[some[0]], side="right"))
            rough = narrow[some] @ theirs[:to].T >= self.plan.least - self.error - 1e-4
            if not rough.any():
                continue
            # single precision only picks the pairs; doubles decide
            other = right.units(j) if other is None else other
            i, m = np.nonzero(rough)
            for low in range(0, len(i), 1 << 14):
                a, b = some[i[low : low + (1 << 14)]], y[m[low : low + (1 << 14)]]
                good = (left.id[a0 + a] != right.id[b0 + b]) & (a < b if same else True)
                a, b = a[good], b[good]
                good = np.einsum("ij,ij->i", unit[a], other[b]) >= self.plan.least
                self.found(a0 + a[good], b0 + b[good])
        if same:
            self.whole[left.rows(k)] = True

    def found(self, a: np.ndarray, b: np.ndarray) -> None:
        if not len(a):
            return
        np.add.at(self.left.links, a, self.right.size[b])
        np.add.at(self.right.links, b, self.left.size[a])
        self.pairs.append((a, len(self.left.id) + b))
        self.waiting += len(a)
        if self.waiting > 1 << 18:
            self.join()

    def join(self) -> None:
        """Vectors that a link joins get one label, the least."""
        if not self.pairs:
            return
        a, b = (np.concatenate(x) for x in zip(*self.pairs, strict=True))
        self.pairs, self.waiting = [], 0
        label = self.label
        while (label[a] != label[b]).any():
            low = np.minimum(label[a], label[b])
            for side in (a, b):
                np.minimum.at(label, label[side], low)
            while (label[label] != label).any():
                label = label[label]
        self.label = label

    def result(self):
        """kind 0: a's number of links here, b; kind 1: a link that joins a and b."""
        self.join()
        left, right = self.left, self.right
        left.links[self.whole] += left.size[self.whole] - 1  # equal vectors
        for side, some in ((left, (left.links > 0) | self.whole), (right, right.links > 0)):
            yield from table(0, side.place[some], side.id[some], side.links[some])
        ids = np.concatenate((left.id, right.id))
        moved = np.flatnonzero(self.label != np.arange(len(ids)))
        a, b = ids[moved], ids[self.label[moved]]
        pairs = np.unique(np.stack([a, b], axis=1)[a != b], axis=0)
        yield from table(1, np.zeros(len(pairs), dtype=np.int64), pairs[:, 0], pairs[:, 1])


def table(kind: int, *columns: np.ndarray):
    for at in range(0, len(columns[0]), 1 << 16):
        values = [x[at : at + (1 << 16)] for x in columns]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(values[0]), kind, dtype=np.int8)), *map(pa.array, values)],
            names=["kind", "place", "a", "b"],
        )


def compared(batches, pivots: np.ndarray, kind: str, plan: Range):
    """Joins the two parts that a task has read. A row brings a block of either or of both."""
    sides: tuple[list, list] = ([], [])
    for batch in batches:
        for rows, own in ((sides[0], batch.columns[:5]), (sides[1], batch.columns[5:])):
            rows += [r for r in zip(*(c.to_pylist() for c in own), strict=True) if r[0] is not None]
    if all(sides):
        meeting = Meeting(*(Side(rows, pivots, kind) for rows in sides), plan)
        meeting.run()
        yield from meeting.result()
    give_back()


def join(vectors: DataFrame, plan: Range = Range()) -> DataFrame:
    """One row per vector row: vec_id, n_links, component_id and kept.

    Equal vectors are joined once and counted. A vector that is null, empty, zero or has a
    null or non-finite component links with nothing. Rows that share vec_id and vector are
    one vector; a null vec_id links with nothing and stays alone, with a null component.
    Vectors of other lengths than the first pivot's are of another space: each length is
    joined by itself. Other columns are not read; an empty table gives an empty result.
    """
    given = vectors.schema["embedding"].dataType
    narrow = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType)
    kind = "<f4" if narrow else "<f8"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{'float' if narrow else 'double'}>"))
    keys = written(rows.mapInArrow(known_by, "vec_id long, digest binary, bytes int"), "keys")
    good = keys.filter("digest is not null and vec_id is not null")
    first = good.groupBy("digest").agg(
        F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("n")
    )
    known = written(good.select("vec_id", "digest").distinct().join(first, "digest"), "digests")
    chosen = known.filter("vec_id = rep").select("digest", F.col("vec_id"), "n")
    distinct = written(
        rows.mapInArrow(usable, "vec_id long, digest binary, numbers binary")
        .join(chosen, ["digest", "vec_id"])
        .dropDuplicates(["digest", "vec_id"])
        .select("vec_id", "n", "numbers"),
        "vectors",
    )
    sizes = [r["bytes"] for r in good.select("bytes").distinct().collect()]
    spaces = [in_cells(distinct.filter(F.length("numbers") == size), size, kind, plan) for size in sizes]
    discard(distinct)
    copies = known.filter("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    links = keys.sparkSession.createDataFrame([], "space int, kind byte, place long, a long, b long")
    for size, (cells, count, pivots) in zip(sizes, spaces, strict=True):
        found = in_blocks(cells, count, size, kind, pivots, plan)
        links = links.unionByName(found.withColumn("space", F.lit(size)))
    counts = links.filter("kind = 0").groupBy("space", "place", F.col("a").alias("rep")).agg(F.sum("b").alias("n_links"))
    whole = components(links.filter("kind = 1").select("a", "b").unionByName(copies))
    per_vector = known.select("vec_id", "rep").join(counts, "rep").select("vec_id", "n_links")
    per_vector = per_vector.groupBy("vec_id").agg(F.max("n_links").alias("n_links"))
    whole = whole.withColumnRenamed("id", "vec_id")
    out = keys.select("vec_id").join(per_vector, "vec_id", "left").join(whole, "vec_id", "left")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"),
    )


def in_cells(distinct: DataFrame, size: int, kind: str, plan: Range) -> tuple[DataFrame, int, np.ndarray]:
    """Vectors of one length with their cells; their number; the pivots."""
    count = distinct.count()
    most = max(1, min(plan.pivots, (16 << 20) // size))
    number = max(1, min(most, round(count / plan.cell)))
    picked = distinct.orderBy(F.xxhash64("vec_id"), "vec_id").limit(number).select("numbers").collect()
    pivots = units(np.stack([np.frombuffer(r["numbers"], dtype=kind) for r in picked])).astype(np.float32)
    placed = distinct.mapInArrow(
        lambda batches: nearest(batches, pivots, kind), "vec_id long, n long, numbers binary, cell int"
    )
    return written(placed, "placed"), count, pivots


def in_blocks(placed: DataFrame, count: int, size: int, kind: str, pivots: np.ndarray, plan: Range) -> DataFrame:
    """(kind, place, a, b) of vectors of one length: kind 0, a's number of links in one task,
    place telling vectors of one vec_id apart; 1, a link."""
    spark = placed.sparkSession
    most = min(plan.block, max(1, (2 << 20) // size))
    pieces = np.ones(len(pivots), dtype=np.int64)
    # one row for each pivot
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():
        pieces[r["cell"]] = -(-r["n"] // most)
    first = np.cumsum(pieces) - pieces
    # as many parts as give each core a few tasks, or as many as a task has room for
    parts = max(math.ceil(count * size / plan.side), math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism)))
    parts = min(parts, int(pieces.sum()))
    rows = placed.select("vec_id", "n", "numbers", "cell", F.xxhash64("numbers").alias("hashed"))
    rows = rows.mapInArrow(
        lambda batches: dealt(batches, first, pieces), "block int, cell int, vec_id long, n long, numbers binary"
    )
    rows = rows.repartition(parts, "block").sortWithinPartitions("block")
    blocks = written(
        rows.mapInArrow(packed, "block int, cell int, ids binary, sizes binary, numbers binary"), "blocks"
    )
    discard(placed)
    # each task of the product gets the blocks of either part once
    starts = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    one, two = (blocks.select("*", starts.alias("starts")).alias(x) for x in ("one", "two"))
    met = one.hint("shuffle_replicate_nl").join(two, F.col("one.starts") | F.col("two.starts"))
    met = met.select(
        *(F.when(F.col(f"{other}.starts"), F.col(f"{own}.{c}")).alias(f"{own}_{c}")
          for own, other in (("one", "two"), ("two", "one")) for c in blocks.columns)
    )
    found = met.mapInArrow(
        lambda batches: compared(batches, pivots, kind, plan), "kind byte, place long, a long, b long"
    )
    with parts_of(spark, plan.side):
        out = written(found, "cells")
    discard(blocks)
    return out


@contextmanager
def parts_of(spark: SparkSession, size: int):
    """Files are read as parts of about `size` bytes, none of more than one file but for a rest,
    and their long rows few at a time."""
    own = {
        "spark.sql.files.maxPartitionBytes": str(size),
        "spark.sql.files.openCostInBytes": str(size),
        "spark.sql.parquet.columnarReaderBatchSize": "8",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "8",
    }
    before = {name: spark.conf.get(name, None) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
