"""Nearest vectors by inner product: p-stable hashing with several probes a table.

Scaled by the greatest length M and given one more coordinate, sqrt(1 - |x/M|^2), all vectors
lie on a unit sphere, as does a query scaled to length 1 with 0 as that coordinate; the order
by distance is then that by inner product. A table projects on m random normal (2-stable)
directions and cuts each into intervals of one width; a vector's intervals name its bucket. A
neighbour at distance r differs from the query by a normal amount of deviation r along each
direction, which gives every interval, and by multiplication every bucket, a chance to hold
it. A query visits the buckets of each table in the order of these chances, its own first as
a rule, and all candidates met are ranked by their exact inner products.

Directions, width and the number of probes are fitted on bounded samples: `trial` queries,
whose true neighbours a scan of all vectors finds, and `sample` vectors, which tell what a
probe costs. The index holds every vector.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm.storage import discard, written


@dataclass(frozen=True)
class Probing:
    """nearest: neighbours of a query; tables: hash tables; recall: share of the trial
    queries' true neighbours that the probes must reach; trial: queries and sample: vectors
    that the tables are fitted on; buckets: of a table at most; rows: vectors of a bucket to
    aim at; block: vectors that one group holds; visits: queries that one group takes; seed
    of the directions."""

    nearest: int = 20
    tables: int = 3
    recall: float = 0.96
    trial: int = 128
    sample: int = 8192
    buckets: int = 1 << 16
    rows: int = 64
    block: int = 8192
    visits: int = 1 << 16
    seed: int = 20_240_613


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of doubles from binary values of equal length."""
    n = len(column)
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(n, -1) if n else np.zeros((0, 0))


def usable(batches):
    """(vec_id, vector, length): doubles of the vectors that can take part."""
    for batch in batches:
        ids, vectors, lengths = [], [], []
        for vec_id, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if vec_id is None or not x.is_valid or not len(x) or x.values.null_count:
                continue
            v = np.asarray(x.values, dtype="<f8")
            most = np.abs(v).max() if np.isfinite(v).all() else 0.0
            if most > 0:
                ids.append(vec_id)
                vectors.append((v + 0.0).tobytes())  # -0 and 0 are the same
                lengths.append(most * math.sqrt(((v / most) ** 2).sum()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(vectors, pa.binary()), pa.array(lengths, pa.float64())],
            names=["vec_id", "vector", "length"],
        )


def on_sphere(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors of at most that length as points of the unit sphere, one dimension up."""
    x = x / longest
    return np.column_stack([x, np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0.0))])


def as_query(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return np.column_stack([x / np.sqrt((x * x).sum(axis=1, keepdims=True)), np.zeros(len(x))])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up in the same order wherever they are computed."""
    return (a * b).sum(axis=1)


# --- tables ------------------------------------------------------------------------


@dataclass
class Table:
    """directions: one column each; shift, width: of the intervals; low, size: the first
    interval and how many there are along each direction (all beyond count as the outermost);
    deviation: of a neighbour along a direction."""

    directions: np.ndarray
    shift: np.ndarray
    width: float
    low: np.ndarray
    size: np.ndarray
    deviation: float

    @property
    def buckets(self) -> int:
        return int(np.prod(self.size))

    def along(self, points: np.ndarray) -> np.ndarray:
        return (points @ self.directions + self.shift) / self.width

    def codes(self, points: np.ndarray) -> np.ndarray:
        """The bucket of each point."""
        cell = np.floor(self.along(points)).astype(np.int64) - self.low
        cell = np.clip(cell, 0, self.size - 1)
        code = np.zeros(len(points), dtype=np.int64)
        for j, size in enumerate(self.size.tolist()):
            code = code * size + cell[:, j]
        return code

    def chances(self, points: np.ndarray) -> np.ndarray:
        """For each query point, the chance of each bucket to hold a neighbour."""
        at = self.along(points)
        out = np.ones((len(points), 1))
        for j, size in enumerate(self.size.tolist()):
            edges = (self.low[j] + np.arange(1, size) - at[:, j, None]) * (self.width / self.deviation)
            below = np.column_stack([np.zeros(len(points)), normal(edges), np.ones(len(points))])
            out = (out[:, :, None] * np.diff(below, axis=1)[:, None, :]).reshape(len(points), -1)
        return out

    def probes(self, points: np.ndarray, number: int):
        """(query, bucket) of the buckets of the best chances, `number` for each query."""
        step = max(1, (1 << 21) // self.buckets)
        for at in range(0, len(points), step):
            chance = self.chances(points[at : at + step])
            if number < chance.shape[1]:
                best = np.argpartition(-chance, number - 1, axis=1)[:, :number]
            else:
                best = np.broadcast_to(np.arange(chance.shape[1]), chance.shape)
            yield np.repeat(np.arange(at, at + len(best)), best.shape[1]), best.ravel()


def normal(x: np.ndarray) -> np.ndarray:
    """Normal distribution function, within 2e-7: only the order of probes depends on it."""
    t = 1 / (1 + 0.2316419 * np.abs(x))
    poly = 0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
    tail = np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * t * poly
    return np.where(x >= 0, 1 - tail, tail)


def tables_of(points: np.ndarray, m: int, width: float, deviation: float, plan: Probing) -> list[Table]:
    """Tables over m directions, their intervals spanning the sample's points."""
    rng = np.random.default_rng(plan.seed)
    out = []
    for _ in range(plan.tables):
        directions = rng.normal(size=(points.shape[1], m))
        shift = rng.uniform(0, width, m)
        cell = np.floor((points @ directions + shift) / width).astype(np.int64)
        low, high = cell.min(axis=0), cell.max(axis=0)
        out.append(Table(directions, shift, width, low, high - low + 1, deviation))
    return out


def fit(points: np.ndarray, queries: np.ndarray, near: list[np.ndarray], n: int, plan: Probing):
    """(tables, probes a table) that reach the recall at the least cost.

    points: the sample; near: points of each trial query's true neighbours; n: all vectors.
    Cost: candidates that a query meets, plus a charge for each bucket it visits.
    """
    deviation = max(1e-6, float(np.median([np.linalg.norm(p - q, axis=1).mean() for p, q in zip(near, queries, strict=True)])))
    sizes = np.array([len(p) for p in near])
    owner, met = np.repeat(np.arange(len(near)), sizes), np.concatenate(near)
    most = min(plan.buckets, max(1, n // plan.rows))
    best = None
    for m in (1, 2, 3, 4, 5, 6, 8, 10, 12, 16):
        for share in (0.75, 1.0, 1.5, 2.0, 3.0, 4.0):
            tables = tables_of(points, m, share * deviation, deviation, plan)
            if max(t.buckets for t in tables) > most:
                continue
            rank = np.full(len(met), most)
            costs = np.zeros(most)
            for t in tables:
                chance = t.chances(queries)
                order = np.argsort(-chance, axis=1, kind="stable")
                place = np.empty_like(order)
                np.put_along_axis(place, order, np.arange(order.shape[1])[None, :].repeat(len(order), 0), 1)
                rank = np.minimum(rank, place[owner, t.codes(met)])
                full = np.bincount(t.codes(points), minlength=t.buckets) / len(points)
                cost = np.cumsum(full[order], axis=1).mean(axis=0)
                costs += np.concatenate([cost, np.full(most - len(cost), cost[-1])])
            need = int(np.sort(rank)[math.ceil(plan.recall * len(rank)) - 1]) + 1
            cost = costs[need - 1] + plan.tables * need * plan.rows / n
            if best is None or cost < best[0]:
                best = (cost, tables, need)
    if best is None:  # too few vectors for more than one bucket
        return [Table(np.zeros((points.shape[1], 0)), np.zeros(0), 1.0, np.zeros(0, int), np.zeros(0, int), deviation)], 1
    return best[1], best[2]


@dataclass
class Layout:
    """Packs of neighbouring buckets for the groups: pack of each bucket (-1: empty), first
    pack of each table, and for each pack the blocks of its vectors and the parts of its
    queries. A bucket of more than a block is a pack of several blocks."""

    packs: list[np.ndarray]
    blocks: np.ndarray
    parts: np.ndarray

    @classmethod
    def of(cls, counts: list[np.ndarray], plan: Probing) -> Layout:
        packs, blocks = [], []
        for table in counts:
            pack = np.full(len(table), -1, dtype=np.int32)
            room = 0
            for code in np.flatnonzero(table).tolist():
                n = int(table[code])
                if n > room:
                    blocks.append(-(-n // plan.block))
                    room = plan.block
                pack[code] = len(blocks) - 1
                room -= n
            packs.append(pack)
        return cls(packs, np.array(blocks), np.ones(len(blocks), dtype=np.int64))


# --- rows of the groups ----------------------------------------------------------------


def spread(seed: np.ndarray, over: np.ndarray) -> np.ndarray:
    return ((seed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % over


GROUPS = "pack int, block int, part int, role byte, item long, ids array<bigint>, codes array<int>, vector binary"


def groups(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=["pack", "block", "part", "role", "item", "ids", "codes", "vector"])


def single(codes: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(codes) + 1, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(codes.astype(np.int32)))


def residents(batches, tables: list[Table], layout: Layout, longest: float):
    """Every vector once for each table and part of its group's queries; role 0.

    Batches hold (item, ids, vector).
    """
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            items = np.asarray(part.column(0))
            points = on_sphere(matrix(part.column(2)), longest)
            for table, packs in zip(tables, layout.packs, strict=True):
                code = table.codes(points)
                pack = packs[code]
                block = spread(items.astype(np.uint64), layout.blocks[pack])
                times = layout.parts[pack]
                row = np.repeat(np.arange(len(items)), times)
                number = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                for low in range(0, len(row), 4096):
                    r = row[low : low + 4096]
                    take = pa.array(r)
                    yield groups(
                        [
                            pa.array(pack[r]),
                            pa.array(block[r].astype(np.int32)),
                            pa.array(number[low : low + 4096].astype(np.int32)),
                            pa.array(np.zeros(len(r), dtype=np.int8)),
                            part.column(0).take(take),
                            part.column(1).take(take),
                            single(code[r]),
                            part.column(2).take(take),
                        ]
                    )


def visited(part: pa.RecordBatch, tables: list[Table], layout: Layout, number: int):
    """(query, pack, codes) for each table: the probes of a batch (item, vector) by pack."""
    points = as_query(matrix(part.column(1)))
    for table, packs in zip(tables, layout.packs, strict=True):
        for query, code in table.probes(points, number):
            pack = packs[code]
            held = pack >= 0
            query, code, pack = query[held], code[held], pack[held]
            order = np.lexsort((code, pack, query))
            query, code, pack = query[order], code[order], pack[order]
            first = np.flatnonzero(np.diff(query, prepend=-1) | np.diff(pack, prepend=-1))
            yield query[first], pack[first], code, np.append(first, len(code))


def visitors(batches, tables: list[Table], layout: Layout, number: int):
    """Every query once for each block of each pack that it visits; role 1."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            items = np.asarray(part.column(0)).astype(np.uint64)
            for query, pack, code, edges in visited(part, tables, layout, number):
                probes = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(code.astype(np.int32)))
                times = layout.blocks[pack]
                row = np.repeat(np.arange(len(query)), times)
                block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                piece = spread(items[query], layout.parts[pack])
                for low in range(0, len(row), 4096):
                    r = row[low : low + 4096]
                    take = pa.array(query[r])
                    yield groups(
                        [
                            pa.array(pack[r].astype(np.int32)),
                            pa.array(block[low : low + 4096].astype(np.int32)),
                            pa.array(piece[r].astype(np.int32)),
                            pa.array(np.ones(len(r), dtype=np.int8)),
                            part.column(0).take(take),
                            pa.array([None] * len(r), pa.list_(pa.int64())),
                            probes.take(pa.array(r)),
                            part.column(1).take(take),
                        ]
                    )


def visits(batches, tables: list[Table], layout: Layout, number: int):
    """(pack, visits) of a task's queries."""
    total = np.zeros(len(layout.blocks), dtype=np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            for _, pack, _, _ in visited(batch.slice(at, 512), tables, layout, number):
                total += np.bincount(pack, minlength=len(total))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.flatnonzero(total).astype(np.int32)), pa.array(total[total > 0])], names=["pack", "visits"]
    )


class Group:
    """The vectors of one block, ranked for the queries that come by."""

    def __init__(self):
        self.ids, self.codes, self.vectors = [], [], []

    def add(self, part: pa.RecordBatch) -> None:
        self.ids += part.column(5).to_pylist()
        self.codes.append(np.asarray(part.column(6).flatten()))
        self.vectors.append(matrix(part.column(7)))

    def close(self) -> None:
        self.vectors, codes = np.concatenate(self.vectors), np.concatenate(self.codes)
        self.kinds, self.kind = np.unique(codes, return_inverse=True)

    def rank(self, part: pa.RecordBatch, most: int):
        """(item, vec_id, score) of the `most` nearest ids in the buckets that each query probes."""
        queries, probes = matrix(part.column(7)), part.column(6)
        rough = queries @ self.vectors.T
        owner = np.repeat(np.arange(part.num_rows), np.asarray(probes.value_lengths()))
        open_ = np.zeros((part.num_rows, len(self.kinds)), dtype=bool)
        code = np.asarray(probes.flatten())
        place = np.searchsorted(self.kinds, code)
        known = place < len(self.kinds)
        known[known] = self.kinds[place[known]] == code[known]
        open_[owner[known], place[known]] = True
        rough[~open_[:, self.kind]] = -np.inf
        slack = 1e-12 * np.abs(queries).sum(axis=1) * np.abs(self.vectors).max()
        items = part.column(4).to_pylist()
        for i, row in enumerate(rough):
            yield items[i], best_ids(row, slack[i], queries[i], self.vectors, self.ids, most)


def best_ids(rough: np.ndarray, slack: float, query: np.ndarray, vectors: np.ndarray, ids: list, most: int):
    """The `most` best (score, vec_id), ties to smaller ids; each id once, by its best vector.

    rough, exact up to slack, picks the rows; their products are then added up again.
    """
    candidates = int((rough > -np.inf).sum())
    take = min(candidates, most)
    while True:
        if not take:
            return []
        least = np.partition(rough, len(rough) - take)[len(rough) - take]
        rows = np.flatnonzero((rough >= least - 2 * slack) & (rough > -np.inf))
        scores = products(np.broadcast_to(query, (len(rows), len(query))), vectors[rows])
        found: dict[int, float] = {}
        for score, row in sorted(zip((-scores).tolist(), rows.tolist(), strict=True)):
            for vec_id in ids[row]:
                found.setdefault(vec_id, -score)
        if len(found) >= most or len(rows) >= candidates:
            break
        take = min(candidates, 2 * take)  # ids that stand for several vectors
    return sorted(((-score, vec_id) for vec_id, score in found.items()))[:most]


def search(batches, most: int, step: int = 256):
    """(item, vec_id, score): the best of each group for each query that visits it.

    Rows come by pack, block, part and role, so only one group's vectors and a step of
    queries are in memory.
    """
    group, key, closed = None, None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(4)], axis=1)
        edges = np.flatnonzero(np.any(np.diff(keys, axis=0) != 0, axis=1)) + 1
        edges = np.concatenate(([0], edges, [len(keys)]))
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = tuple(keys[low, :3].tolist())
            if own != key:
                group, key, closed = Group(), own, False
            if keys[low, 3] == 0:
                group.add(batch.slice(low, high - low))
                continue
            if not closed and group.vectors:
                group.close()
                closed = True
            if not closed:
                continue  # a block that its bucket's vectors have left empty
            for at in range(low, high, step):
                part = batch.slice(at, min(step, high - at))
                item, ids, scores = [], [], []
                for query, best in group.rank(part, most):
                    item += [query] * len(best)
                    ids += [vec_id for _, vec_id in best]
                    scores += [-score for score, _ in best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())],
                    names=["item", "vec_id", "score"],
                )


def scan(batches, queries: np.ndarray, most: int):
    """(trial, score, vector): a task's nearest vectors to the trial queries; a whole scan."""
    scores, vectors = np.zeros((len(queries), 0)), np.zeros((0, queries.shape[1]))
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            x = matrix(batch.slice(at, 4096).column(0))
            scores = np.column_stack([scores, queries @ x.T])
            vectors = np.concatenate([vectors, x])
            if scores.shape[1] > most:
                best = np.argpartition(-scores, most - 1, axis=1)[:, :most]
                used, where = np.unique(best, return_inverse=True)
                kept = np.full((len(queries), len(used)), -np.inf)
                where = where.reshape(best.shape)
                np.put_along_axis(kept, where, np.take_along_axis(scores, best, 1), 1)
                scores, vectors = kept, vectors[used]
    for i, row in enumerate(scores):
        held = np.flatnonzero(row > -np.inf)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(held), i, dtype=np.int32)),
                pa.array(row[held]),
                pa.array([vectors[j].tobytes() for j in held], pa.binary()),
            ],
            names=["trial", "score", "vector"],
        )


# --- the search ------------------------------------------------------------------------


def nearest(vectors: DataFrame, asked: Column, plan: Probing = Probing()) -> DataFrame:
    """(query_id, rank, vec_id, score): for every vec_id that `asked` picks, its nearest other
    vec_ids that the probes meet, by inner product, ties to the smaller vec_id.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a
    null vec_id, take no part. Rows that share vec_id and vector are one. Unlike vectors under
    one vec_id are all searched and found; the vec_id is listed once, with its best score.
    Vectors of different lengths are different spaces. A query with fewer candidates gets
    fewer rows. Other columns are not read; an empty table gives an empty result.

    Equal vectors are one candidate with their nearest + 1 smallest ids, since no more of them
    can be in any result, and one query. A group holds a block of a bucket's vectors, and takes
    a bounded number of queries: hot buckets are split both ways. If a few vectors are far
    longer than all others, the buckets tell the others apart less and more of them are
    visited; the recall is kept.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows = rows.mapInArrow(usable, "vec_id long, vector binary, length double")
    held = written(rows.withColumn("digest", F.unhex(F.md5("vector"))), "vectors")
    most = plan.nearest + 1
    by_id = Window.partitionBy("digest").orderBy("vec_id")
    least = held.withColumn("place", F.dense_rank().over(by_id)).where(F.col("place") <= most)
    distinct = least.groupBy("digest").agg(
        F.sort_array(F.collect_set("vec_id")).alias("ids"),
        F.first("vector").alias("vector"),
        F.first("length").alias("length"),
    )
    distinct = written(distinct.withColumn("item", F.monotonically_increasing_id()), "distinct")
    asking = held.where(asked).select(F.col("vec_id").alias("query_id"), "digest").distinct()
    asking = written(asking.join(distinct.select("digest", "item"), "digest").drop("digest"), "asking")
    sizes = distinct.groupBy(F.length("vector").alias("bytes")).agg(F.count("*").alias("n"), F.max("length").alias("most"))
    found = None
    for size in sizes.collect():  # one row for each length of vectors
        part = distinct.where(F.length("vector") == size["bytes"])
        queries = part.join(asking.select("item").distinct(), "item", "left_semi").select("item", "vector")
        one = in_space(part, queries, size["n"], size["most"], plan)
        if one is not None:
            found = one if found is None else found.unionByName(one)
    discard(held)
    if found is None:
        empty = "query_id long, rank int, vec_id long, score double"
        return vectors.sparkSession.createDataFrame([], empty)
    pairs = found.join(asking, "item").where("vec_id <> query_id")
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= plan.nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def in_space(distinct: DataFrame, queries: DataFrame, n: int, longest: float, plan: Probing) -> DataFrame | None:
    """(item, vec_id, score): the best candidates of each query vector, in vectors of one length."""
    most = plan.nearest + 1
    queries = written(queries, "queries")
    by_hash = [F.xxhash64("item"), "item"]
    trial = queries.orderBy(*by_hash).limit(plan.trial).select("vector").collect()
    if not trial:
        return None
    asked = np.stack([np.frombuffer(r["vector"], dtype="<f8") for r in trial])
    sample = distinct.orderBy(*by_hash).limit(plan.sample).select("vector").collect()
    sample = np.stack([np.frombuffer(r["vector"], dtype="<f8") for r in sample])
    # the trial queries' nearest of all vectors: trial x nearest rows
    order = Window.partitionBy("trial").orderBy(F.desc("score"), "vector")
    truth = (
        distinct.select("vector")
        .mapInArrow(lambda batches: scan(batches, asked, most), "trial int, score double, vector binary")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= most)
        .select("trial", "vector")
        .collect()
    )
    near: list[list[np.ndarray]] = [[] for _ in trial]
    for row in truth:
        near[row["trial"]].append(np.frombuffer(row["vector"], dtype="<f8"))
    points = [on_sphere(np.stack(rows), longest) for rows in near]
    tables, number = fit(on_sphere(sample, longest), as_query(asked), points, n, plan)

    def counted(batches):
        total = [np.zeros(t.buckets, dtype=np.int64) for t in tables]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                spot = on_sphere(matrix(batch.slice(at, 4096).column(0)), longest)
                for t, bins in zip(tables, total, strict=True):
                    bins += np.bincount(t.codes(spot), minlength=len(bins))
        for i, bins in enumerate(total):
            code = np.flatnonzero(bins)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(code), i, dtype=np.int32)), pa.array(code), pa.array(bins[code])],
                names=["hashing", "code", "n"],
            )

    filled = distinct.select("vector").mapInArrow(counted, "hashing int, code long, n long")
    counts = [np.zeros(t.buckets, dtype=np.int64) for t in tables]
    # tables x buckets rows at most
    for row in filled.groupBy("hashing", "code").agg(F.sum("n").alias("n")).collect():
        counts[row["hashing"]][row["code"]] = row["n"]
    layout = Layout.of(counts, plan)
    coming = queries.mapInArrow(lambda batches: visits(batches, tables, layout, number), "pack int, visits long")
    for row in coming.groupBy("pack").agg(F.sum("visits").alias("visits")).collect():
        layout.parts[row["pack"]] = -(-row["visits"] // plan.visits)
    inside = distinct.select("item", "ids", "vector").mapInArrow(
        lambda batches: residents(batches, tables, layout, longest), GROUPS
    )
    calling = queries.mapInArrow(lambda batches: visitors(batches, tables, layout, number), GROUPS)
    dealt = inside.unionByName(calling).repartition("pack", "block", "part")
    dealt = dealt.sortWithinPartitions("pack", "block", "part", "role")
    met = dealt.mapInArrow(lambda batches: search(batches, most), "item long, vec_id long, score double")
    met = met.groupBy("item", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("item").orderBy(F.desc("score"), "vec_id")
    met = met.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)
    return written(met.select("item", "vec_id", "score"), "nearest")
