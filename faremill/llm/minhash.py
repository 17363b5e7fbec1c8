"""Near duplicates by DartMinHash signatures of weighted word shingles and banded joining.

Each distinct shingle owns the quarter plane of weight and rank. Darts fall on it as a
Poisson process that hashing fixes, the same for every document; weight regions double in
width. A document owns the area below its weights. Its darts of lowest rank, one for each
coordinate, are its signature: two documents agree on a coordinate with a chance equal to
their weighted Jaccard similarity.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.components import components
from faremill.llm.storage import written
from faremill.llm.words import Words, grams, mix, pair, slices

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15


def _times(n: int) -> np.uint64:
    return _U(_STEP * n % 2**64)


@dataclass(frozen=True)
class NearDuplicates:
    """shingle: words of a shingle; least: similarity of a link; bands of rows coordinates
    each: a pair at the least similarity shares a band with a chance of
    1 - (1 - 0.8^5)^24 = 0.9999. fan: how many times more texts lead in each round; part:
    texts of a band that one group compares with the leads."""

    shingle: int = 5
    least: float = 0.8
    bands: int = 24
    rows: int = 5
    fan: int = 32
    part: int = 2048

    @property
    def size(self) -> int:
        return self.bands * self.rows


class Shingles:
    """Distinct shingles of the texts of a slice with their counts, grouped by text.

    A text of fewer words than a shingle has one shingle of all its words; a text without
    words has none.
    """

    def __init__(self, words: Words, length: int):
        hashes = words.hashes()
        left = words.left()
        whole = grams(hashes, length) if len(hashes) else hashes
        at = np.flatnonzero(left >= length)
        value, doc = whole[at], words.doc[at]
        short = np.flatnonzero((words.counts > 0) & (words.counts < length))
        if len(short):
            extra = np.zeros(len(short), dtype=np.uint64)
            for i, d in enumerate(short):
                x = _U(0)
                for h in hashes[words.first[d] : words.first[d + 1]]:
                    x = pair(np.array([x]), np.array([h]))[0]
                extra[i] = x
            value, doc = np.concatenate([value, extra]), np.concatenate([doc, short])
            order = np.argsort(doc, kind="stable")
            value, doc = value[order], doc[order]
        # sorted by text, then by hash: the text's number takes the place of the top bits
        room = max(1, int(len(words.counts) - 1).bit_length()) if len(words.counts) else 1
        keys = (doc.astype(np.uint64) << _U(64 - room)) | (value >> _U(room))
        _, first, self.count = np.unique(keys, return_index=True, return_counts=True)
        self.value, self.doc = value[first], doc[first]
        self.edges = np.searchsorted(self.doc, np.arange(len(words.counts) + 1))
        total = np.zeros(len(words.counts), dtype=np.int64)
        np.add.at(total, self.doc, self.count)
        self.total = total


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in [0, 1) from 64-bit words."""
    return (x >> _U(11)).astype(np.float64) * 2.0**-53


def signatures(shingles: Shingles, size: int) -> np.ndarray:
    """A row of `size` dart numbers for each text; texts without shingles get zeros."""
    docs = len(shingles.total)
    out = np.zeros((docs, size), dtype=np.uint64)
    todo = shingles.total > 0
    # so many darts leave a coordinate empty in a few texts of a hundred
    darts = size * (math.log(size) + 3)
    while todo.any():
        # the area below the weights times the highest rank is the expected darts
        ceiling = np.where(todo, darts / np.maximum(shingles.total, 1), 0.0)
        cell, rank, dart = throw(shingles, ceiling, size)
        best = np.full(docs * size, np.inf)
        np.minimum.at(best, cell, rank)
        won = rank == best[cell]
        flat = np.zeros(docs * size, dtype=np.uint64)
        flat[cell[won]] = dart[won]
        full = todo & np.isfinite(best).reshape(docs, size).all(axis=1)
        out[full] = flat.reshape(docs, size)[full]
        todo &= ~full
        darts *= 2
    return out


def throw(shingles: Shingles, ceiling: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Darts below the weights and the ceiling rank: cell (text * size + coordinate), rank, number."""
    cells, ranks, numbers = [], [], []
    low, width, region = 0, 1, 0
    weight = shingles.count
    active = np.flatnonzero(ceiling[shingles.doc] > 0)
    while len(active):
        # the region of weights from low to low + width of every shingle that reaches it
        seed = mix(shingles.value[active] + _times(region + 1))
        doc, most = shingles.doc[active], weight[active]
        top = ceiling[doc]
        rank = np.zeros(len(active))
        step = 0
        while len(seed):
            step += 1
            dart = mix(seed + _times(step))
            rank = rank - np.log1p(-unit(dart)) / width
            inside = rank < top
            seed, doc, most, top, rank, dart = (
                x[inside] for x in (seed, doc, most, top, rank, dart)
            )
            dart = mix(dart ^ _U(0xD1B54A32D192ED03))
            below = low + width * unit(mix(dart ^ _U(0x8CB92BA72F3D8DD7))) < most
            coordinate = mix(dart + _U(0xABC98388FB8FAC03)) % _U(size)
            cells.append(doc[below] * size + coordinate[below].astype(np.int64))
            ranks.append(rank[below])
            numbers.append(dart[below])
        low, width, region = (1, 1, 1) if region == 0 else (low + width, 2 * width, region + 1)
        active = active[weight[active] > low]
    if not cells:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.uint64)
    return np.concatenate(cells), np.concatenate(ranks), np.concatenate(numbers)


def band_keys(batches, plan: NearDuplicates):
    """For each text: its id and digest, and a key for each band (none without words)."""
    for batch in slices(batches):
        words = Words(batch.column(1))
        shingles = Shingles(words, plan.shingle)
        total, signature = shingles.total, signatures(shingles, plan.size)
        signature = signature.reshape(len(batch), plan.bands, plan.rows)
        key = np.broadcast_to(mix(np.arange(1, plan.bands + 1, dtype=np.uint64)), signature.shape[:2])
        for r in range(plan.rows):
            key = pair(key, signature[:, :, r])
        some = words.counts > 0
        offsets = np.concatenate(([0], np.cumsum(some) * plan.bands)).astype(np.int32)
        keys = pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(key.astype(np.uint64).view(np.int64)[some].ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(total), keys],
            names=["id", "digest", "total", "bands"],
        )


def shingle_rows(batches, length: int):
    """(id, shingle, n) of each distinct shingle of each text."""
    for batch in slices(batches):
        found = Shingles(Words(batch.column(1)), length)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(found.doc)),
                pa.array(found.value.view(np.int64)),
                pa.array(found.count),
            ],
            names=["id", "shingle", "n"],
        )


def similarities(batches, length: int):
    """Weighted Jaccard similarity of the two texts of each row."""
    for batch in slices(batches, "left_text", 1 << 20):
        sides = [Shingles(Words(batch.column(i)), length) for i in (2, 3)]
        found = np.zeros(len(batch))
        for i in range(len(batch)):
            (v, c), (w, d) = ((s.value[s.edges[i] : s.edges[i + 1]], s.count[s.edges[i] : s.edges[i + 1]]) for s in sides)
            _, x, y = np.intersect1d(v, w, assume_unique=True, return_indices=True)
            shared = int(np.minimum(c[x], d[y]).sum())
            either = int(c.sum() + d.sum()) - shared
            found[i] = shared / either if either else 0.0
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found)], names=["low", "high", "similarity"]
        )


def vertex(documents: DataFrame):
    """A document's number: its doc_id, or for a null one a number made from its text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    made = F.xxhash64(text).bitwiseAND(F.lit(2**62 - 1)) + F.lit(2**62)
    return F.coalesce(F.col("doc_id").cast("long"), made)


def identified(documents: DataFrame, name: str = "id") -> DataFrame:
    """The documents with a number for each (doc_id, text): the doc_id for the text of least
    digest, and numbers above all doc_ids for other texts under it."""
    key, digest = f"{name}_key", f"{name}_digest"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(vertex(documents).alias(key), F.md5(text).alias(digest))
    shared = rows.groupBy(key).agg(F.min(digest).alias("low"), F.max(digest).alias("high"))
    shared = written(shared.filter("low < high").select(key, "low"), "shared_ids")
    if shared.isEmpty():
        return documents.withColumn(name, vertex(documents))
    rows = documents.withColumns({key: vertex(documents), digest: F.md5(text)})
    made = F.xxhash64(key, digest).bitwiseAND(F.lit(2**62 - 1)) + F.lit(2**62)
    least = shared.select(key, F.col("low").alias(f"{name}_low"))
    own = F.when(F.coalesce(F.col(f"{name}_low") != F.col(digest), F.lit(False)), made).otherwise(F.col(key))
    return rows.join(least, key, "left").withColumn(name, own).select(*documents.columns, name)


def numbered(rows: DataFrame) -> DataFrame:
    """id, text and a digest of the text, of rows that identified() gave."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return rows.select("id", text.alias("text"), F.unhex(F.md5(text)).alias("digest"))


def verified(pairs: DataFrame, texts: DataFrame, plan: NearDuplicates) -> DataFrame:
    """Classes (low, high) of those pairs (a, b, low, high) whose whole texts reach the
    least similarity."""
    sides = [
        texts.select(F.col("id").alias(i), F.col("text").alias(t))
        for i, t in (("a", "left_text"), ("b", "right_text"))
    ]
    rows = pairs.join(sides[0], "a").join(sides[1], "b")
    rows = rows.select("low", "high", "left_text", "right_text")
    length, least = plan.shingle, plan.least
    scored = rows.mapInArrow(
        lambda batches: similarities(batches, length), "low long, high long, similarity double"
    )
    return scored.filter(F.col("similarity") >= least).select("low", "high").distinct()


def own_weight(texts: DataFrame, plan: NearDuplicates) -> DataFrame:
    """(id, own): the weight of a text's shingles that no other of the texts has."""
    length = plan.shingle
    rows = texts.mapInArrow(
        lambda batches: shingle_rows(batches, length), "id long, shingle long, n long"
    )
    alone = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("texts"), F.min("id").alias("id"), F.min("n").alias("n")
    )
    return alone.filter("texts = 1").groupBy("id").agg(F.sum("n").alias("own"))


BUCKETS = 128


def bucket_rows(batches, length: int):
    """(id, weights): a text's weight of shingles in each of a fixed number of buckets."""
    for batch in slices(batches):
        found = Shingles(Words(batch.column(1)), length)
        cell = found.doc * BUCKETS + (found.value % _U(BUCKETS)).astype(np.int64)
        sums = np.bincount(cell, found.count, len(batch) * BUCKETS)
        bytes_ = np.minimum(sums, 255).astype(np.uint8).reshape(len(batch), BUCKETS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([x.tobytes() for x in bytes_], pa.binary())],
            names=["id", "weights"],
        )


def may_reach(a: dict, b: dict, least: float) -> np.ndarray:
    """Which of the texts of a (rows) and b (columns) can be so similar.

    What a text has alone is in no intersection, and in each bucket the intersection
    weighs at most the lesser of the two weights; a full byte says nothing.
    """
    total, own = a["total"][:, None], a["own"][:, None]
    most = np.minimum(total - own, b["total"] - b["own"])
    both = np.maximum(total + b["own"], b["total"] + own)
    out = (most >= (least - 1e-9) * both) & (a["component"][:, None] != b["component"])
    i, j = np.nonzero(out)
    for low in range(0, len(i), 1 << 14):
        x, y = i[low : low + (1 << 14)], j[low : low + (1 << 14)]
        met = np.minimum(a["weights"][x], b["weights"][y])
        shared = met.sum(axis=1, dtype=np.int64)
        either = a["total"][x] + b["total"][y] - shared
        out[x, y] = (shared >= (least - 1e-9) * either) | (met == 255).any(axis=1)
    return out


def lead_pairs(batches, least: float):
    """Pairs of a lead and another text of its band that may link, with their components.

    Rows come by group, leads first. Only a group's leads and one batch are in memory.
    """
    group, leads = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        band, part, role = (np.asarray(batch.column(i)).astype(np.int64) for i in range(3))
        columns = {
            name: np.asarray(batch.column(i))
            for i, name in ((3, "id"), (4, "total"), (5, "own"), (6, "component"))
        }
        columns["weights"] = np.frombuffer(
            b"".join(batch.column(7).to_pylist()), dtype=np.uint8
        ).reshape(len(batch), BUCKETS)
        change = np.flatnonzero((np.diff(band) != 0) | (np.diff(part) != 0) | (np.diff(role) != 0))
        edges = [0, *(change + 1).tolist(), len(band)]
        for low, high in itertools.pairwise(edges):
            rows = {k: v[low:high] for k, v in columns.items()}
            if (band[low], part[low]) != group:
                group, leads = (band[low], part[low]), None
            if role[low] == 0:
                leads = rows if leads is None else {k: np.concatenate((leads[k], v)) for k, v in rows.items()}
            elif leads is not None:
                for at in range(0, high - low, 1024):
                    some = {k: v[at : at + 1024] for k, v in rows.items()}
                    i, j = np.nonzero(may_reach(leads, some, least))
                    a, b = leads["id"][i], some["id"][j]
                    c, d = leads["component"][i], some["component"][j]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(f(x, y))
                            for x, y in ((a, b), (c, d))
                            for f in (np.maximum, np.minimum)
                        ],
                        names=["a", "b", "high", "low"],
                    )


def classes(documents: DataFrame, plan: NearDuplicates = NearDuplicates()) -> DataFrame:
    """(id, class_id) of each row (id, text) that identified() gave: the least id among those
    that links reach.

    Texts of similarity 0.8 or more (weighted Jaccard on counted five-word shingles) link
    if they share a band; equal texts always do, unless they have no words. Rows of one
    id are one document. A text whose own shingles, which no other candidate has, weigh
    more than a fifth can have no link and leaves at once; the same weights bound the
    similarity of any two texts, and only pairs that can reach 0.8 are compared. Of the
    texts that share a band, each is compared first with
    the one that shares most bands over all; while different classes are left in a band,
    many more of the others are compared with all that are left, until every pair that
    could join two classes has been. So no link between classes is lost, and a large group
    around a common original needs one comparison for each member, not all pairs.
    """
    signed = written(
        numbered(documents).mapInArrow(
            lambda batches: band_keys(batches, plan), "id long, digest binary, total long, bands array<long>"
        ),
        "signatures",
    )
    first = signed.groupBy("digest").agg(F.min("id").alias("id"))
    with_words = signed.filter(F.size("bands") > 0).join(first, ["digest", "id"], "left_semi")
    keyed = with_words.select("id", "total", F.explode("bands").alias("band")).dropDuplicates(
        ["id", "band"]
    )
    shared = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(keyed.join(shared, "band"), "members")
    score = members.groupBy("id").agg(F.sum("n").alias("score"))
    texts = written(
        numbered(documents)
        .select("id", "text")
        .join(score.select("id"), "id", "left_semi")
        .dropDuplicates(["id"]),
        "texts",
    )
    length, least = plan.shingle, plan.least
    buckets = texts.mapInArrow(
        lambda batches: bucket_rows(batches, length), "id long, weights binary"
    )
    weights = score.join(own_weight(texts, plan), "id", "left").join(buckets, "id")
    weights = weights.withColumn("own", F.coalesce("own", F.lit(0)))
    left = members.join(weights, "id").filter(
        F.col("own") <= (1 - plan.least + 1e-9) * F.col("total")
    )
    left = written(
        left.select(
            "band", "n", "id", "score", "total", "own", F.col("id").alias("component"), "weights"
        ),
        "bands",
    )
    known = None  # (id, component) of the texts that links join
    fan = 1
    while True:
        group = F.pmod(F.xxhash64("id", F.lit(fan)), F.lit(fan))
        top = left.groupBy("band", group.alias("group")).agg(
            F.max(F.struct("score", (-F.col("id")).alias("minus"))).alias("top")
        )
        top = top.select("band", (-F.col("top.minus")).alias("id"))
        leads = left.join(top, ["band", "id"], "left_semi")
        shared = ["band", "part", "role", "id", "total", "own", "component", "weights"]
        # a large band is dealt to parts, each with all of the leads
        parts = F.ceil(F.col("n") / plan.part).cast("int")
        other = left.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
        first_rows = leads.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        rows = other.withColumn("role", F.lit(1)).select(*shared).unionByName(
            first_rows.withColumn("role", F.lit(0)).select(*shared)
        )
        rows = rows.repartition("band", "part").sortWithinPartitions("band", "part", "role")
        pairs = rows.mapInArrow(
            lambda batches: lead_pairs(batches, least), "a long, b long, high long, low long"
        ).distinct()
        pairs = written(pairs, "pairs")
        if not pairs.isEmpty():
            links = written(verified(pairs, texts, plan), "links")
            if not links.isEmpty():
                moved = components(links.select(F.col("high").alias("a"), F.col("low").alias("b")))
                left = renamed(left, moved)
                fresh = moved.select("id", "component")
                known = fresh if known is None else renamed(known, moved).unionByName(
                    fresh.join(known, "id", "left_anti")
                )
                known = written(known, "known")
        # what is not yet compared: pairs of those that did not lead, in different classes
        rest = left.join(top, ["band", "id"], "left_anti")
        mixed = rest.groupBy("band").agg(
            F.min("component").alias("least"), F.max("component").alias("most")
        )
        rest = rest.join(mixed.filter("least < most").select("band"), "band", "left_semi")
        left = written(rest, "bands")
        if left.isEmpty():
            break
        fan *= plan.fan
    # a text's class is that of the least document with the same text; texts without words
    # are alone
    rows = signed.select("id", "digest", (F.size("bands") > 0).alias("words")).distinct()
    rows = rows.join(first.withColumnRenamed("id", "first"), "digest").select(
        "id", F.when(F.col("words"), F.col("first")).otherwise(F.col("id")).alias("class_id")
    )
    if known is not None:
        joined = known.select(F.col("id").alias("class_id"), "component")
        rows = rows.join(joined, "class_id", "left").select(
            "id", F.coalesce("component", "class_id").alias("class_id")
        )
    return rows.groupBy("id").agg(F.min("class_id").alias("class_id"))


def renamed(rows: DataFrame, moved: DataFrame) -> DataFrame:
    """Rows whose component has moved get its new name."""
    names = moved.select(F.col("id").alias("component"), F.col("component").alias("_new"))
    out = rows.join(names, "component", "left").withColumn(
        "component", F.coalesce("_new", "component")
    )
    return out.select(*rows.columns)


def find(documents: DataFrame, plan: NearDuplicates = NearDuplicates()) -> DataFrame:
    """One row per document row: doc_id, class_id and kept (it is the one that stays).

    A null text has no words; texts without words are alone in their classes. A document
    whose doc_id is null has a number made from its text as class. Rows that share doc_id
    and text are one document; unlike texts under one doc_id are different documents, the
    one of least digest under the doc_id and the others under numbers above all doc_ids. An
    empty table gives an empty result.
    """
    rows = identified(documents.select("doc_id", "text"))
    return rows.join(classes(rows.select("id", "text"), plan), "id").select(
        "doc_id", "class_id", (F.col("id") == F.col("class_id")).alias("kept")
    )


def keep_one(documents: DataFrame, plan: NearDuplicates = NearDuplicates()) -> DataFrame:
    """One document of each class, with all columns: the one with the least doc_id. Of rows
    that share doc_id and text and differ elsewhere, any one."""
    taken = {name.lower() for name in documents.columns}
    name = "dedup_id"
    while any(x.startswith(name) for x in taken):
        name += "_"
    rows = identified(documents, name)
    found = classes(rows.select(F.col(name).alias("id"), "text"), plan)
    stay = found.filter("id = class_id").select(F.col("id").alias(name))
    return rows.join(stay, name, "left_semi").dropDuplicates([name]).select(*documents.columns)
