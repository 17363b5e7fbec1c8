"""Substring dedup: repeated windows of words, found level by level.

A level has windows of one length. At the first level only the window of least hash among
those inside each window of the next level is looked at, so a repeated window of the next
level always has its first-level window looked at in every copy. Windows that are repeated
there are extended to twice the length; what is repeated again is extended again, until no
candidates survive or the length wanted is reached. Windows travel as hashes, never as
text, and an extension is made only around survivors.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.minhash import vertex
from faremill.llm.storage import discard, written
from faremill.llm.words import Words, grams, mix, slices

_U = np.uint64


@dataclass(frozen=True)
class Windows:
    """length: words of a window, twice a whole number; part: copies of a window that one
    group holds before the window's copies are dealt to more groups."""

    length: int = 20
    part: int = 2048

    @property
    def half(self) -> int:
        return self.length // 2


def numbered(documents: DataFrame) -> DataFrame:
    """id, text and tag: a few bits of the text that tell apart rows of one doc_id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(
        vertex(documents).alias("id"), text.alias("text"), F.hash(text).alias("tag")
    )


def anchors(hashes: np.ndarray, left: np.ndarray, plan: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of full windows; for each, its half-length window of least hash; all hashes
    of half-length windows."""
    half = grams(hashes, plan.half) if len(hashes) else hashes
    starts = np.flatnonzero(left >= plan.length)
    inside = plan.length - plan.half + 1
    if not len(starts):
        return starts, starts, half
    order = mix(half ^ _U(0x5851F42D4C957F2D))
    least, where = order[: len(order) - inside + 1].copy(), np.arange(len(order) - inside + 1)
    for k in range(1, inside):
        other = order[k : k + len(least)]
        better = other < least
        least[better] = other[better]
        where[better] = np.flatnonzero(better) + k
    return starts, where[starts], half


def first_level(batches, plan: Windows):
    """(hash, id, tag, at) of each half-length window that is looked at."""
    for batch in slices(batches):
        words = Words(batch.column(1))
        _, chosen, half = anchors(words.hashes(), words.left(), plan)
        chosen = np.unique(chosen)
        doc = words.doc[chosen]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(half[chosen].view(np.int64)),
                batch.column(0).take(pa.array(doc)),
                batch.column(2).take(pa.array(doc)),
                pa.array((chosen - words.first[doc]).astype(np.int32)),
            ],
            names=["hash", "id", "tag", "at"],
        )


def second_level(batches, plan: Windows):
    """(hash, check, id, tag, at, parts) of each window around a survivor.

    The rows have the survivors' places and counts as `found`. check: 31 more bits of hash;
    parts: into how many groups the copies of the window are dealt.
    """
    for batch in slices(batches):
        words = Words(batch.column(1))
        hashes = words.hashes()
        starts, chosen, _ = anchors(hashes, words.left(), plan)
        found = batch.column(3)
        lengths = np.diff(np.asarray(found.offsets))
        flat = found.flatten()
        doc = np.repeat(np.arange(len(batch)), lengths)
        alive = np.zeros(len(words) + 1, dtype=np.int64)
        alive[words.first[doc] + np.asarray(flat.field(0))] = np.asarray(flat.field(1))
        keep = alive[chosen] > 0
        starts, chosen = starts[keep], chosen[keep]
        whole = grams(hashes, plan.length)[starts] if len(starts) else np.zeros(0, np.uint64)
        other = grams(mix(hashes + _U(11)), plan.length)[starts] if len(starts) else whole
        doc = words.doc[starts]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(whole.view(np.int64)),
                pa.array((other >> _U(33)).astype(np.int32)),
                batch.column(0).take(pa.array(doc)),
                batch.column(2).take(pa.array(doc)),
                pa.array((starts - words.first[doc]).astype(np.int32)),
                pa.array((alive[chosen] // plan.part + 1).astype(np.int32)),
            ],
            names=["hash", "check", "id", "tag", "at", "parts"],
        )


def later_copies(batches):
    """Of rows in the order of their keys (hash, check, part) and then of their places, marks
    those after the first of their key that start later than it. `spread`: it is the first
    of its group, and its window's other copies may be in other groups."""
    last: tuple | None = None
    place: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [np.asarray(batch.column(i)) for i in (0, 1, 2)]
        ident, at = np.asarray(batch.column(3)), np.asarray(batch.column(5))
        parts = np.asarray(batch.column(6))
        new = np.ones(len(ident), dtype=bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
        head = tuple(int(k[0]) for k in key)
        carried = head == last
        if carried:
            new[0] = False
        group = np.cumsum(new) - (0 if carried else 1)
        first_id, first_at = ident[new], at[new]
        if carried:
            first_id = np.concatenate(([place[0]], first_id))
            first_at = np.concatenate(([place[1]], first_at))
        later = (ident != first_id[group]) | (at != first_at[group])
        spread = ~later & (parts > 1)
        last = tuple(int(k[-1]) for k in key)
        place = (int(first_id[group[-1]]), int(first_at[group[-1]]))
        keep = pa.array(later | spread)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(i).filter(keep) for i in (0, 1, 3, 4, 5)),
                pa.array(later).filter(keep),
            ],
            names=["hash", "check", "id", "tag", "at", "later"],
        )


def repeated(documents: DataFrame, plan: Windows = Windows()) -> DataFrame:
    """(id, tag, starts): for each text, starts of its windows that also start earlier.

    Texts that are whole copies of an earlier document are not in it; see copies().
    """
    rows = numbered(documents).select("id", "text", "tag")
    looked = rows.mapInArrow(
        lambda batches: first_level(batches, plan), "hash long, id long, tag int, at int"
    )
    counts = looked.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    survivors = (
        looked.join(counts, "hash")
        .groupBy("id", "tag")
        .agg(F.collect_set(F.struct("at", "n")).alias("found"))
    )
    survivors = survivors.join(copies(documents), ["id", "tag"], "left_anti")
    survivors = written(survivors, "survivors")
    around = (
        rows.join(survivors, ["id", "tag"])
        .select("id", "text", "tag", "found")
        .mapInArrow(
            lambda batches: second_level(batches, plan),
            "hash long, check int, id long, tag int, at int, parts int",
        )
    )
    part = F.pmod(F.xxhash64("id", "at"), F.col("parts")).cast("int")
    keyed = around.select("hash", "check", part.alias("part"), "id", "tag", "at", "parts")
    keyed = keyed.repartition("hash", "check", "part").sortWithinPartitions(
        "hash", "check", "part", "id", "at"
    )
    marked = keyed.mapInArrow(
        later_copies, "hash long, check int, id long, tag int, at int, later boolean"
    )
    # the hashes are only needed once more for the firsts
    marked = marked.withColumns({x: F.when(~F.col("later"), F.col(x)) for x in ("hash", "check")})
    marked = written(marked, "windows")
    discard(survivors)
    # windows with very many copies: the firsts of their groups meet, a few for each window
    spread = marked.filter(~F.col("later"))
    first = spread.groupBy("hash", "check").agg(F.min(F.struct("id", "at")).alias("first"))
    spread = spread.join(first, ["hash", "check"]).filter(
        (F.col("id") != F.col("first.id")) | (F.col("at") != F.col("first.at"))
    )
    return (
        marked.filter("later")
        .select("id", "tag", "at")
        .unionByName(spread.select("id", "tag", "at"))
        .groupBy("id", "tag")
        .agg(F.collect_set("at").alias("starts"))
    )


def copies(documents: DataFrame) -> DataFrame:
    """(id, tag) of texts that a document of smaller id also has."""
    keyed = numbered(documents).select("id", "tag", F.unhex(F.md5("text")).alias("digest"))
    first = keyed.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    first = first.filter("first < last").drop("last")
    return keyed.join(first, "digest").filter("id > first").select("id", "tag").distinct()


def removed_words(batches, plan: Windows):
    """Kept words of each text and their counts."""
    for batch in slices(batches):
        words = Words(batch.column(1))
        texts, gone = [], []
        listed = batch.column(2)
        whole = np.asarray(batch.column(3).fill_null(False))
        for i in range(len(batch)):
            low, high = words.first[i], words.first[i + 1]
            n = int(high - low)
            cover = np.zeros(n + 1, dtype=np.int64)
            if whole[i] and n >= plan.length:
                cover[0] = 1
            elif listed[i].is_valid:
                at = np.asarray(listed[i].values)
                np.add.at(cover, at, 1)
                np.add.at(cover, np.minimum(at + plan.length, n), -1)
            kept = np.flatnonzero(np.cumsum(cover[:n]) == 0)
            gone.append(n - len(kept))
            data = words.data
            # neighbouring kept words that one space parts are copied together
            begin, end = words.starts[low + kept], words.ends[low + kept]
            if len(kept):
                joined = (begin[1:] == end[:-1] + 1) & (data[end[:-1]] == 0x20)
                head = np.concatenate(([True], ~joined))
                tail = np.concatenate((~joined, [True]))
                texts.append(
                    b" ".join(
                        data[a:b].tobytes()
                        for a, b in zip(begin[head].tolist(), end[tail].tolist(), strict=True)
                    )
                )
            else:
                texts.append(b"")
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(words.counts),
                pa.array(gone, pa.int64()),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_text"],
        )


def dedup(documents: DataFrame, plan: Windows = Windows()) -> DataFrame:
    """One row per document row: n_words, n_removed and kept_text, its words that no window
    covers whose words also start earlier, joined by one space.

    Earlier is a smaller doc_id, or the same document further left; windows are judged on
    the input. A null text has no words. A null doc_id counts as larger than any other,
    among themselves in the order of a number made from the text. Rows that share doc_id
    and text are one document and have equal results. A hot window's copies are dealt to
    groups of bounded size, whose firsts meet in a second step.
    """
    starts = repeated(documents, plan)
    marks = starts.withColumn("whole", F.lit(False)).unionByName(
        copies(documents).select(
            "id", "tag", F.lit(None).cast("array<int>").alias("starts"), F.lit(True).alias("whole")
        )
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        vertex(documents).alias("id"),
        text.alias("text"),
        F.hash(text).alias("tag"),
    )
    return (
        rows.join(marks, ["id", "tag"], "left")
        .select("doc_id", "text", "starts", "whole")
        .mapInArrow(
            lambda batches: removed_words(batches, plan),
            "doc_id long, n_words long, n_removed long, kept_text string",
        )
    )


def with_digest(kept: DataFrame) -> DataFrame:
    return kept.withColumn("kept_sha256", F.sha2("kept_text", 256)).drop("kept_text")
