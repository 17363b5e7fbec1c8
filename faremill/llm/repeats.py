"""Periodic runs of words, found by lag scans and by window minima at several scales.

A run is a stretch of consecutive words with smallest period q (words q apart are the same)
that is at least `least` words and `times` periods long and that no neighbouring word extends
keeping the period. Periods up to `short` are found by comparing each word with the one that
many words on. Longer ones are found scale by scale: at scale W, for periods of W + 1 to 2W
words, every stretch of 2W words is hashed, and the least hash of each window of W neighbours
marks a place. Inside a run all stretches of one period are unlike, and windows one period
apart hold the same hashes, so a mark is repeated at exactly the period's distance: marks of
equal hash that follow each other at such a distance are seeds. A seed is extended on the
words themselves as far as its lag holds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.words import Words, pair, slices

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


@dataclass(frozen=True)
class Runs:
    """least: words of a run; times: periods of a run, 4 at least (seeds need them); short:
    the longest period that lag scans find, a power of two."""

    least: int = 6
    times: int = 4
    short: int = 8

    def __post_init__(self):
        if self.times < 4 or self.least < 1 or self.short < 1 or self.short & (self.short - 1):
            raise ValueError(f"no such runs can be found: {self}")

    def enough(self, period):
        return np.maximum(self.least, self.times * period)


def stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each longest row of true values begins and ends."""
    edges = np.flatnonzero(np.diff(same.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def _ahead(values: np.ndarray, by: int, empty) -> np.ndarray:
    out = np.full_like(values, empty)
    if by < len(values):
        out[: len(values) - by] = values[by:]
    return out


def marks(grams: np.ndarray, room: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least hash of some window of `width` (a power of two) places.

    room: hashes of the same text from each place on, itself included; none or less where
    a place has no hash.
    """
    least, step = grams, 1
    while step < width:
        least = np.minimum(least, _ahead(least, step, ~np.uint64(0)))
        step *= 2
    # the greatest of the minima of all windows over a place is its own hash, or less
    reached = np.where(room >= width, least, np.uint64(0))
    step = 1
    while step < width:
        shifted = np.zeros_like(reached)
        shifted[step:] = reached[:-step]
        reached = np.maximum(reached, shifted)
        step *= 2
    return np.flatnonzero((room > 0) & (reached == grams))


def seeds(places: np.ndarray, hashes: np.ndarray, docs: np.ndarray, width: int):
    """(place, lag) where a mark's next equal mark of its text is width + 1 to 2 width on."""
    order = np.lexsort((places, hashes))
    places, hashes, docs = places[order], hashes[order], docs[order]
    lag = np.diff(places)
    good = (hashes[1:] == hashes[:-1]) & (docs[1:] == docs[:-1]) & (lag > width) & (lag <= 2 * width)
    return places[:-1][good], lag[good]


def reach(words: np.ndarray, at: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch of places around `at` whose words are those `lag` words on.

    low, high: the text's range. Compares blocks that double, so the work is in
    proportion to the stretch.
    """
    begin, end = at, at
    size = 64
    while end < high - lag:
        stop = min(high - lag, end + size)
        unlike = np.flatnonzero(words[end:stop] != words[end + lag : stop + lag])
        if len(unlike):
            end += int(unlike[0])
            break
        end, size = stop, size * 2
    size = 64
    while begin > low:
        stop = max(low, begin - size)
        unlike = np.flatnonzero(words[stop:begin] != words[stop + lag : begin + lag])
        if len(unlike):
            begin = stop + int(unlike[-1]) + 1
            break
        begin, size = stop, size * 2
    return begin, end


def smallest(words: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether a stretch of four periods at least has no smaller period.

    A smaller one would divide it (Fine and Wilf), so its prime factors tell.
    """
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            less = period // factor
            if (words[start : end - less] == words[start + less : end]).all():
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def found(words: Words, plan: Runs) -> np.ndarray:
    """Runs of all texts of a slice, by text, start and period: (start, length, period).

    Places count from the slice's first word. Words are compared as 64-bit hashes.
    """
    hashes, left = words.hashes(), words.left()
    runs = []
    for lag in range(1, min(plan.short, len(words) - 1) + 1):
        same = (hashes[:-lag] == hashes[lag:]) & (left[:-lag] > lag)
        for start, end in zip(*stretches(same), strict=True):
            if end - start + lag >= plan.enough(lag) and smallest(hashes, start, end + lag, lag):
                runs.append((start, end - start + lag, lag))
    # arrays of the texts that are long enough for the scale: place, room and hash of 2W words
    at, grams, size, width = np.arange(len(words)), hashes, 1, plan.short
    while True:
        long = words.counts[words.doc[at]] >= plan.enough(width + 1)
        if not long.any():
            break
        at, grams = at[long], grams[long]
        while size < 2 * width:
            grams = pair(grams, _ahead(grams, size, 0))
            size *= 2
        chosen = marks(grams, left[at] - size + 1, width)
        place, lag = seeds(at[chosen], grams[chosen], words.doc[at[chosen]], width)
        order = np.lexsort((place, lag))
        past, last = 0, None
        for start, step in zip(place[order].tolist(), lag[order].tolist(), strict=True):
            if step == last and start < past:
                continue  # in the stretch before
            doc = words.doc[start]
            begin, end = reach(hashes, start, step, int(words.first[doc]), int(words.first[doc + 1]))
            past, last = max(end, start + 1), step
            if end - begin + step >= plan.enough(step) and smallest(hashes, begin, end + step, step):
                runs.append((begin, end - begin + step, step))
        width *= 2
    table = np.array(sorted((int(a), -int(q), int(n)) for a, n, q in runs), dtype=np.int64).reshape(-1, 3)
    table = table[np.lexsort((-table[:, 1], table[:, 0]))]
    return np.stack([table[:, 0], table[:, 2], -table[:, 1]], axis=1)


def collapsed(words: Words, runs: np.ndarray) -> pa.Array:
    """Each text's words that no run holds after its first period, joined by one space."""
    n = len(words)
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(cover[:n]) == 0
    doc = words.doc[keep]
    # a space after every kept word but a text's last: there the text has a separator
    spaced = np.zeros(len(doc), dtype=bool)
    spaced[:-1] = doc[1:] == doc[:-1]
    gaps = words.ends[keep][spaced]
    data = words.data.copy()
    data[gaps] = 0x20
    chosen = np.zeros(len(data), dtype=bool)
    sizes = words.ends - words.starts
    chosen[words._inside] = np.repeat(keep, sizes)
    chosen[gaps] = True
    lengths = np.bincount(doc, sizes[keep] + spaced, len(words.counts)).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[chosen].tobytes())]
    return pa.Array.from_buffers(pa.string(), len(lengths), buffers)


def scan(batches, plan: Runs):
    """(doc_id, n_words, runs, text) of each row."""
    for part in slices(batches):
        words = Words(part.column(1))
        runs = found(words, plan)
        doc = words.doc[runs[:, 0]]
        listed = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(doc, np.arange(len(words.counts) + 1)).astype(np.int32)),
            pa.StructArray.from_arrays(
                [pa.array(runs[:, 0] - words.first[doc]), pa.array(runs[:, 1]), pa.array(runs[:, 2])],
                names=["start", "length", "period"],
            ),
        )
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(words.counts.astype(np.int64)), listed, collapsed(words, runs)],
            names=["doc_id", "n_words", "runs", "text"],
        )


def collapse(documents: DataFrame, plan: Runs = Runs()) -> DataFrame:
    """One row per document row: doc_id, n_words, runs (start, length, period; by start, then
    period) and text, the words that remain when of each run only its first period is kept,
    joined by one space.

    Map-only: a text is one task's work, in slices of about 2 MB of text or one longer text.
    A null or empty text has no words and no runs and gives an empty text; repeated rows and
    null ids are rows like any other; other columns are not read; an empty table gives an
    empty result.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(
        lambda batches: scan(batches, plan),
        f"doc_id long, n_words long, runs {RUNS}, text string",
    )


def planted(documents: DataFrame) -> DataFrame:
    """(doc_id, text): of one document in ten, by a hash of its id, the words from some place
    on repeat a piece of the text; a null id is left alone.

    With h = crc32(doc_id as text) and g = h / 10, where 10 divides h, word i >= a = g mod n
    becomes word a + (i - a) mod p, with p = 1 + (n - a) / (3 + g mod 8).
    """
    number = F.crc32(F.col("doc_id").cast("long").cast("string"))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.floor(number / 10).alias("g"),
        F.when(
            number % 10 == 0,
            F.regexp_extract_all(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)),
        ).alias("w"),
    )
    rows = rows.withColumn("a", F.expr("IF(size(w) > 0, cast(g % size(w) AS int), null)"))
    rows = rows.withColumn("p", F.expr("1 + cast(floor((size(w) - a) / (3 + g % 8)) AS int)"))
    repeated = F.expr(
        "array_join(transform(sequence(0, size(w) - 1), i -> w[IF(i < a, i, a + (i - a) % p)]), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def with_digest(runs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of most periods (ties: smallest start, then period) and digests
    of all runs and of the remaining words."""
    best = F.expr(
        "array_sort(runs, (x, y) -> CASE WHEN x.length * y.period > y.length * x.period THEN -1"
        " WHEN x.length * y.period < y.length * x.period THEN 1 WHEN x.start <> y.start THEN"
        " IF(x.start < y.start, -1, 1) ELSE cast(sign(x.period - y.period) AS int) END)"
    )
    lines = F.expr(
        "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    )
    return runs.select("*", F.get(best, F.lit(0)).alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("floor(1000 * best.length / best.period)").cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
        "n_words",
    )
