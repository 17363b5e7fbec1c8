"""Language-model scores by context-tree weighting over binary decisions of bytes.

Each byte is eight binary decisions, told apart by the bits before. Each decision has a
tree of the bytes before it: a Krichevsky-Trofimov estimate at every depth, mixed by the
weights that context-tree weighting gives to stopping there or looking further back.
Every context of the training bytes is kept. Contexts that end in the same two bytes are
weighed together in a task; the driver weighs only what is above them. The texts are read
in chunks, and each chunk gets the costs of its own distinct strings, so no task or
machine holds the whole model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.storage import discard, written
from faremill.llm.words import Words, mix, slices, text_bytes

_U = np.uint64
END = 0xFF  # no UTF-8 text has this byte; it ends each text and stands before its start


@dataclass(frozen=True)
class Model:
    """depth: bytes of context at most, up to 7; share: 0 keeps every context, otherwise one
    with less than one in so many training bytes is part of the rest leaf of the context one
    byte shorter; head: the most frequent words, so many at most, whose counts are broadcast
    while those of the others are joined; chunk: bytes of text that share a table of costs;
    part: distinct strings of a task that weighs contexts, on average;
    folds, held: documents whose crc32(doc_id) mod folds is held are not learned from."""

    depth: int = 6
    share: int = 0
    head: int = 1 << 19
    chunk: int = 1 << 26
    part: int = 1 << 19
    folds: int = 5
    held: int = 1


@dataclass
class Tree:
    """child: for each context and byte before it, the longer context or -1; cost: log10
    probability of each byte after each context. The dense form, for small trees."""

    child: np.ndarray
    cost: np.ndarray


def lowered(texts: pa.Array) -> pa.Array:
    """Texts with A to Z in lower case, other characters as they are."""
    data, offsets = text_bytes(texts)
    upper = (data >= 65) & (data <= 90)
    data = data + (upper * np.uint8(32)).astype(np.uint8)
    return pa.Array.from_buffers(
        pa.large_string(), len(texts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    )


def symbols(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array with ends and room before each; the places to code; their texts."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    length = np.diff(offsets)
    out = np.full(len(data) + n * (depth + 1), END, dtype=np.uint8)
    doc = np.repeat(np.arange(n), length)
    out[np.arange(len(data)) + doc * (depth + 1) + depth] = data
    coded = np.repeat(np.arange(n), length + 1)
    places = np.arange(len(data) + n) + (coded + 1) * depth
    return out, places, coded


class Counter:
    """Counts of 64-bit keys with a second key, merged as they come."""

    def __init__(self, most: int = 1 << 22):
        self.most, self.parts, self.size = most, [], 0

    def add(self, key: np.ndarray, check: np.ndarray, n: np.ndarray | None = None) -> None:
        if n is None and not check.any():
            key, n = np.sort(key), np.ones(len(key), np.int64)  # far faster than argsort
        else:
            order = np.argsort(key)
            key, check = key[order], check[order]
            n = np.ones(len(key), np.int64) if n is None else n[order]
        new = np.ones(len(key), dtype=bool)
        # equal keys with unlike checks are as good as never met: they may stay apart
        new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
        at = np.flatnonzero(new)
        if not len(at):
            return
        self.parts.append((key[at], check[at], np.add.reduceat(n, at)))
        self.size += len(at)
        if self.size > self.most and len(self.parts) > 1:
            self.merge()

    def merge(self) -> None:
        parts, self.parts, self.size = self.parts, [], 0
        if parts:
            most, self.most = self.most, 1 << 62
            self.add(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            self.most = most

    def take(self):
        self.merge()
        parts, self.parts, self.size = self.parts, [], 0
        return parts


GATHERED = "kind byte, chunk long, key long, check int, n long, strings binary, times binary"
_PLACES = 1 << 10  # places that two-byte contexts are dealt to


def rows_of(kind: int, chunk: int, key, check, n, strings=None, times=None) -> pa.RecordBatch:
    """A batch of the columns of GATHERED."""
    none = pa.nulls(len(key), pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(key), kind, dtype=np.int8)),
            pa.array(np.full(len(key), chunk, dtype=np.int64)),
            pa.array(key.view(np.int64)),
            pa.array(check),
            pa.array(n),
            none if strings is None else pa.array(strings, pa.binary()),
            none if times is None else pa.array(times, pa.binary()),
        ],
        names=["kind", "chunk", "key", "check", "n", "strings", "times"],
    )


def packed(values: np.ndarray) -> bytes:
    """8-byte values, byte by byte of all of them, compressed."""
    return pa.compress(values.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, n: int, kind) -> np.ndarray:
    found = np.frombuffer(pa.decompress(data, 8 * n, "zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(found.reshape(8, n).T).view(kind).ravel()


def unpacked_strings(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpacked(data, n, np.uint64), dtype=np.uint64)


def string_rows(counter: Counter, chunk: int):
    """The strings of a chunk and their counts, a row for each place of their last two bytes
    of context: ascending, as steps from one to the next."""
    for key, _, n in counter.take():
        place = (mix((key >> _U(8)) & _U(0xFFFF)) % _U(_PLACES)).astype(np.uint16)
        order = np.argsort(place, kind="stable")
        key, n, place = key[order], n[order].astype(np.int64), place[order]
        edges = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1, [len(key)]))
        spans = list(zip(edges[:-1], edges[1:], strict=True))
        yield rows_of(
            0,
            chunk,
            place[edges[:-1]].astype(np.int64),
            np.zeros(len(spans), np.int32),
            np.diff(edges),
            [packed(np.diff(key[a:b], prepend=_U(0))) for a, b in spans],
            [packed(n[a:b]) for a, b in spans],
        )


def word_rows(counter: Counter):
    for part in counter.take():
        yield rows_of(1, 0, *part)


def word_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of hash for each word."""
    hashes = words.hashes()
    return hashes, (mix(words.hashes(1) + _U(3)) >> _U(33)).astype(np.int32)


def chunks(batches, plan: Model):
    """Slices of texts with the number of their chunk, the same for the same partition."""
    first, done = TaskContext.get().partitionId() << 32, 0
    for batch in slices(batches):
        yield first + done // plan.chunk, batch
        done += batch.column(batch.schema.get_field_index("text")).nbytes


def strings(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place to code, its byte and the bytes before as a key; its text."""
    stream, places, doc = symbols(texts, depth)
    key = np.zeros(len(places), dtype=np.uint64)
    for d in range(depth + 1):
        key |= stream[places - d].astype(np.uint64) << _U(8 * d)
    return key, doc


def gather(batches, plan: Model):
    """Kind 0: distinct bytes with the bytes before of each chunk, with their count in
    training texts, which may be 0; kind 1: words of the training texts. Columns of the
    batches: held_out, text."""
    grams, vocabulary, last = Counter(), Counter(), None
    for chunk, batch in chunks(batches, plan):
        if chunk != last and last is not None:
            yield from string_rows(grams, last)
        last = chunk
        held = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), dtype=bool)
        for out in (False, True):
            own = pa.array(held == out)
            texts = lowered(batch.column(1).filter(own))
            if not len(texts):
                continue
            key, _ = strings(texts, plan.depth)
            if out:
                key = np.unique(key)
                grams.add(key, np.zeros(len(key), np.int32), np.zeros(len(key), np.int64))
            else:
                grams.add(key, np.zeros(len(key), np.int32))
                vocabulary.add(*word_keys(Words(texts)))
        if grams.size > grams.most:
            yield from string_rows(grams, chunk)
        if vocabulary.size > vocabulary.most:
            yield from word_rows(vocabulary)
    if last is not None:
        yield from string_rows(grams, last)
    yield from word_rows(vocabulary)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x of 0.5 or more, to about 1e-11."""
    shift = np.zeros_like(x)
    x = x.copy()
    while (small := x < 10).any():
        shift[small] += np.log(x[small])
        x[small] += 1
    inverse = 1 / (x * x)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse / 1680))) / x
    return (x - 0.5) * np.log(x) - x + 0.9189385332046727 + series - shift


_FEW = np.arange(1 << 12)
_FEW_HALF, _FEW_WHOLE = log_gamma(_FEW + 0.5), log_gamma(_FEW + 1.0)


def log_gamma_of(counts: np.ndarray, more: float, few: np.ndarray) -> np.ndarray:
    """log of the gamma function of whole counts and `more`; few: the same of small counts."""
    out = few[np.minimum(counts, len(few) - 1).astype(np.int64)]
    if (many := counts >= len(few)).any():
        out[many] = log_gamma(counts[many] + more)
    return out


def block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    sides = log_gamma_of(zeros, 0.5, _FEW_HALF) + log_gamma_of(ones, 0.5, _FEW_HALF)
    return sides - log_gamma_of(zeros + ones, 1.0, _FEW_WHOLE) - np.log(np.pi)


def decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of 256 byte counts, zeros and ones of each of the 255 binary decisions.

    Decision 2^b + p is that of bit b after the bits p, as in a heap from 1 on.
    """
    zeros, ones = np.zeros_like(counts), np.zeros_like(counts)
    level = counts
    for b in range(7, -1, -1):
        pairs = level.reshape(len(counts), 1 << b, 2)
        zeros[:, 1 << b : 2 << b], ones[:, 1 << b : 2 << b] = pairs[:, :, 0], pairs[:, :, 1]
        level = pairs.sum(axis=2)
    return zeros, ones


def estimate(counts: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov chance of a one at each decision."""
    zeros, ones = decisions(counts)
    return (ones + 0.5) / (zeros + ones + 1.0)


def weigh(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Tree:
    """The tree from its contexts by depth: keys, parents' rows in the level above, counts.

    Bottom-up: the weighted probability of a context is the mean of its own estimate's and
    the product of those of the longer contexts and of the rest leaf. Top-down: the chance
    of a one is the estimates along the path, each with the weight of stopping there.
    """
    depth = len(levels)
    weights: list[np.ndarray] = [np.zeros(0)] * depth
    rests: list[np.ndarray] = [np.zeros(0)] * depth
    below = None
    for d in range(depth - 1, -1, -1):
        _, _, counts = levels[d]
        own = block(*decisions(counts))
        if d + 1 < depth and len(levels[d + 1][0]):
            parent = levels[d + 1][1]
            rest = counts.copy()
            np.subtract.at(rest, parent, levels[d + 1][2])
            split = block(*decisions(rest))
            np.add.at(split, parent, below)
            has = np.zeros(len(counts), dtype=bool)
            has[parent] = True
            both = np.logaddexp(own, split) - np.log(2)
            stop = np.where(has[:, None], np.exp(own - np.log(2) - both), 1.0)
            below = np.where(has[:, None], both, own)
        else:
            stop, below, rest = np.ones_like(own), own, counts
        rests[d] = estimate(rest).astype(np.float32)
        weights[d] = stop.astype(np.float32)
    base = np.cumsum([0, *(len(x[0]) for x in levels)])
    child = np.full((base[-1], 256), -1, dtype=np.int32)
    cost = np.zeros((base[-1], 256), dtype=np.float32)
    mixed, left = None, None
    for d, (keys, parent, counts) in enumerate(levels):
        if not len(keys):
            continue
        before, room = (0.0, 1.0) if d == 0 else (mixed[parent], left[parent])
        mixed = before + room * weights[d] * estimate(counts)
        left = room * (1 - weights[d])
        ones = np.clip(mixed + left * rests[d], 1e-12, 1 - 1e-12)
        total = np.zeros((len(keys), 1))
        for b in range(8):
            at = ones[:, 1 << b : 2 << b]
            total = (total[:, :, None] + np.log10(np.stack([1 - at, at], axis=2))).reshape(len(keys), -1)
        cost[base[d] : base[d + 1]] = total
        if d:
            last = (keys >> (8 * (d - 1))) & 255
            child[base[d - 1] + parent, last] = base[d] + np.arange(len(keys))
    return Tree(child, cost)


TOP = 2  # bytes that contexts weighed in one task have in common


@dataclass
class Level:
    """Decisions of the contexts of one length that occur in some strings.

    code: the bits before the decision, then the context from its last byte on, ascending;
    kept: whether the context is told apart; below: log of the weighted probability; stop:
    weight of stopping; rest: chance of a one in the rest leaf; total, has: training bytes
    of the context and whether a longer one is kept; parent: places in the level above.
    """

    code: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    total: np.ndarray
    kept: np.ndarray
    below: np.ndarray
    stop: np.ndarray
    rest: np.ndarray
    has: np.ndarray
    parent: np.ndarray | None = None

    def chance(self) -> np.ndarray:
        return (self.ones + 0.5) / (self.zeros + self.ones + 1.0)


def deepest(code, zeros, ones, total, least: float, below=None) -> Level:
    own = block(zeros, ones) if below is None else below
    still = np.ones(len(code))
    return Level(code, zeros, ones, total, total >= least, own, still, still / 2, still > 1)


def shorter(longer: Level, least: float, context: Level | None, bits: int) -> Level:
    """The level above; sets the parents of the longer one. context: the level above for
    the first decision of a byte, one for each context; bits: of a context there."""
    code = longer.code >> _U(8)
    new = np.ones(len(code), dtype=bool)
    new[1:] = code[1:] != code[:-1]
    longer.parent, code = np.cumsum(new) - 1, code[new]

    def summed(x):
        return np.bincount(longer.parent, x, len(code))

    zeros, ones = summed(longer.zeros), summed(longer.ones)
    rest0, rest1 = summed(longer.zeros * ~longer.kept), summed(longer.ones * ~longer.kept)
    split = summed(longer.below * longer.kept) + block(rest0, rest1)
    if context is None:
        total, has = zeros + ones, summed(longer.kept.astype(float)) > 0
    else:
        at = np.searchsorted(context.code, code & _U((1 << bits) - 1))
        total, has = context.total[at], context.has[at]
    own = block(zeros, ones)
    both = np.logaddexp(own, split) - np.log(2)
    return Level(
        code,
        zeros,
        ones,
        total,
        (total >= least) if bits else np.ones(len(code), dtype=bool),
        np.where(has, both, own),
        np.where(has, np.exp(own - np.log(2) - both), 1.0),
        (rest1 + 0.5) / (rest0 + rest1 + 1.0),
        has,
    )


def climbed(level: Level, depth: int, until: int, least: float, first: list[Level]) -> list[Level]:
    """The level of this depth and those above, down to length until. first: the same for
    the first decision of a byte, empty for that itself."""
    out = [level]
    for d in range(depth - 1, until - 1, -1):
        context = first[depth - d] if first else None
        out.append(shorter(out[-1], least, context, 8 * d))
    return out


def descended(levels: list[Level], mixed, left, rest) -> np.ndarray:
    """Chance of a one at each decision of the deepest level (the first in the list), from
    what the level above the last one has, at the places of its own."""
    for i in range(len(levels) - 1, -1, -1):
        level = levels[i]
        mixed = mixed + left * np.where(level.kept, level.stop * level.chance(), rest)
        left = left * np.where(level.kept, 1 - level.stop, 0.0)
        if i:
            parent = levels[i - 1].parent
            mixed, left, rest = mixed[parent], left[parent], level.rest[parent]
    return mixed


def read_lists(batches) -> list[tuple[int, bytes, np.ndarray, np.ndarray]]:
    """Chunk, packed strings, strings and counts of each row."""
    out = []
    for x in batches:
        for chunk, n, strings, times in zip(*(x.column(i).to_pylist() for i in range(1, 5)), strict=True):
            out.append((chunk, strings, unpacked_strings(strings, n), unpacked(times, n, np.int64)))
    return out


def merged(lists) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings of the lists, ascending, and their counts."""
    if not lists:
        return np.zeros(0, np.uint64), np.zeros(0)
    every = np.sort(np.concatenate([x[2] for x in lists]))
    key = every[np.concatenate(([True], every[1:] != every[:-1]))]
    n = np.zeros(len(key))
    for _, _, own, times in lists:
        n[np.searchsorted(key, own)] += times
    return key, n


def grown(key: np.ndarray, n: np.ndarray, plan: Model, least: float):
    """For each bit of a byte: its number, place of each string in the deepest level, bit
    of each string, levels down to that of the contexts weighed in one task."""
    byte, first = key & _U(255), []
    for b in range(8):
        code = byte >> _U(8 - b)
        for d in range(1, plan.depth + 1):
            code = (code << _U(8)) | ((key >> _U(8 * d)) & _U(255))
        distinct, place = np.unique(code, return_inverse=True)
        bit = ((byte >> _U(7 - b)) & _U(1)).astype(bool)
        zeros = np.bincount(place, n * ~bit, len(distinct))
        ones = np.bincount(place, n * bit, len(distinct))
        total = zeros + ones
        if first:
            total = first[0].total[
                np.searchsorted(first[0].code, distinct & _U((1 << 8 * plan.depth) - 1))
            ]
        levels = climbed(
            deepest(distinct, zeros, ones, total, least), plan.depth, min(TOP, plan.depth), least, first
        )
        first = first or levels
        yield b, place, bit, levels


def weigh_up(batches, plan: Model, least: float):
    """What the longest contexts give to those of two bytes, a row for each decision."""
    key, n = merged(read_lists(batches))
    if len(key):
        for b, _, _, levels in grown(key, n, plan, least):
            x = levels[-1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(x.code), b, dtype=np.int8)),
                    pa.array(x.code.view(np.int64)),
                    *(pa.array(c) for c in (x.zeros, x.ones, x.total, x.below)),
                ],
                names=["bit", "code", "zeros", "ones", "total", "below"],
            )


def weigh_top(table: pa.Table, plan: Model, least: float) -> list[tuple]:
    """For each bit of a byte, the decisions of contexts of one byte: codes, chances of a
    one so far, weight left, chances in the rest leaf."""
    top = min(TOP, plan.depth)
    columns = [np.asarray(table.column(i)) for i in range(6)]
    out, first = [], []
    for b in range(8):
        own = columns[0] == b
        code, zeros, ones, total, below = (c[own] for c in columns[1:])
        order = np.argsort(code)
        code, zeros, ones, total, below = (c[order] for c in (code, zeros, ones, total, below))
        level = deepest(code.view(np.uint64), zeros, ones, total, least, below)
        levels = climbed(level, top, 0, least, first)
        first = first or levels
        mixed, left, rest = np.zeros(1), np.ones(1), np.full(1, 0.5)
        for d in range(len(levels) - 1, 0, -1):
            x = levels[d]
            if d < len(levels) - 1:
                mixed, left, rest = mixed[x.parent], left[x.parent], rest[x.parent]
            mixed = mixed + left * np.where(x.kept, x.stop * x.chance(), rest)
            left, rest = left * np.where(x.kept, 1 - x.stop, 0.0), x.rest
        out.append((levels[1].code, mixed, left, rest))
    return out


def weigh_down(batches, plan: Model, least: float, above: list[tuple]):
    """Each list of strings with log10 of the chance of each one's last byte after the bytes
    before, in its order."""
    lists = read_lists(batches)
    key, n = merged(lists)
    if not len(key):
        return
    cost = np.zeros(len(key))
    for b, place, bit, levels in grown(key, n, plan, least):
        code, mixed, left, rest = above[b]
        at = np.searchsorted(code, levels[-1].code >> _U(8))
        one = np.clip(descended(levels, mixed[at], left[at], rest[at])[place], 1e-12, 1 - 1e-12)
        cost += np.log10(np.where(bit, one, 1 - one))
    for chunk, strings, own, _ in lists:
        costs = packed(cost[np.searchsorted(key, own)])
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk]), pa.array([len(own)]), pa.array([strings], pa.binary()), pa.array([costs], pa.binary())],
            names=["chunk", "n", "strings", "costs"],
        )


def costs_of(lists: DataFrame, plan: Model) -> DataFrame:
    """The lists of strings by chunk (place, chunk, n, strings, times) with the costs of their
    strings by the tree of all counts."""
    rows = int(lists.agg(F.sum("n")).first()[0] or 0)
    training = 0
    if plan.share:
        totals = lists.select("n", "times").mapInArrow(string_totals, "total long")
        training = int(totals.agg(F.sum("total")).first()[0] or 0)
    least = max(1.0, training / plan.share) if plan.share else 1.0
    shards = max(lists.sparkSession.sparkContext.defaultParallelism, -(-rows // (4 * plan.part)))
    dealt = lists.repartition(shards, "place")
    top = written(
        dealt.mapInArrow(
            lambda batches: weigh_up(batches, plan, least),
            "bit byte, code long, zeros double, ones double, total double, below double",
        ),
        "decisions",
    )
    table = top.toArrow()  # at most 255 decisions of each two bytes
    discard(top)
    above = lists.sparkSession.sparkContext.broadcast(weigh_top(table, plan, least) if rows else [])
    return dealt.mapInArrow(
        lambda batches: weigh_down(batches, plan, least, above.value),
        "chunk long, n long, strings binary, costs binary",
    )


def string_totals(batches):
    for x in batches:
        sums = [int(unpacked(t, n, np.int64).sum()) for n, t in zip(*(x.column(i).to_pylist() for i in range(2)), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int64())], names=["total"])


def score_texts(batches, plan: Model, own, head: np.ndarray, head_score: np.ndarray, unknown: float):
    """For each row: tokens, those of the head and their score, the model's score, bytes,
    and the other words with their counts. own: strings, ascending, and their costs."""
    strings_, costs = own
    for batch in slices(batches):
        texts = lowered(batch.column(3))
        key, doc = strings(texts, plan.depth)
        distinct, number = np.unique(key, return_inverse=True)
        at = np.minimum(np.searchsorted(strings_, distinct), len(strings_) - 1)
        if len(strings_) == 0 or (strings_[at] != distinct).any():
            raise RuntimeError("the documents were dealt out in another way than at first")
        score = np.bincount(doc, costs[at][number], len(batch))
        words = Words(texts)
        key, check = word_keys(words)
        distinct, number = np.unique(key, return_inverse=True)
        at = np.searchsorted(head, distinct)
        at[at == len(head)] = 0
        common = (head[at] == distinct) if len(head) else np.zeros(len(distinct), dtype=bool)
        known = common[number]
        base = np.zeros(len(batch))
        if known.any():
            worth = head_score[at][number[known]]
            base = np.bincount(words.doc[known], worth, len(batch))
        n_known = np.bincount(words.doc[known], minlength=len(batch))
        # other words, once for each text, with their counts
        other = np.flatnonzero(~known)
        # by text, then by word: numbers of distinct words stand for their hashes
        order = other[np.argsort(words.doc[other] * (len(distinct) + 1) + number[other])]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (key[order[1:]] != key[order[:-1]]) | (words.doc[order[1:]] != words.doc[order[:-1]])
        first = np.flatnonzero(new)
        times = np.diff(np.concatenate((first, [len(order)])))
        rest = order[first]
        edges = np.searchsorted(words.doc[rest], np.arange(len(batch) + 1)).astype(np.int32)
        tail = pa.ListArray.from_arrays(
            pa.array(edges),
            pa.StructArray.from_arrays(
                [pa.array(key[rest].view(np.int64)), pa.array(check[rest]), pa.array(times.astype(np.int32))],
                names=["key", "check", "times"],
            ),
        )
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(i) for i in range(3)),
                pa.array(words.counts + 1),
                pa.array(n_known.astype(np.int64)),
                pa.array(base + unknown),
                pa.array(score),
                pa.array(np.bincount(doc, minlength=len(batch)).astype(np.int64)),
                tail,
            ],
            names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "n_symbols", "tail"],
        )


def least_of_head(vocabulary: DataFrame, plan: Model) -> float:
    """A count that at most `head` words reach; from counts of words by size, a few hundred."""
    size = F.floor(F.log2(F.col("n").cast("double")) * 16).alias("size")
    rows = vocabulary.groupBy(size).agg(F.count(F.lit(1)).alias("words")).collect()
    words, least = 0, float("inf")
    for r in sorted(rows, key=lambda r: -r["size"]):
        words += r["words"]
        if words > plan.head:
            break
        least = 2.0 ** (r["size"] / 16) * (1 - 1e-12)
    return least


def score(documents: DataFrame, plan: Model = Model()) -> DataFrame:
    """One row per document row: base_score of a word unigram and score of the tree, log10.

    Letters A to Z count as lower case. A text is its words and one end for the unigram,
    its bytes and one end for the tree; a null text is empty and has only its end. A null
    doc_id has no fold: it is learned from and not held out. Repeated rows count and are
    scored as often as they occur. Without training texts every byte has an even chance.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(plan.folds))
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold == plan.held, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    training = rows.filter(~F.col("held_out")).select("text")
    counts = written(
        rows.select("held_out", "text").mapInArrow(
            lambda batches: gather(batches, plan), GATHERED
        ),
        "counts",
    )
    lists = counts.filter("kind = 0").select(F.col("key").alias("place"), "chunk", "n", "strings", "times")
    own = costs_of(lists, plan)
    vocabulary = written(
        counts.filter("kind = 1").groupBy("key", "check").agg(F.sum("n").alias("n")), "vocabulary"
    )
    # every training text has one end
    ends = training.count()
    words, kinds = vocabulary.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, distinct = int(words or 0) + ends, int(kinds) + (1 if ends else 0)
    floor = tokens + 0.5 * (distinct + 1)
    often = F.col("n") >= least_of_head(vocabulary, plan)
    top = vocabulary.filter(often).toArrow()  # at most `head` words
    key = np.asarray(top.column("key")).view(np.uint64)
    order = np.argsort(key)
    head = key[order]
    head_score = np.log10((np.asarray(top.column("n"))[order] + 0.5) / floor)
    end_score = float(np.log10((ends + 0.5) / floor))
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((head, head_score))
    read = "row long, doc_id long, held_out boolean, text string, chunk long"

    def numbered(batches):
        for chunk, batch in chunks(batches, plan):
            chunk = pa.array(np.full(len(batch), chunk, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, chunk], names=[*batch.schema.names, "chunk"]
            )

    def scored(texts: pa.Table, own: pa.Table) -> pa.Table:
        n, strings, costs = (own.column(i).to_pylist() for i in (1, 2, 3))
        key = np.concatenate([np.zeros(0, np.uint64), *map(unpacked_strings, strings, n)])
        cost = np.concatenate([np.zeros(0), *(unpacked(c, m, np.float64) for c, m in zip(costs, n, strict=True))])
        order = np.argsort(key)
        own = key[order], cost[order]
        return pa.Table.from_batches(
            score_texts(texts.to_batches(), plan, own, *shared.value, end_score), arrow_schema
        )

    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
        "score double, n_symbols long, tail array<struct<key:long,check:int,times:int>>"
    )
    word = pa.struct([("key", pa.int64()), ("check", pa.int32()), ("times", pa.int32())])
    arrow_schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_())]
        + [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64())]
        + [("score", pa.float64()), ("n_symbols", pa.int64()), ("tail", pa.list_(word))]
    )
    texts = rows.select("row", "doc_id", "held_out", "text").mapInArrow(numbered, read)
    found = written(
        texts.groupBy("chunk").cogroup(own.groupBy("chunk")).applyInArrow(scored, schema), "scores"
    )
    discard(counts)
    tail = found.select("row", F.explode("tail").alias("w")).select(
        "row", F.col("w.key").alias("key"), F.col("w.check").alias("check"), F.col("w.times").alias("times")
    )
    rest = (
        tail.join(vocabulary.filter(~often), ["key", "check"], "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
            F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(floor))).alias("rest"),
        )
    )
    end_known = 1 if ends else 0
    return found.drop("tail").join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0)) + end_known).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        "score",
        (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_symbols")).alias("bits_per_byte"),
    )
