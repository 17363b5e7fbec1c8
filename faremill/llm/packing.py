"""Packing: token streams cut into windows by dynamic programming.

Documents keep their order. A stream may be cut after a document or after a sentence; the
program picks the cuts that minimise padding plus penalties for cut documents. The best
window that ends at a cut starts at one of the cuts within the window length, and as
padding falls by one with each token, the best start is the least of a sliding set: a
monotone queue gives it in constant time.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from faremill.llm.words import give_back, kept_in_worker, slices


@dataclass(frozen=True)
class Packing:
    """length: tokens of a window; end_id: closes each document; the penalties are in
    tokens of padding: for a window at all, for a cut after a sentence and within one.

    exact: the least power of two that is tried as the length of an unpadded window; step:
    within a sentence longer than this, cuts are allowed at this distance; flush:
    tokens that are planned together; cache: distinct words whose ids a task keeps: when there
    are more, the words that came in few slices of the text go.
    """

    tokenizer: str
    length: int = 2048
    end_id: int = 1
    window_cost: float = 12.0
    sentence_cost: float = 4.0
    inner_cost: float = 48.0
    step: int = 256
    exact: int = 128
    flush: int = 1 << 18
    cache: int = 100_000


SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long"
)


SIGNS = "!#$%&()*+,-./:;<=>?@[]^_{|}~"  # ASCII signs but quotes and the backslash
# letters up to U+024F, but for the one that becomes two in lower case
LETTERS = "^[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+$"
TAIL = "(?P<tail>[" + re.escape(SIGNS) + "]+)$"
SENTENCE_END = "[.!?…][\"'”»)]*$"


class ByteNames(dict):
    """For str.translate: how byte-level vocabularies spell a character."""

    def __missing__(self, code: int) -> str:
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self[code] = found = spell(chr(code))[0][0]
        return found


class WordTokens:
    """Token ids of texts. The tokenizer never joins what white space parts, so the ids of
    a text are those of its words in turn.

    Latin letters with signs behind, the usual word, are at most two units of the
    vocabulary's splitting rule, letters in lower case and signs (the apostrophe starts
    units of its own); each distinct unit goes to the merging step directly, and only once
    while it is kept. Other words are encoded whole.
    """

    def __init__(self, path: str, cache: int):
        # Spark's tasks already use all cores
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.cache = cache
        self.letters = ByteNames()
        self.known: dict[str, int] = {}  # number of each unit and each other word
        self.starts = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)
        self.seen = np.zeros(0, dtype=np.int64)  # slices that held it, later ones more
        self.ids = np.zeros(0, dtype=np.uint32)

    def forget(self, most: int) -> None:
        """Keep what came in several slices, at most that many units and words."""
        often = np.argsort(-self.seen, kind="stable")[:most]
        kept = np.sort(often[self.seen[often] > 1])
        names = list(self.known)
        self.known = {names[i]: k for k, i in enumerate(kept.tolist())}
        self.ids, self.starts = gather(self.ids, self.starts[kept], self.lengths[kept])
        self.lengths = self.lengths[kept]
        self.seen = (self.seen[kept] + 1) // 2

    def numbers(self, strings: pa.Array, encode) -> np.ndarray:
        """Numbers of distinct strings; those not known are encoded and kept."""
        names = strings.to_pylist()
        codes = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(codes < 0)
        if len(new):
            fresh = [names[i] for i in new.tolist()]
            first = len(self.known)
            self.known.update(zip(fresh, range(first, first + len(fresh)), strict=True))
            codes[new] = first + np.arange(len(fresh))
            found = encode(fresh)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            begin = len(self.ids) + np.cumsum(lengths) - lengths
            flat = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
            self.ids = np.concatenate([self.ids, flat])
            self.starts = np.concatenate([self.starts, begin])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.seen = np.concatenate([self.seen, np.zeros(len(fresh), dtype=np.int64)])
        self.seen[codes] += 1
        return codes

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """Letters beyond ASCII are spelt by the vocabulary's names for their bytes."""
        tokenize, letters = self.tokenizer.model.tokenize, self.letters
        return [
            [t.id for t in tokenize(unit if unit.isascii() else unit.translate(letters))]
            for unit in units
        ]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for at in range(0, len(words), 1024):
            part = self.tokenizer.encode_batch_fast(words[at : at + 1024], add_special_tokens=False)
            out += [x.ids for x in part]
        return out

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and where each word's begin and how
        many they are."""
        if len(self.known) > self.cache:
            self.forget(self.cache // 2)
        stems = pc.utf8_rtrim(words, characters=SIGNS)
        usual = pc.match_substring_regex(stems, LETTERS)
        is_usual = np.asarray(usual)
        parts = np.full((len(words), 2), -1, dtype=np.int64)
        lower = pc.utf8_lower(stems.filter(usual)).dictionary_encode()
        if len(lower):
            parts[is_usual, 0] = self.numbers(lower.dictionary, self.encode_units)[np.asarray(lower.indices)]
        signed = pc.and_(usual, pc.not_equal(pc.binary_length(stems), pc.binary_length(words)))
        tails = pc.struct_field(pc.extract_regex(words.filter(signed), TAIL), [0]).dictionary_encode()
        if len(tails):
            parts[np.asarray(signed), 1] = self.numbers(tails.dictionary, self.encode_units)[np.asarray(tails.indices)]
        others = words.filter(pc.invert(usual))
        if len(others):
            parts[~is_usual, 0] = self.numbers(others, self.encode_words)
        used = parts.ravel()[parts.ravel() >= 0]
        ids, _ = gather(self.ids, self.starts[used], self.lengths[used])
        lengths = np.where(parts >= 0, self.lengths[parts], 0).sum(axis=1)
        return ids, np.cumsum(lengths) - lengths, lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids in order; tokens of each text; token positions after each sentence."""
        split = pc.ascii_split_whitespace(texts)
        per_text = np.asarray(pc.list_value_length(split), dtype=np.int64)
        coded = split.flatten().dictionary_encode()
        if not len(coded):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64), np.zeros(0, np.int64)
        # white space at either end of a text leaves an empty word, which has no ids
        flat, starts, lengths = self.words(coded.dictionary)
        number = np.asarray(coded.indices)
        lengths = lengths[number]
        ends = np.cumsum(lengths)
        ids, _ = gather(flat, starts[number], lengths)
        word_ends = np.concatenate(([0], ends))[np.cumsum(per_text)]
        tokens = np.diff(np.concatenate(([0], word_ends)))
        stops = np.asarray(pc.match_substring_regex(coded.dictionary, SENTENCE_END))
        return ids, tokens, ends[stops[number]]


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of an array one after the other, and where each begins now."""
    begin = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    return values[np.repeat(starts - begin, lengths) + np.arange(total)], begin


def cut_points(ends: np.ndarray, sentences: np.ndarray, plan: Packing) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, from 0 on, and the penalty of each."""
    costs = np.zeros(int(ends[-1]) + 1)
    allowed = np.zeros(len(costs), dtype=bool)
    # a cut just before a document's closing id would leave that id alone
    inner = sentences[~np.isin(sentences + 1, ends)]
    allowed[inner] = True
    costs[inner] = plan.sentence_cost
    allowed[ends] = True
    allowed[0] = True
    costs[ends] = 0
    at = np.flatnonzero(allowed)
    gaps = np.flatnonzero(np.diff(at) > plan.step)
    for i in gaps:
        more = np.arange(at[i] + plan.step, at[i + 1], plan.step)
        allowed[more] = True
        costs[more] = plan.inner_cost
    at = np.flatnonzero(allowed)
    return at, costs[at]


def choose_cuts(at: np.ndarray, costs: np.ndarray, plan: Packing) -> list[int]:
    """Window ends of least padding plus penalties, the last point included.

    A window of a power of two tokens is not padded, so such exact lengths are tried too.
    """
    exact: dict[int, list[int]] = {}
    size = plan.exact
    while size < plan.length:
        before = np.searchsorted(at, at - size)
        for j in np.flatnonzero((at >= size) & (at[before] == at - size)):
            exact.setdefault(int(j), []).append(int(before[j]))
        size *= 2
    points, penalties = at.tolist(), costs.tolist()
    best, start = [0.0] * len(points), [0] * len(points)
    keyed = [0.0] * len(points)  # best + position: comparable among starts
    queue: deque[int] = deque([0])
    length, window = plan.length, plan.window_cost
    for j in range(1, len(points)):
        here = points[j]
        while here - points[queue[0]] > length:
            queue.popleft()
        i = queue[0]
        cost = keyed[i] + length - here
        for k in exact.get(j, ()):
            if best[k] < cost:
                cost, i = best[k], k
        best[j] = cost = cost + window + penalties[j]
        start[j] = i
        keyed[j] = key = cost + here
        while queue and keyed[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(points) - 1
    while j:
        cuts.append(points[j])
        j = start[j]
    return cuts[::-1]


class Stream:
    """Documents of one task that are not yet packed. done: tokens of the first that are."""

    def __init__(self, plan: Packing, first_sequence: int):
        self.plan, self.sequence = plan, first_sequence
        self.doc_ids: list = []
        self.ids = np.zeros(0, dtype=np.uint32)
        self.tokens = np.zeros(0, dtype=np.int64)
        self.sentences = np.zeros(0, dtype=np.int64)
        self.done = 0

    def add(self, doc_ids: list, ids: np.ndarray, tokens: np.ndarray, sentences: np.ndarray) -> None:
        """ids: without closing ids; sentences: positions in ids."""
        ends = np.cumsum(tokens)
        before = np.searchsorted(ends, sentences, side="left")  # documents closed before
        base = len(self.ids)
        self.ids = np.concatenate([self.ids, np.insert(ids, ends, self.plan.end_id)])
        self.sentences = np.concatenate([self.sentences, sentences + before + base])
        self.tokens = np.concatenate([self.tokens, tokens + 1])
        self.doc_ids += doc_ids

    def flush(self, last: bool) -> pa.RecordBatch | None:
        """Packs what is there; unless last, all but the last window, which may still grow."""
        if not len(self.tokens):
            return None
        left = self.tokens.copy()
        left[0] -= self.done
        ends = np.cumsum(left)
        cuts = np.array(choose_cuts(*cut_points(ends, self.sentences, self.plan), self.plan))
        if not last:
            cuts = cuts[:-1]
        if not len(cuts):
            return None
        stop = int(cuts[-1])
        edges = np.unique(np.concatenate(([0], cuts, ends[ends < stop])))
        begin, end = edges[:-1], edges[1:]
        doc = np.searchsorted(ends, begin, side="right")
        window = np.searchsorted(cuts, begin, side="right")
        begins = np.concatenate(([0], cuts))[window]
        heads = ends - left
        start = begin - heads[doc] + np.where(doc == 0, self.done, 0)
        blob = self.ids[:stop].astype("<u4").tobytes()
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([self.doc_ids[i] for i in doc], pa.int64()),
                pa.array(start),
                pa.array(end - begin),
                pa.array([blob[4 * a : 4 * b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary()),
                pa.array(self.tokens[doc]),
                pa.array(window + self.sequence),
                pa.array(begin - begins),
            ],
            names=[x.split()[0] for x in SCHEMA.split(", ")],
        )
        self.sequence += len(cuts)
        gone = int(np.searchsorted(ends, stop, side="right"))
        cut_in = stop - int(heads[gone]) if gone < len(ends) else 0
        self.done = cut_in + (self.done if gone == 0 else 0)
        self.doc_ids, self.tokens = self.doc_ids[gone:], self.tokens[gone:]
        self.ids = self.ids[stop:]
        self.sentences = self.sentences[self.sentences > stop] - stop
        return batch


def pack_texts(batches, plan: Packing, task: int) -> Iterator[pa.RecordBatch]:
    encoder = kept_in_worker(
        f"words of {plan.tokenizer}", lambda: WordTokens(plan.tokenizer, plan.cache)
    )
    stream = Stream(plan, task << 40)
    for batch in slices(batches, most_bytes=1 << 20):
        ids, tokens, sentences = encoder.encode(batch.column(1).fill_null(""))
        stream.add(batch.column(0).to_pylist(), ids, tokens, sentences)
        if len(stream.ids) >= plan.flush and (packed := stream.flush(last=False)):
            yield packed
    if packed := stream.flush(last=True):
        yield packed
    # the worker may go on to tasks of another kind
    encoder.forget(plan.cache // 8)
    give_back()


def pack(documents: DataFrame, plan: Packing) -> DataFrame:
    """One row per piece: token ids start to start + length of a document, at an offset of
    a sequence; ids are little-endian unsigned 32-bit numbers.

    Documents are packed in the order of the table within each task's share of it, so
    nothing is shuffled and memory is bounded by the flush size or one longer text. Only
    the last sequence of a task is padded for want of documents. A null or empty text is
    its closing id alone; a null doc_id and repeated rows are packed like any other row.
    An empty table gives no rows. sequence_id is the task's number and a count within it.
    """
    if not isinstance(documents.schema["doc_id"].dataType, IntegralType):
        raise TypeError("doc_id must be a whole number")
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def packed(batches):
        yield from pack_texts(batches, plan, TaskContext.get().partitionId())

    return rows.mapInArrow(packed, SCHEMA)


def with_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids instead of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
