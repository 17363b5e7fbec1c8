"""Quality rules: bands for how well a text compresses.

zstandard shrinks prose by a factor that depends little on the text and much on its
length. Text that shrinks far more repeats itself; text that hardly shrinks is noise, such
as encoded data. The whole document and fixed chunks of it are held against the bands.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from faremill.llm.words import IS_WORD, Words, grams, mix, pair, slices

SYMBOLS = "#*$%&|<>"
WINDOW = 8
_IS_SYMBOL = np.zeros(256, dtype=np.int64)
_IS_SYMBOL[list(SYMBOLS.encode())] = 1
_BLANK = " \t\n\v\f\r"


@dataclass(frozen=True)
class Bands:
    """Allowed bytes before over bytes after compression.

    limits: (log2 of the bytes, least, most) of the whole text, straight lines between;
    chunk: bytes of a chunk, which has the least of its own length and chunk_most. A text
    is rejected outside its band, or if more than bad_share of its chunks are outside
    theirs. The last chunk ends with the text and may overlap the one before; a shorter
    text is one chunk. The band for a length leaves a margin around all labelled good texts.
    """

    limits: tuple[tuple[float, float, float], ...] = (
        (6, 0.8, 1.7),
        (7, 1.0, 1.75),
        (8, 1.15, 1.85),
        (9, 1.25, 1.98),
        (10, 1.35, 2.12),
        (11, 1.5, 2.24),
        (12, 1.6, 2.37),
        (13, 1.65, 2.46),
        (14, 1.65, 2.53),
        (15, 1.65, 2.62),
        (16, 1.65, 2.72),
        (17, 1.65, 2.82),
        (20, 1.65, 3.2),
        (24, 1.65, 4.0),
    )
    chunk: int = 1024
    chunk_most: float = 2.06
    bad_share: float = 0.1
    level: int = 3


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, n_bytes long, "
    "ratio double, n_chunks long, n_bad_chunks long"
)


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a value for each byte over each text."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(words: Words, window: int = WINDOW) -> np.ndarray:
    """For each text, words in windows that the text holds twice or more."""
    out = np.zeros(len(words.counts), dtype=np.int64)
    starts = np.flatnonzero(words.left() >= window)
    if not len(starts):
        return out
    keys = pair(grams(words.hashes(), window)[starts], mix(words.doc[starts].astype(np.uint64)))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covered, starts[twice], 1)
    np.add.at(covered, starts[twice] + window, -1)
    inside = np.cumsum(covered[:-1]) > 0
    np.add.at(out, words.doc[inside], 1)
    return out


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[str] = set()
    found = 0
    for line in text.split("\n"):
        if line.strip(_BLANK):
            found += line in seen
            seen.add(line)
    return found


def compression(text: bytes, packer: zstandard.ZstdCompressor, bands: Bands) -> tuple[bool, float, int, int]:
    """Whether the text is within its bands; its ratio, chunks and bad ones."""
    if not text:
        return True, 1.0, 0, 0
    ratio = len(text) / len(packer.compress(text))
    sizes, least, most = zip(*bands.limits, strict=True)
    low, high = (np.interp(math.log2(len(text)), sizes, x) for x in (least, most))
    good = bool(low <= ratio <= high)
    if len(text) <= bands.chunk:
        return good, ratio, 1, int(not good)
    chunk_least = np.interp(math.log2(bands.chunk), sizes, least)
    last = len(text) - bands.chunk
    starts = [*range(0, last, bands.chunk), last]
    bad = 0
    for at in starts:
        part = bands.chunk / len(packer.compress(text[at : at + bands.chunk]))
        bad += not chunk_least <= part <= bands.chunk_most
    chunks = len(starts)
    good = good and bad <= bands.bad_share * chunks
    return good, ratio, chunks, bad


def judge_texts(batches, bands: Bands):
    packer = zstandard.ZstdCompressor(level=bands.level)
    for batch in slices(batches):
        texts = batch.column(1).fill_null("")
        words = Words(texts)
        n_words = words.counts
        heads = (words.data & 0xC0) != 0x80
        repeats = repeated_words(words)
        lines = np.array([repeated_lines(x) for x in texts.to_pylist()], dtype=np.int64)
        failed = (n_words < 20) | (100 * repeats > 30 * n_words)
        found = [
            compression(words.data[a:b].tobytes(), packer, bands)
            for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)
        ]
        good, ratio, chunks, bad = (np.array(x) for x in zip(*found, strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n_words),
                pa.array(per_text(heads & IS_WORD[words.data], words.offsets)),
                pa.array(per_text(_IS_SYMBOL[words.data], words.offsets)),
                pa.array(lines),
                pa.array(repeats),
                pa.array(failed),
                pa.array(good & ~failed),
                pa.array(np.diff(words.offsets)),
                pa.array(ratio.astype(np.float64)),
                pa.array(chunks.astype(np.int64)),
                pa.array(bad.astype(np.int64)),
            ],
            names=[x.split()[0] for x in SCHEMA.split(", ")],
        )


def judge(documents: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document row with the base counts and the verdict of the bands.

    Only doc_id and text are read. A null or blank text has no words and fails. A null
    doc_id and repeated rows are kept as they are. Map-only: no shuffle, and memory for
    one slice of texts or one long text.
    """
    rows = documents.select(documents["doc_id"].cast("long"), documents["text"].cast("string"))
    return rows.mapInArrow(lambda batches: judge_texts(batches, bands), SCHEMA)


def keep_good(documents: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The documents that judge() keeps, with all their columns, in one pass."""
    schema = documents.schema
    at = schema.fieldNames().index("text")
    doc_id = schema.fieldNames().index("doc_id")

    def filtered(batches):
        for batch in slices(batches):
            both = pa.RecordBatch.from_arrays(
                [batch.column(doc_id).cast("int64"), batch.column(at)], names=["doc_id", "text"]
            )
            for verdict in judge_texts([both], bands):
                yield batch.filter(verdict.column(7))

    return documents.mapInArrow(filtered, schema)
