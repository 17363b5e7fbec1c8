"""Language identification by a linear-chain conditional random field over words.

Each word has a score for each language from its character n-grams (those at its ends are
its affixes) and from itself as a lexicon entry; neighbouring words are tied by learned
transitions. Forward-backward gives each word's chances in its context, so a text may
switch languages; the text's language is the one with most of its words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.language_model import lowered
from faremill.llm.words import Words, mix, slices

_U = np.uint64


@dataclass(frozen=True)
class Tagger:
    """chain: words of a chain; buckets: hashed features, a power of two; grams: lengths of
    byte n-grams; sample: labelled texts to learn from for each language, about; spans:
    chains that are learned from each of them; the rest are parameters of the fitting."""

    chain: int = 64
    buckets: int = 1 << 17
    grams: tuple[int, ...] = (2, 3, 4)
    sample: int = 600
    spans: int = 2
    epochs: int = 40
    step: float = 0.05
    penalty: float = 1e-6
    folds: int = 5
    held: int = 0


@dataclass
class Field:
    languages: list[str]
    weights: np.ndarray  # a row for each feature
    moves: np.ndarray  # from language, to language
    first: np.ndarray


def word_features(words: Words, chosen: np.ndarray, plan: Tagger) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of some words, one after the other, and where each word's begin."""
    begins, lengths = words.starts[chosen], (words.ends - words.starts)[chosen]
    edges = np.concatenate(([0], np.cumsum(lengths + 2)))
    stream = np.full(int(edges[-1]), 0x02, dtype=np.uint64)
    stream[edges[1:] - 1] = 0x03
    inner = np.arange(int(lengths.sum()))
    word = np.repeat(np.arange(len(chosen)), lengths)
    offset = inner - np.repeat(np.cumsum(lengths) - lengths, lengths)
    stream[edges[word] + 1 + offset] = words.data[begins[word] + offset]
    owner = np.repeat(np.arange(len(chosen)), lengths + 2)
    found, owners = [mix(words.hashes()[chosen] + _U(99))], [np.arange(len(chosen))]
    key = stream.copy()
    size = 1
    for n in range(2, max(plan.grams) + 1):
        key = key[: len(stream) - n + 1] | (stream[n - 1 :] << _U(8 * (n - 1)))
        size = n
        if n in plan.grams:
            whole = owner[: len(key)] == owner[n - 1 :]
            found.append(mix(key[whole] + _U(size << 40)))
            owners.append(owner[: len(key)][whole])
    features = np.concatenate(found)
    order = np.argsort(np.concatenate(owners), kind="stable")
    features = (features[order] & _U(plan.buckets - 1)).astype(np.int64)
    counts = sum(np.bincount(o, minlength=len(chosen)) for o in owners)
    return features, np.concatenate(([0], np.cumsum(counts)))[:-1]


def emissions(features: np.ndarray, begins: np.ndarray, weights: np.ndarray) -> np.ndarray:
    if not len(begins):
        return np.zeros((0, weights.shape[1]))
    return np.add.reduceat(weights[features], begins, axis=0)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, first: np.ndarray):
    """Chances of each language at each place of each chain, of each move, and log Z.

    scores: chains x places x languages; places from a chain's length on are ignored.
    Returns chances (chains x places x languages), expected moves summed over all chains,
    and the log partition function of each chain.
    """
    n, places, k = scores.shape
    top = scores.max(axis=2, keepdims=True)
    local = np.exp(scores - top)
    step = np.exp(moves)
    alpha, scale = np.zeros_like(local), np.ones((n, places))
    now = np.exp(first) * local[:, 0]
    for t in range(places):
        if t:
            inside = (t < lengths)[:, None]
            now = np.where(inside, (now @ step) * local[:, t], now)
        total = now.sum(axis=1)
        now = now / total[:, None]
        alpha[:, t], scale[:, t] = now, total
    beta = np.ones_like(local)
    expected = np.zeros((k, k))
    for t in range(places - 2, -1, -1):
        inside = (t + 1 < lengths)[:, None]
        ahead = local[:, t + 1] * beta[:, t + 1] / scale[:, t + 1 : t + 2]
        beta[:, t] = np.where(inside, ahead @ step.T, 1.0)
        pairs = alpha[:, t].T @ np.where(inside, ahead, 0.0)
        expected += pairs * step
    log_z = (np.log(scale) + top[:, :, 0] * (np.arange(places) < lengths[:, None])).sum(axis=1)
    return alpha * beta, expected, log_z


def chains_of(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of each chain: the texts cut every `length` words."""
    number = -(-words.counts // length)
    doc = np.repeat(np.arange(len(words.counts)), number)
    place = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
    begins = words.first[:-1][doc] + place * length
    return begins, np.minimum(length, words.first[1:][doc] - begins)


def fit(texts: list[str], labels: list[str], plan: Tagger) -> Field:
    """Learns from chains that splice two texts, so that switches are seen too."""
    languages = sorted(set(labels))
    k = len(languages)
    rng = np.random.Generator(np.random.PCG64(7))
    words = Words(lowered(pa.array(texts, pa.large_string())))
    label = np.array([languages.index(x) for x in labels])
    begins, lengths = chains_of(words, plan.chain)
    order = rng.permutation(len(begins))
    taken = np.zeros(len(texts), dtype=int)
    keep = []
    for i in order:
        d = words.doc[begins[i]]
        if taken[d] < plan.spans:
            taken[d] += 1
            keep.append(i)
    begins, lengths = begins[keep], lengths[keep]
    other = rng.permutation(len(keep))
    cut = rng.integers(plan.chain // 4, plan.chain + 1, len(keep))
    n = len(keep)
    place = np.arange(plan.chain)
    own = place[None, :] < np.minimum(cut, lengths)[:, None]
    ahead = place[None, :] - np.minimum(cut, lengths)[:, None]
    spliced = ~own & (ahead < lengths[other][:, None])
    token = np.where(own, begins[:, None] + place, begins[other][:, None] + ahead)
    size = (own | spliced).sum(axis=1)
    token = np.where(own | spliced, token, 0)
    gold = label[words.doc[token]]
    unique, number = np.unique(words.hashes()[token.ravel()], return_inverse=True)
    sample = np.zeros(len(unique), dtype=np.int64)
    sample[number] = token.ravel()
    number = number.reshape(n, plan.chain)
    features, starts = word_features(words, sample, plan)
    owner = np.repeat(np.arange(len(unique)), np.diff(np.concatenate((starts, [len(features)]))))
    inside = place[None, :] < size[:, None]
    goal = np.eye(k)[gold] * inside[:, :, None]
    seen_moves = np.zeros((k, k))
    both = inside[:, 1:]
    np.add.at(seen_moves, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    shapes = ((plan.buckets, k), (k, k), (k,))
    value = [np.zeros(s) for s in shapes]
    first, second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    total = inside.sum()
    for t in range(1, plan.epochs + 1):
        scores = emissions(features, starts, value[0])[number] * inside[:, :, None]
        chance, expected, _ = forward_backward(scores, size, value[1], value[2])
        error = ((chance - goal) * inside[:, :, None]).reshape(-1, k)
        by_word = np.stack(
            [np.bincount(number.ravel(), error[:, j], len(unique)) for j in range(k)], axis=1
        )
        gradient = [
            np.stack([np.bincount(features, by_word[owner, j], plan.buckets) for j in range(k)], axis=1),
            expected - seen_moves,
            (chance[:, 0] - goal[:, 0]).sum(axis=0),
        ]
        for i in range(3):
            g = gradient[i] / total + plan.penalty * value[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            value[i] -= plan.step * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-9)
    return Field(languages, value[0].astype(np.float32), value[1], value[2])


def tag(batches, plan: Tagger, field: Field):
    k = len(field.languages)
    for batch in slices(batches):
        texts = batch.column(2)
        words = Words(lowered(texts))
        votes = np.zeros((len(batch), k))
        if len(words) and k:
            hashes = words.hashes()
            _, sample, number = np.unique(hashes, return_index=True, return_inverse=True)
            score = emissions(*word_features(words, sample, plan), field.weights)
            lettered = (words.data >= 97) & (words.data <= 122) | (words.data >= 128)
            sums = np.concatenate(([0], np.cumsum(lettered)))
            spoken = sums[words.ends] > sums[words.starts]
            begins, lengths = chains_of(words, plan.chain)
            place = np.arange(min(plan.chain, int(lengths.max())))
            inside = place[None, :] < lengths[:, None]
            token = np.where(inside, begins[:, None] + place, 0)
            scores = score[number[token]] * inside[:, :, None]
            chance, _, _ = forward_backward(scores, lengths, field.moves, field.first)
            count = inside & spoken[token]
            for j in range(k):
                votes[:, j] = np.bincount(words.doc[token[count]], chance[:, :, j][count], len(batch))
        some = np.asarray(pc.match_substring_regex(texts.fill_null(""), r"\p{L}"))
        total = votes.sum(axis=1)
        some &= total > 0
        best = votes.argmax(axis=1) if k else np.zeros(len(batch), dtype=int)
        share = np.where(some, votes[np.arange(len(batch)), best] / np.where(some, total, 1), 0.0) if k else np.zeros(len(batch))
        names = [field.languages[b] if s else "und" for b, s in zip(best, some, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(share)],
            names=["doc_id", "held_out", "lang_pred", "score"],
        )


def learn(documents: DataFrame, plan: Tagger = Tagger()) -> Field:
    """The field, fitted on a bounded sample of labelled texts outside the held-out fold.

    About `sample` texts of each language, chosen by a hash of doc_id; twice as many at
    most over all, whatever a language's share of the table.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(plan.folds))
    rows = documents.filter(
        (fold != plan.held) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Field([], np.zeros((plan.buckets, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, plan.sample / n)).otherwise(share)
    chance = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.filter(chance < share).select("text", "lang")
    found = chosen.limit(2 * plan.sample * len(counts)).toArrow()
    return fit(found.column("text").to_pylist(), found.column("lang").to_pylist(), plan)


def identify(documents: DataFrame, plan: Tagger = Tagger()) -> DataFrame:
    """One row per document row: held_out, lang_pred and its share of the words, 0 to 1.

    A null text, or one without a letter, is `und` with score 0, as is every text if there
    is nothing to learn from. Ties go to the first language in alphabetical order. A null
    doc_id has no fold and is neither held out nor learned from. Only the text is used to
    predict, all of it, in chains of `chain` words.
    """
    field = learn(documents, plan)
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(plan.folds))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold == plan.held, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    shared = documents.sparkSession.sparkContext.broadcast(
        (field.languages, field.weights, field.moves, field.first)
    )
    return rows.mapInArrow(
        lambda batches: tag(batches, plan, Field(*shared.value)),
        "doc_id long, held_out boolean, lang_pred string, score double",
    )
