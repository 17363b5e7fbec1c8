"""Soft-membership mixing: document rates that bring expected domain totals to targets.

A classifier learned from the labelled table gives each document posteriors over domains.
Projected gradient descent then finds nonnegative rates, close to one for every document,
whose expected tokens in each domain match the target weights in the least-squares sense.
A step needs only the domain totals of all documents, so each iteration is one small
aggregate; a document's rate follows from the few residuals so far, which tasks replay
instead of keeping rates anywhere.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from faremill.llm.storage import discard, written
from faremill.llm.words import Words, mix, slices

_U = np.uint64
DOMAINS = ("good", "low", "toxic")


@dataclass(frozen=True)
class Mixture:
    """weights: target share of expected tokens for good, low and toxic text.

    The budget is what lets good text keep its tokens. sample: labelled rows to learn from
    at most, chosen by a hash of doc_id; features: hashed words, a power of two; snap:
    rates this close to a whole number are rounded to it, which moves the totals away from
    the targets, so 0 unless asked for; seed: of the rounding of rates to copies.
    """

    weights: tuple[float, float, float] = (0.99, 0.01, 0.0)
    sample: int = 8000
    features: int = 1 << 16
    epochs: int = 60
    rounds: int = 60
    tolerance: float = 1e-4
    seed: int = 17


def domain_of(labels: DataFrame) -> DataFrame:
    """doc_id and domain number of labelled documents; rows with nulls say nothing."""
    return (
        labels.select("doc_id", "quality", "toxic")
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
        .select(
            F.col("doc_id").cast("long").alias("id"),
            F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0).alias("domain"),
        )
    )


def features(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, column and value of each feature, and the words of each text.

    A column for each distinct word, by hash, and one for each byte below 128 with the root
    of its share of the text.
    """
    words = Words(texts)
    hashes = words.hashes()
    column = (mix(hashes + _U(5)) % _U(size)).astype(np.int64)
    key = np.unique(words.doc * size + column)
    doc, column = key // size, key % size
    known = np.bincount(doc, minlength=len(words.counts))
    value = 1.0 / np.sqrt(np.maximum(known, 1))[doc]
    where = np.repeat(np.arange(len(words.counts)), np.diff(words.offsets))
    ascii_ = words.data < 128
    shares = np.bincount(where[ascii_] * 128 + words.data[ascii_], minlength=len(words.counts) * 128)
    cells = np.flatnonzero(shares)
    length = np.maximum(np.diff(words.offsets), 1)
    return (
        np.concatenate([doc, cells // 128]),
        np.concatenate([column, size + cells % 128]),
        np.concatenate([value, np.sqrt(shares[cells] / length[cells // 128])]),
        words.counts,
    )


def sampled_features(batches, size: int):
    for batch in slices(batches):
        doc, column, value, _ = features(batch.column(1), size)
        order = np.argsort(doc, kind="stable")
        edges = np.searchsorted(doc[order], np.arange(len(batch) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.ListArray.from_arrays(pa.array(edges), pa.array(column[order].astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(edges), pa.array(value[order].astype(np.float32))),
            ],
            names=["domain", "columns", "values"],
        )


def learn(documents: DataFrame, labels: DataFrame, plan: Mixture) -> np.ndarray:
    """Weights of a softmax classifier, a row for each feature and a last one for the bias.

    Learned on a bounded sample of labelled documents; the domains count alike whatever
    their number of rows, then the prior is put back. Without labels all weights are zero.
    """
    spark = documents.sparkSession
    order = F.xxhash64("id", F.lit(plan.seed))
    chosen = domain_of(labels).orderBy(order, "id").limit(plan.sample)
    chosen = spark.createDataFrame(chosen.collect(), chosen.schema)  # at most `sample` rows
    rows = documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
    rows = rows.join(F.broadcast(chosen), "id").select("domain", "text", "id")
    size = plan.features
    found = rows.select("domain", "text").mapInArrow(
        lambda batches: sampled_features(batches, size),
        "domain int, columns array<int>, values array<float>",
    )
    # rows that repeat a doc_id could pass the bound
    table = found.limit(plan.sample).toArrow().combine_chunks()
    weights = np.zeros((size + 129, len(DOMAINS)))
    if not len(table):
        return weights
    y = np.asarray(table.column("domain"))
    lengths = np.asarray([len(x) for x in table.column("columns")])
    column = np.concatenate([np.asarray(x.values, dtype=np.int64) for x in table.column("columns")])
    value = np.concatenate([np.asarray(x.values, dtype=np.float64) for x in table.column("values")])
    doc = np.repeat(np.arange(len(y)), lengths)
    goal = np.eye(len(DOMAINS))[y]
    counts = np.maximum(goal.sum(axis=0), 1)
    share = counts / counts.sum()
    importance = (1 / np.sqrt(share))[y]
    importance /= importance.mean()
    step, first, second = 0.1, np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, plan.epochs + 1):
        scores = np.stack(
            [np.bincount(doc, value * weights[column, k], len(y)) for k in range(len(DOMAINS))], axis=1
        )
        error = (softmax(scores + weights[-1]) - goal) * importance[:, None] / len(y)
        gradient = np.stack(
            [np.bincount(column, value * error[doc, k], len(weights)) for k in range(len(DOMAINS))], axis=1
        )
        gradient[-1] = error.sum(axis=0)
        gradient += 1e-7 * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        weights -= step * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return weights


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Names:
    """Columns that the operator adds, under names that the documents do not have."""

    tokens: str
    p: tuple[str, ...]
    rate: str
    copies: str
    draw: str

    @classmethod
    def beside(cls, columns: list[str]) -> Names:
        taken = {name.lower() for name in columns}

        def free(name: str) -> str:
            while name in taken:
                name += "_"
            return name

        p = tuple(free(f"mixed_p{k}") for k in range(len(DOMAINS)))
        return cls(free("mixed_tokens"), p, free("mixed_rate"), free("mixed_copies"), free("mixed_draw"))


def posteriors(
    documents: DataFrame, weights: np.ndarray, plan: Mixture, steps: tuple[list, float] | None = None
) -> DataFrame:
    """The documents with tokens (words) and posteriors over the domains and, where the
    fitted steps are given, the rate; see Names for the columns."""
    shared = documents.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    size, names = plan.features, Names.beside(documents.columns)
    at = documents.columns.index("text")
    added = [StructField(names.tokens, LongType()), *(StructField(x, DoubleType()) for x in names.p)]
    added += [StructField(names.rate, DoubleType())] if steps else []
    schema = StructType([*documents.schema.fields, *added])

    def scored(batches):
        own = shared.value
        for batch in slices(batches, documents_text, 1 << 20):
            doc, column, value, counts = features(batch.column(at).cast("string"), size)
            scores = np.stack(
                [np.bincount(doc, value * own[column, k], len(batch)) for k in range(len(DOMAINS))], axis=1
            )
            p = softmax(scores + own[-1])
            more = [pa.array(counts), *(pa.array(p[:, k]) for k in range(len(DOMAINS)))]
            if steps:
                more.append(pa.array(replay(p, *steps)[0]))
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)

    documents_text = documents.columns[at]
    return documents.mapInArrow(scored, schema)


def replay(p: np.ndarray, residuals: list, step: float) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the steps whose residuals are given, and the point of the next step."""
    rate = np.ones(len(p))
    ahead = rate
    for t, residual in enumerate(residuals):
        fresh = np.maximum(0.0, ahead - step * (p @ np.asarray(residual)))
        ahead = fresh + t / (t + 3) * (fresh - rate)
        rate = fresh
    return rate, ahead


@dataclass(frozen=True)
class Fit:
    """residuals and step give the rates again (replay); met, target: expected totals of the
    domains as shares of all tokens; converged: whether all are within the tolerance."""

    residuals: list
    step: float
    met: np.ndarray
    target: np.ndarray
    converged: bool


def fit(known: DataFrame, tokens: str, names: tuple[str, ...], plan: Mixture) -> Fit:
    """Nonnegative rates whose expected totals meet the targets, by accelerated projected
    gradient: one pass over the tokens and posteriors of all documents for each step."""
    k = len(names)
    sums = known.agg(
        F.sum(tokens).alias("n"),
        *(F.sum(F.col(tokens) * F.col(x)).alias(x) for x in names),
        *(F.sum(F.col(tokens) * F.col(x) * F.col(y)).alias(x + y) for x in names for y in names),
    ).first()
    total = float(sums["n"] or 0)
    if not total:
        return Fit([], 1.0, np.zeros(k), np.zeros(k), True)
    have = np.array([sums[x] for x in names]) / total
    gram = np.array([[sums[x + y] for y in names] for x in names]) / total
    step = 1.0 / float(np.linalg.eigvalsh(gram)[-1])
    weights = np.array(plan.weights) / sum(plan.weights)
    target = weights * have[0] / weights[0]
    residuals: list[list[float]] = []
    small = known.select(tokens, *names)

    def totals(batches):
        for batch in batches:
            n = np.asarray(batch.column(0), dtype=np.float64)
            p = np.stack([np.asarray(batch.column(1 + i)) for i in range(k)], axis=1)
            _, ahead = replay(p, residuals, step)
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(x)]) for x in (n * ahead) @ p], names=names
            )

    met = have
    while np.abs(met - target).max() >= plan.tolerance and len(residuals) < plan.rounds:
        residuals.append((met - target).tolist())
        found = small.mapInArrow(totals, ", ".join(f"{x} double" for x in names))
        row = found.agg(*(F.sum(x).alias(x) for x in names)).first()
        met = np.array([row[x] for x in names]) / total
    converged = bool(np.abs(met - target).max() < plan.tolerance)
    if not converged:
        warnings.warn(
            f"after {plan.rounds} steps the totals are {met.round(5)}, the targets {target.round(5)}",
            stacklevel=2,
        )
    return Fit(residuals, step, met, target, converged)


def with_rates(documents: DataFrame, labels: DataFrame, plan: Mixture = Mixture()) -> DataFrame:
    """The documents with tokens, posteriors, rate and copies (how often each is taken); see
    Names for the columns.

    copies is the rate rounded up or down by a hash of doc_id and text, so that its mean is
    the rate; rows that share both are taken alike. A null or empty text has no tokens.
    Equal texts get equal rates. Without labels, or without documents, rates are 1. Where
    the targets are not met within the tolerance after all rounds, a warning gives both.
    """
    names = Names.beside(documents.columns)
    weights = learn(documents, labels, plan)
    first = posteriors(documents.select("text"), weights, plan)
    own = Names.beside(["text"])
    known = written(first.select(own.tokens, *own.p), "posteriors")
    found = fit(known, own.tokens, own.p, plan) if weights.any() else Fit([], 1.0, np.zeros(1), np.zeros(1), True)
    discard(known)
    rows = posteriors(documents, weights, plan, (found.residuals, found.step))
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(plan.seed)), F.lit(1 << 30)) / float(1 << 30)
    whole = F.floor(names.rate)
    return rows.withColumn(
        names.copies, whole + (draw < F.col(names.rate) - whole).cast("long")
    )


def mix_sources(documents: DataFrame, labels: DataFrame, plan: Mixture = Mixture()) -> DataFrame:
    """The documents, each as many times as the mixture takes it, with their columns."""
    names = Names.beside(documents.columns)
    rows = with_rates(documents, labels, plan).filter(F.col(names.copies) > 0)
    repeated = F.explode(F.sequence(F.lit(1), F.col(names.copies).cast("int")))
    return rows.withColumn(names.draw, repeated).select(*documents.columns)


def rates(documents: DataFrame, labels: DataFrame, plan: Mixture = Mixture()) -> DataFrame:
    """One row per document row: tokens, posteriors over the domains, rate and copies."""
    texts = documents.select("doc_id", "text")
    names = Names.beside(texts.columns)
    return with_rates(texts, labels, plan).select(
        "doc_id",
        F.col(names.tokens).alias("n_tokens"),
        *(F.col(x).alias(f"p_{d}") for x, d in zip(names.p, DOMAINS, strict=True)),
        F.col(names.rate).alias("rate"),
        F.col(names.copies).alias("copies"),
    )
