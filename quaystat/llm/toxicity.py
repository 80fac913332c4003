"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words and word beginnings, each with how often the text has it at
least (once, twice, ...), so that the cosine tells a chance word from a habit.
Of the terms of a bounded sample of labelled documents, those most tied to the
label are indexed. Document frequencies are counted over all documents.

The examples' inverted index is cut into blocks; for each term it holds the
largest weight within each block. A query's blocks are taken in order of the bound
these give, until no block left can reach the k-th best cosine: the result is
exact. Neighbours vote by 1 / distance, weighted to the labels' true shares;
a logistic fit on the examples' own leave-one-out votes calibrates the score.

Defined cases: null text is empty; texts without an indexed term get the
examples' rate among such texts; ties go to the lesser example id; without rows
of both labels every score is 0; repeated rows are scored each; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystat.llm.common import batch, cut, is_held_out, table
from quaystat.llm.labelled import labelled_sample

THRESHOLD = 0.5
#: Examples of each label at most, the documented bound of the sample.
PER_CLASS = 3000
TERMS = 3000
LEVELS = 4
BEGIN = 5
NEIGHBOURS = 25
BLOCK = 64
#: Words whose terms a worker process keeps.
KEPT = 500_000
_STRIP = ".,;:!?%$&*#|\"'()[]{}<>"


def bases(word: str) -> tuple[str, ...]:
    """The word, and its beginning behind a mark, in lower case without the signs around it."""
    w = word.strip(_STRIP).lower()
    return (f"={w}", f"^{w[:BEGIN]}") if len(w) >= BEGIN else (f"={w}",) if w else ()


def terms(text: str | None) -> list[str]:
    """Terms base#level of a whole text, for every level up to its count."""
    counts = Counter(b for w in (text or "").split() for b in bases(w))
    return [f"{b}#{k}" for b, n in counts.items() for k in range(1, min(n, LEVELS) + 1)]


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"doc_id": pa.int64(), "y": pa.int32(), "terms": pa.list_(pa.string())}
    for b in batches:
        yield batch({"doc_id": b.column(0), "y": b.column(1), "terms": [terms(t) for t in b.column(2).to_pylist()]}, kinds)


class Vocabulary(dict):
    """word -> numbers of the indexed bases it has; other words have none."""

    def __init__(self, names: list[str]):
        super().__init__()
        self.level: dict[str, list[int]] = {}
        for k, name in enumerate(names):
            base, _, at = name.rpartition("#")
            self.level.setdefault(base, [-1] * LEVELS)[int(at) - 1] = k
        self.numbers = {b: i for i, b in enumerate(self.level)}
        self.by_number = list(self.level.values())

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= KEPT:
            self.clear()
        got = tuple(self.numbers[b] for b in bases(word) if b in self.numbers)
        self[word] = got
        return got

    def vector(self, text: str | None) -> list[int]:
        """Sorted numbers of the indexed terms of a whole text."""
        counts = Counter(n for hit in map(self.__getitem__, (text or "").split()) if hit for n in hit)
        return sorted(t for n, c in counts.items() for t in self.by_number[n][: min(c, LEVELS)] if t >= 0)


class BlockMaxIndex:
    """Inverted index of example vectors in blocks, with each term's largest weight in a block."""

    def __init__(self, vectors: list[list[int]], idf: np.ndarray):
        self.idf = idf
        # Like examples share a block, so that bounds are tight.
        self.order = sorted(range(len(vectors)), key=lambda i: (vectors[i], i))
        n = len(vectors)
        self.blocks = max(1, -(-n // BLOCK))
        self.weights = np.zeros((len(idf), self.blocks * BLOCK), np.float32)
        for at, i in enumerate(self.order):
            if vectors[i]:
                w = idf[vectors[i]]
                self.weights[vectors[i], at] = w / max(1e-12, float(np.sqrt((w**2).sum())))
        self.most = self.weights.reshape(len(idf), self.blocks, BLOCK).max(axis=2)
        self.rank = np.full(self.blocks * BLOCK, n, np.int64)
        self.rank[: len(self.order)] = self.order

    def nearest(self, vector: list[int], k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Exact k nearest examples (numbers, cosines), best first; ``skip`` leaves one example out."""
        w = self.idf[vector].astype(np.float32)
        w = w / max(1e-12, float(np.sqrt((w**2).sum())))
        bound = w @ self.most[vector]
        best, cosine = np.zeros(0, np.int64), np.zeros(0, np.float32)
        for b in np.argsort(-bound, kind="stable").tolist():
            if len(cosine) >= k and bound[b] < cosine[-1] - 1e-5 or bound[b] <= 0:
                break
            own = self.rank[b * BLOCK : (b + 1) * BLOCK]
            got = w @ self.weights[vector, b * BLOCK : (b + 1) * BLOCK]
            use = (got > 0) & (own != skip) & (own < len(self.order))
            best, cosine = np.concatenate([best, own[use]]), np.concatenate([cosine, got[use]])
            top = np.lexsort((best, -np.round(cosine, 5)))[:k]
            best, cosine = best[top], cosine[top]
        return best, cosine


class Voter:
    """Scores of vectors from the votes of their nearest examples."""

    def __init__(self, ids: np.ndarray, y: np.ndarray, weight: np.ndarray, vectors: list[list[int]], idf: np.ndarray):
        self.ids, self.y, self.weight = ids, y, weight
        self.index = BlockMaxIndex(vectors, idf)
        none = np.array([not v for v in vectors], bool)
        self.base = float((weight * y).sum() / max(1e-12, weight.sum()))
        self.rate = float((weight * y)[none].sum() / max(1e-12, weight[none].sum())) if none.any() else self.base
        self.slope, self.shift = 1.0, 0.0
        self.memory: dict[tuple, tuple[float, list[int]]] = {}
        self.calibrate(vectors)

    def vote(self, vector: list[int], skip: int = -1) -> tuple[float, list[int]]:
        """Share of the votes for label 1, as log-odds, and the example ids that voted, nearest first."""
        best, cosine = self.index.nearest(vector, NEIGHBOURS, skip) if vector else (np.zeros(0, np.int64), None)
        if not len(best):
            p, near = self.rate, best
        else:
            v = self.weight[best] / (1.02 - np.minimum(cosine, 1.0))
            p, near = float((v * self.y[best]).sum() / v.sum()), best
        p = min(max(p, 1e-4), 1 - 1e-4)
        return float(np.log(p / (1 - p))), self.ids[near[:3]].tolist()

    def calibrate(self, vectors: list[list[int]]) -> None:
        x = np.array([self.vote(v, skip=i)[0] for i, v in enumerate(vectors)])
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            g = np.array([(self.weight * (p - self.y) * x).sum(), (self.weight * (p - self.y)).sum()]) + 1e-3 * np.array([a - 1, b])
            r = self.weight * np.maximum(p * (1 - p), 1e-6)
            h = np.array([[(r * x * x).sum() + 1e-3, (r * x).sum()], [(r * x).sum(), r.sum() + 1e-3]])
            step = np.linalg.solve(h, g)
            a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if a > 0:
            self.slope, self.shift = float(a), float(b)

    def score(self, vector: list[int]) -> tuple[float, list[int]]:
        key = tuple(vector)
        got = self.memory.get(key)
        if got is None:
            x, near = self.vote(vector)
            got = (float(1 / (1 + np.exp(-np.clip(self.slope * x + self.shift, -30, 30)))), near)
            if len(self.memory) < KEPT // 5:
                self.memory[key] = got
        return got


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, score (0..1) and evidence (ids of the three nearest examples) of every whole text."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    sample, counts = labelled_sample(docs, labels, label, per_class)
    sample = cut(sample.mapInArrow(_sample_terms, "doc_id long, y int, terms array<string>"), "toxicity-sample")
    size = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.array().cast("array<bigint>").alias("evidence"))
    by_term = sample.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").alias("t"), F.count("*").alias("n"))
    tp, fp = F.col("t") / size[1], (F.col("n") - F.col("t")) / size[0]
    picked = by_term.where((F.col("t") >= 3) & (tp > 3 * fp)).orderBy(F.desc((tp - fp) / F.sqrt(tp + fp)), "term").limit(TERMS)
    names = [r["term"] for r in picked.select("term").collect()]
    # One pass over the texts keeps each document's indexed terms; all that follows reads those.
    shared = spark.sparkContext.broadcast(names)
    kinds = {"doc_id": pa.int64(), "terms": pa.list_(pa.int32())}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                yield batch({"doc_id": part.column(0), "terms": [vocabulary.vector(t) for t in part.column(1).to_pylist()]}, kinds)

    held = cut(rows.mapInArrow(vectors, "doc_id long, terms array<int>"), "toxicity-terms")
    total = held.count()
    df = {r["term"]: r["n"] for r in held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
    idf = np.array([np.log((1 + total) / (1 + df.get(k, 0))) + 1 for k in range(len(names))])
    number = {t: k for k, t in enumerate(names)}
    examples = sample.select("doc_id", "y", F.array_intersect("terms", F.lit(names) if names else F.array().cast("array<string>")).alias("terms")).orderBy("doc_id", "y").collect()
    ids, y = np.array([r["doc_id"] for r in examples], np.int64), np.array([r["y"] for r in examples], np.int64)
    weight = np.array([counts[k] / size[k] for k in y.tolist()])
    voter = spark.sparkContext.broadcast(Voter(ids, y, weight / weight.mean(), [sorted(number[t] for t in r["terms"]) for r in examples], idf))
    found = {"doc_id": pa.int64(), "score": pa.float64(), "evidence": pa.list_(pa.int64())}

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = voter.value
        for b in batches:
            got = [by.score(v) for v in b.column(1).to_pylist()]
            yield batch({"doc_id": b.column(0), "score": [g[0] for g in got], "evidence": [g[1] for g in got]}, found)

    return held.mapInArrow(vote, "doc_id long, score double, evidence array<long>")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score, decision and evidence of every document."""
    found = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
