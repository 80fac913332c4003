"""Quality scores learnt from preference pairs (Bradley-Terry).

A document's features describe its whole text: the shares of its bytes, and
how much its words and lines repeat. Each pair of a preferred and a rejected
document is a comparison that the preferred one wins with probability
sigmoid(w · (x - x')); ``w`` minimises the logistic loss of such pairs. All
learning rows are dealt into blocks of bounded size, and within a block every preferred row
is compared with every rejected one; Newton steps sum over the blocks until the minimum is
reached. The cut is the quantile of all learning rows' scores that parts the labels best; scores
are mapped to 0..1 so that the cut lies at ``THRESHOLD``.

Defined cases: null text is empty; an empty text is scored by its (zero)
features; without rows of both labels every score is ``THRESHOLD`` and so accepted;
repeated rows are scored each; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaystat.llm.common import batch, cut, is_held_out, table
from quaystat.llm.labelled import learning_labels

THRESHOLD = 0.3
#: Learning rows of one block: each preferred one meets each rejected one there.
BLOCK_ROWS = 512
#: Rows of the rarer label in a block; where there are too few, each goes into several blocks.
RARE_ROWS = 32
STEPS = 50
DECAY = 1e-3
#: Tasks that add up what the others have summed, before the driver adds theirs.
ADDERS = 8
#: Texts whose features are held at once.
SCORED = 500


def features(text: bytes | None) -> np.ndarray:
    """Features of one whole text (UTF-8)."""
    raw = text or b""
    shares = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / max(1, len(raw))
    words = raw.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = raw.split(b"\n")
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    open_ends = sum(1 for w in words if not (w[-1:].isalnum() or w[-1] >= 128))
    bare = sum(1 for w in counts if w.isalnum() or max(w) >= 128)
    rest = [
        np.log1p(len(words)) / 10, np.log1p(len(raw)) / 10, len(counts) / n, max(counts.values(), default=0) / n,
        len(raw) / n / 10, bare / max(1, len(counts)), open_ends / n, len(set(lines)) / len(lines), repeats / n,
    ]
    return np.concatenate([np.sqrt(shares), rest])


@dataclass(frozen=True)
class Ranker:
    """Linear score of standardised features and its map to 0..1."""

    mean: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * (self.raw(x) - self.cut) + np.log(THRESHOLD / (1 - THRESHOLD)), -35, 35)
        out = 1 / (1 + np.exp(-z))
        return np.where(z >= np.log(THRESHOLD / (1 - THRESHOLD)), np.maximum(out, THRESHOLD), out)


def pair_terms(good: np.ndarray, bad: np.ndarray, n_good: np.ndarray, n_bad: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over all pairs of a block, rows counted as often as they occur: pairs, loss, gradient and curvature."""
    pairs = n_good[:, None] * n_bad[None, :]
    apart = (good @ w)[:, None] - (bad @ w)[None, :]
    lost = 1 / (1 + np.exp(np.clip(apart, -35, 35)))  # probability of the wrong winner
    slope = pairs * lost
    bend = slope * (1 - lost)
    cross = good.T @ bend @ bad
    curve = (good.T * bend.sum(axis=1)) @ good + (bad.T * bend.sum(axis=0)) @ bad - cross - cross.T
    return np.concatenate([[pairs.sum(), (pairs * np.logaddexp(0, -apart)).sum()], slope.sum(axis=0) @ bad - slope.sum(axis=1) @ good, curve.ravel()])


def minimise(terms: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Weights of least mean loss and decay, by Newton steps that are halved until they help; ``terms`` sums ``pair_terms`` of all blocks."""

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        pairs, loss, *rest = terms(w)
        rest = np.array(rest) / pairs
        return loss / pairs + DECAY * w @ w / 2, rest[:size] + DECAY * w, rest[size:].reshape(size, size) + DECAY * np.eye(size)

    w = np.zeros(size)
    loss, slope, curve = at(w)
    for _ in range(STEPS):
        step = np.linalg.solve(curve, slope)
        gain = slope @ step
        if gain < 1e-8:
            return w - step
        rate = 1.0
        while (found := at(w - rate * step))[0] > loss - rate * gain / 1e4 and rate > 1e-3:
            rate /= 2
        w, (loss, slope, curve) = w - rate * step, found
    return w


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Ranker:
    """Learn a ranker from rows of features held here, labels 0/1 and how often each row counts."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return _even(x.shape[1] if x.ndim == 2 else len(features(b"")))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / scale
    blocks = min(len(good), len(bad), -(-len(y) // BLOCK_ROWS))
    dealt = [(good[k::blocks], bad[k::blocks]) for k in range(blocks)]
    w = minimise(lambda w: sum(pair_terms(z[g], z[b], weight[g], weight[b], w) for g, b in dealt), z.shape[1])
    s = z @ w
    order = np.argsort(s)
    # Balanced accuracy of every quantile as the cut; among equals the middle one.
    wins = np.cumsum(np.where(y[order] == 0, weight[order], 0)) / weight[y == 0].sum()
    losses = np.cumsum(np.where(y[order] == 1, weight[order], 0)) / weight[y == 1].sum()
    gain = (wins - losses)[:-1]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    k = int(best[len(best) // 2])
    return Ranker(mean, w / scale, float((s[order[k]] + s[order[k + 1]]) / 2), 2.0 / max(float(np.std(s)), 1e-9))


def _even(size: int) -> Ranker:
    """All texts score alike."""
    return Ranker(np.zeros(size), np.zeros(size), 0.0, 1.0)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"doc_id": pa.int64(), "x": pa.binary()}
    for b in batches:
        x = [features(t).astype("<f4").tobytes() for t in b.column(1).to_pylist()]
        yield batch({"doc_id": b.column(0), "x": x}, kinds)


def _rows(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and counts of a batch of examples."""
    x = np.frombuffer(b"".join(b.column("x").to_pylist()), "<f4").reshape(b.num_rows, -1).astype(float)
    return x, b.column("y").to_numpy(zero_copy_only=False), b.column("n").to_numpy(zero_copy_only=False).astype(float)


def _summed(rows: DataFrame, sums: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]) -> np.ndarray | None:
    """The sum of the vectors that ``sums`` makes of the batches of all tasks; None if there are none."""

    def add(found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        out = None
        for v in found:
            out = v.copy() if out is None else out + v
        yield batch({"v": [] if out is None else [out.tobytes()]}, {"v": pa.binary()})

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        return (np.frombuffer(v) for b in batches for v in b.column(0).to_pylist())

    parts = rows.mapInArrow(lambda batches: add(sums(batches)), "v binary")
    found = [np.frombuffer(r["v"]) for r in parts.repartition(ADDERS).mapInArrow(lambda batches: add(vectors(batches)), "v binary").collect()]
    return sum(found[1:], found[0]) if found else None


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Examples and rows of either label, then the sums of the features and of their squares."""
    for b in batches:
        if b.num_rows:
            x, y, n = _rows(b)
            yield np.concatenate([[(y == 0).sum(), (y == 1).sum(), n[y == 0].sum(), n[y == 1].sum()], n @ x, n @ x**2])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The rows of each block, from rows that lie in their order; those of a block may come in several batches."""
    held: list[tuple] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        at, rows = b.column("block").to_numpy(zero_copy_only=False), _rows(b)
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
        for i, j in zip(cuts, cuts[1:]):
            if held and at[i] != last:
                yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
                held = []
            held.append(tuple(c[i:j] for c in rows))
            last = at[i]
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Ranker:
    """Fit a ranker on all labelled documents that aren't held out."""
    texts = docs.where(~is_held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    found = texts.mapInArrow(_features, "doc_id long, x binary").join(learning_labels(labels, label), "doc_id")
    # Rows that are alike are one example that counts as often.
    examples = cut(found.groupBy("y", "x").agg(F.count(F.lit(1)).alias("n")), "examples")
    moments = _summed(examples, _moments)
    if moments is None or not moments[:2].all():
        return _even(len(features(b"")))
    n = moments[2:4].sum()
    total, squares = np.split(moments[4:], 2)
    mean = total / n
    scale = np.sqrt(np.maximum(squares / n - mean**2, 0)) + 1e-3
    used = np.flatnonzero(total)  # a feature that no row has keeps the weight 0

    blocks = int(-(-moments[:2].sum() // BLOCK_ROWS))
    rare = int(moments[0] > moments[1])
    copies = int(min(blocks, -(-RARE_ROWS * blocks // moments[rare])))
    place = F.explode(F.sequence(F.lit(0), F.when(F.col("y") == rare, F.lit(copies - 1)).otherwise(F.lit(0)))).alias("copy")
    dealt = examples.select("y", "n", "x", place).withColumn("block", F.pmod(F.pmod(F.xxhash64("x"), F.lit(blocks)) + F.col("copy"), F.lit(blocks)))
    dealt = cut(dealt.drop("copy").repartition("block").sortWithinPartitions("block", "y", "x"), "blocks")

    def terms(w: np.ndarray) -> np.ndarray:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
            for x, y, n in _blocks(batches):
                if y.any() and not y.all():
                    z = (x[:, used] - mean[used]) / scale[used]
                    yield pair_terms(z[y == 1], z[y == 0], n[y == 1], n[y == 0], w)

        return _summed(dealt, sums)

    weights = np.zeros(len(mean))
    weights[used] = minimise(terms, len(used)) / scale[used]
    return Ranker(mean, weights, *_cut(examples, Ranker(mean, weights, 0.0, 1.0)))


def _cut(examples: DataFrame, ranker: Ranker) -> tuple[float, float]:
    """The cut of best balanced accuracy over all examples (among equals the middle one), and the slope at it."""

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = ranker.raw(_rows(b)[0])
                yield batch({"s": s, "y": b.column("y"), "n": b.column("n")}, {"s": pa.float64(), "y": pa.int32(), "n": pa.int64()})

    of = lambda y: F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0))
    values = examples.mapInArrow(scores, "s double, y int, n long").groupBy("s").agg(of(1).alias("good"), of(0).alias("bad"))
    values = cut(values.repartitionByRange("s").withColumn("bucket", F.spark_partition_id()), "scores")
    # One row per bucket of the range: what lies before it, and the least score behind it.
    ahead = Window.orderBy("bucket")
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    sizes = values.groupBy("bucket").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"), F.min("s").alias("low"))
    sizes = sizes.select("bucket", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in "gb"], F.lead("low").over(ahead).alias("low"))
    inside = Window.partitionBy("bucket").orderBy("s")
    rows = values.withColumns({"good": F.sum("good").over(inside), "bad": F.sum("bad").over(inside), "next": F.lead("s").over(inside)}).join(sizes, "bucket")
    rows = rows.select("s", F.coalesce("next", "low").alias("next"), (F.col("good") + F.col("g")).alias("losses"), (F.col("bad") + F.col("b")).alias("wins"))
    n = F.col("good") + F.col("bad")
    whole = values.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.sum(n * F.col("s")).alias("s"), F.sum(n * F.col("s") ** 2).alias("ss")).first()
    big = lambda c: F.col(c).cast("decimal(19,0)")
    gain = big("wins") * F.lit(whole["good"]).cast("decimal(19,0)") - big("losses") * F.lit(whole["bad"]).cast("decimal(19,0)")
    rows = rows.where(F.col("next").isNotNull()).select("s", "next", gain.alias("gain"))
    best = rows.where(F.col("gain") == rows.agg(F.max("gain")).first()[0])
    total = whole["good"] + whole["bad"]
    slope = 2.0 / max(np.sqrt(max(whole["ss"] / total - (whole["s"] / total) ** 2, 0)), 1e-9)
    middle = best.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY s)").alias("s")).first()["s"]
    if middle is None:  # one score for all
        return whole["s"] / total, slope
    return (middle + best.where(F.col("s") == middle).first()["next"]) / 2, slope


def score(docs: DataFrame, ranker: Ranker, columns: list[str], name: str = "score") -> DataFrame:
    """``columns`` of ``docs`` plus ``name`` (0..1, higher: label 1 likelier) of every whole text.

    Only the text goes to Python and only the score comes back.
    """

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = [ranker.score(np.array([features(t) for t in texts.slice(at, SCORED).to_pylist()])) for at in range(0, len(texts), SCORED)]
            yield pa.array(np.concatenate(out) if out else [], pa.float64())

    return docs.select(*[F.col(c) for c in columns], scores(F.col("text").cast("binary")).alias(name))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and decision of every document."""
    docs = table(spark, sf_dir, "documents")
    found = score(docs, learn(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
