"""SimHash near-duplicates: fingerprints joined with themselves in a binary trie.

A fingerprint bit is set where more than half of a text's shingle hashes have
it. Distinct fingerprints are dealt into groups by exact agreement on one of
``distance + 1`` runs of bits, one of which any two fingerprints within
``distance`` bits must share; a group over ``GROUP_ROWS`` is dealt again the same
way by its other bits. Inside a group the sorted fingerprints are a binary
trie: pairs of nodes are walked down together, differing bits add up, and a
pair is dropped once they exceed the distance, or once both nodes lie in one
component already, which loses no link between components. Each group gives one
star of edges for a component; stars of all groups are merged by ``components``.

Defined cases: null or empty text, and text of white space, has fingerprint
zero and is linked like any other; fewer words than a shingle make one shingle;
repeated rows share a component; a component without any id has none; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystat.llm.common import batch, cut, partition_count, table
from quaystat.llm.components import components

SEED = 42
SHINGLE_WORDS = 4
DISTANCE = 4
#: Groups over this are dealt again by further bits, down to LEVELS runs of bits in common.
GROUP_ROWS = 50_000
LEVELS = 3
#: Rows gathered for one walk over the tries of whole groups, and pairs of nodes walked at once.
WALK_ROWS = 100_000
WALK_PAIRS = 500_000
#: Node pairs holding at most so many fingerprint pairs are compared directly.
DIRECT = 16


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the text's word shingles, repeats included."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        hashes = np.array([digest(line, SEED)], np.uint64)
    else:
        stops = list(accumulate(map(len, found), lambda a, n: a + n + 1))
        starts = [0, *(s + 1 for s in stops)]
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops[words - 1 :])], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint as a signed long) of every whole text."""
    kinds = {"doc_id": pa.int64(), "text_hash": pa.int64(), "fp": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in b.column(2).to_pylist()], np.uint64).view(np.int64)
            yield batch({"doc_id": b.column(0), "text_hash": b.column(1), "fp": fps}, kinds)

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _runs(path: int, blocks: int) -> list[list[int]]:
    """Runs of the bits that ``path`` leaves open; a path holds, by level, 1 + run number in its low 16-bit digits."""
    left = list(range(64))
    for digit in [(path >> s) & 0xFFFF for s in (32, 16, 0)]:
        runs = [x.tolist() for x in np.array_split(np.array(left), blocks)]
        if digit:
            left = [b for k, r in enumerate(runs) if k != digit - 1 for b in r]
    return [x.tolist() for x in np.array_split(np.array(left), blocks)]


def _deal(rows: DataFrame, distance: int) -> DataFrame:
    """Each row of (path, grp, fp) once for each run of its open bits; grp then also names the run's value."""
    blocks = distance + 1
    kinds = {"path": pa.int64(), "grp": pa.int64(), "fp": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            path, grp, fp = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns)
            word = fp.view(np.uint64)
            for p in np.unique(path).tolist():
                own = path == p
                for k, bits in enumerate(_runs(p, blocks)):
                    value = np.zeros(int(own.sum()), np.uint64)
                    for bit in bits:
                        value = (value << np.uint64(1)) | ((word[own] >> np.uint64(bit)) & np.uint64(1))
                    deeper = (p << 16) | (k + 1)
                    names = [xxhash.xxh64_intdigest(x) for x in np.stack([grp[own].view(np.uint64), np.full(len(value), deeper, np.uint64), value], axis=1).view("V24").ravel().tolist()] if p else ((np.uint64(k + 1) << np.uint64(48)) | value)
                    yield batch({"path": np.full(len(value), deeper, np.int64), "grp": np.array(names, np.uint64).view(np.int64), "fp": fp[own]}, kinds)

    return rows.mapInArrow(run, "path long, grp long, fp long")


class Walk:
    """Pairs of trie nodes over sorted (group, fingerprint) rows, walked down bit by bit."""

    def __init__(self, grp: np.ndarray, fp: np.ndarray, distance: int):
        self.fp, self.distance = fp, distance
        first = np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1]]))
        self.first, self.last = first, np.append(first[1:], len(grp))
        self.label = np.arange(len(fp))
        self.sames()

    def sames(self) -> None:
        """Running number of label changes: equal at both ends of a node that lies in one component."""
        self.changes = np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])])

    def settled(self, a, b, c, d) -> np.ndarray:
        one = (self.changes[b - 1] == self.changes[a]) & (self.changes[d - 1] == self.changes[c])
        return one & (self.label[a] == self.label[c])

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        """Merge the components of rows i and j, pair by pair."""
        label = self.label
        while True:
            x, y = label[i], label[j]
            open_ = x != y
            if not open_.any():
                break
            i, j, x, y = i[open_], j[open_], x[open_], y[open_]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(label[label], label):
                label = label[label]
            self.label = label
        self.sames()

    def direct(self, a, b, c, d) -> None:
        """Compare all fingerprints of small node pairs."""
        n, m = b - a, d - c
        size = n * m
        at = np.repeat(np.arange(len(a)), size)
        k = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        i, j = a[at] + k // m[at], c[at] + k % m[at]
        near = (i < j) & (np.bitwise_count(self.fp[i] ^ self.fp[j]) <= self.distance)
        self.link(i[near], j[near])

    def split(self, a: np.ndarray, b: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """Where the ones of each node [a, b) begin: its rows agree above ``bit`` and are sorted."""
        lo, hi = a.copy(), b.copy()
        one = np.uint64(1)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            ones = (self.fp[np.minimum(mid, len(self.fp) - 1)] >> bit.astype(np.uint64)) & one == one
            hi = np.where(open_ & ones, mid, hi)
            lo = np.where(open_ & ~ones, mid + 1, lo)
        return lo

    def run(self) -> None:
        many = self.last - self.first > 1
        a, b = self.first[many], self.last[many]
        zero = np.zeros(len(a), np.int64)
        stack = [(a, b, a, b, zero + 63, zero)]
        while stack:
            a, b, c, d, bit, wrong = stack.pop()
            if len(a) > WALK_PAIRS:
                half = len(a) // 2
                stack += [tuple(x[half:] for x in (a, b, c, d, bit, wrong)), tuple(x[:half] for x in (a, b, c, d, bit, wrong))]
                continue
            open_ = ~self.settled(a, b, c, d) & ~((a == c) & (b - a < 2))
            a, b, c, d, bit, wrong = (x[open_] for x in (a, b, c, d, bit, wrong))
            small = ((b - a) * (d - c) <= DIRECT) | (bit < 0)
            if small.any():
                self.direct(a[small], b[small], c[small], d[small])
                a, b, c, d, bit, wrong = (x[~small] for x in (a, b, c, d, bit, wrong))
            if not len(a):
                continue
            ab, cd = self.split(a, b, bit), self.split(c, d, bit)
            twin = a == c
            far = (a, ab, cd, d, wrong + 1, np.ones(len(a), bool)), (ab, b, c, cd, wrong + 1, ~twin)
            near = (a, ab, c, cd, wrong, np.ones(len(a), bool)), (ab, b, cd, d, wrong, np.ones(len(a), bool))
            for kind in (far, near):  # agreeing halves are walked first
                parts = []
                for p, q, r, s, w, use in kind:
                    ok = use & (p < q) & (r < s) & (w <= self.distance)
                    parts.append((p[ok], q[ok], r[ok], s[ok], bit[ok] - 1, w[ok]))
                x = tuple(np.concatenate(y) for y in zip(*parts, strict=True))
                if len(x[0]):
                    stack.append(x)


def _stars(distance: int):
    kinds = {"u": pa.int64(), "v": pa.int64()}

    def solve(grp: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        word = fp.view(np.uint64)
        order = np.lexsort((word, grp))
        grp, word = grp[order], word[order]
        walk = Walk(grp, word, distance)
        walk.run()
        linked = walk.label != np.arange(len(word))
        return batch({"u": word[linked].view(np.int64), "v": word[walk.label[linked]].view(np.int64)}, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for b in batches:
            grp, fp = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            held.append((grp, fp))
            rows += len(grp)
            if rows >= WALK_ROWS:
                grp, fp = (np.concatenate(x) for x in zip(*held, strict=True))
                whole = int(np.searchsorted(grp, grp[-1]))  # the last group may go on
                if whole:
                    yield solve(grp[:whole], fp[:whole])
                held, rows = [(grp[whole:], fp[whole:])], len(grp) - whole
        if rows:
            yield solve(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (u, v) that join all distinct fingerprints (column fp) within ``distance`` bits into their components."""
    n = partition_count(fps.sparkSession)
    rows = fps.select(F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("grp"), "fp")
    edges = None
    for level in range(LEVELS):
        rows = cut(_deal(rows, distance), "simhash-groups")
        large = rows.groupBy("grp").count().where(F.col("count") > GROUP_ROWS).select("grp")
        last = level == LEVELS - 1 or large.isEmpty()
        own = rows if last else rows.join(large, "grp", "left_anti")
        found = own.select("grp", "fp").repartition(n, "grp").sortWithinPartitions("grp").mapInArrow(_stars(distance), "u long, v long")
        edges = found if edges is None else edges.unionAll(found)
        if last:
            return edges
        rows = rows.join(large, "grp", "left_semi").select("path", "grp", "fp")
    return edges


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """doc_id, text_hash, fp and component (the least fingerprint reachable) of every document."""
    rows = cut(fingerprints(docs, words), "fingerprints")
    roots = components(links(rows.select("fp").distinct(), distance))
    return rows.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("doc_id", "text_hash", "fp", F.coalesce("root", "fp").alias("component"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component, named by its smallest doc_id, of every document."""
    found = cut(near_duplicates(table(spark, sf_dir, "documents")), "simhash")
    first = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return found.join(first, "component").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
