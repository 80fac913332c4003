"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

A window is ``window`` consecutive words of an item, or the whole item if it has
fewer. Windows are sets of word shingles ordered by rarity, counted over all
documents. Holding a whole window means holding its rarest shingle, so that one
is the necessary prefix: documents are joined on it alone. A match at a position
gives one possible start of the window, which must lie within the document with
the window's length after it; then the words there are compared with the window.

The windows are split into blocks of a proven size, each broadcast in turn and
held against all documents; ordinary benchmark suites are one block. The
blocks' findings on a text are united.

Defined cases: null text and text without words has no words and no hits; items
without words, or null, have no window; equal windows of several items count for
each item; null item ids are not listed; repeated documents are answered each;
empty tables give no hits or no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystat.llm.common import ascii_lower, batch, cut, table

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
#: Distinct windows broadcast at once: some 20 MB of words, of which three fit one 64-bit number.
BLOCK_WINDOWS = 200_000
#: Fixed value of the contract: runs of ASCII letters, digits and all beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same rule over UTF-8 bytes: A-Z to lower case, bytes outside words to blanks.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Bytes of documents matched as one run of words.
GROUP_BYTES = 2_000_000


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_WORDS).split()


def without(text: bytes, starts: list[int], stops: list[int]) -> bytes:
    """``text`` without the words (numbered from 0) of the given runs and what lies between them."""
    inside = np.frombuffer(text.translate(_TO_WORDS), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
    begins, ends = edges[::2].tolist(), edges[1::2].tolist()
    out, last = [], 0
    for x, y in zip(starts, stops, strict=True):
        out.append(text[last : begins[x]])
        last = ends[y - 1]
    return b"".join([*out, text[last:]])


def windows(benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """Distinct windows (words) with the sorted ids of the items that hold them."""
    words = F.expr(f"regexp_extract_all(low, '{WORD}', 0)".replace("\\", "\\\\"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), ascii_lower(F.col("text")).alias("low")).select("item", words.alias("w")).where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1))))
    cut_out = items.select("item", "w", starts.alias("at")).select("item", F.slice("w", F.col("at"), size).alias("words"))
    return cut_out.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


class Block:
    """Windows as rows of word numbers, and their shingles as single numbers."""

    def __init__(self, rows: list[tuple[list[str], list[str]]]):
        self.items = [r[1] for r in rows]
        names = sorted({w for r in rows for w in r[0]})
        self.ids = {w.encode(): i + 1 for i, w in enumerate(names)}
        self.base = len(names) + 1
        self.length = np.array([len(r[0]) for r in rows], np.int64)
        width = int(self.length.max(initial=1))
        self.rows = np.zeros((len(rows), width), np.int64)
        for k, r in enumerate(rows):
            self.rows[k, : len(r[0])] = [self.ids[w.encode()] for w in r[0]]
        #: Sizes of shingles in use: windows shorter than a shingle are shingles themselves.
        self.sizes = sorted({min(SHINGLE_WORDS, int(n)) for n in self.length})
        self.codes = {n: np.unique(np.concatenate([self.shingles(self.rows[self.length >= n].ravel(), n), np.zeros(0, np.int64)])) for n in self.sizes}

    def shingles(self, ids: np.ndarray, n: int) -> np.ndarray:
        """Number of the shingle that begins at each place but the last n - 1; 0 where a word isn't in any window."""
        if len(ids) < n:
            return np.zeros(0, np.int64)
        code = ids[: len(ids) - n + 1].astype(np.int64)
        known = code > 0
        for k in range(1, n):
            word = ids[k : len(ids) - n + 1 + k]
            known &= word > 0
            code = code * self.base + word
        return np.where(known, code, 0)

    def numbers(self, found: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of several documents in a row, a zero behind each, and where each begins."""
        get = self.ids.get
        sizes = np.array([len(w) for w in found], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        flat = np.zeros(int(starts[-1]), np.int64)
        for w, at in zip(found, starts.tolist()):
            flat[at : at + len(w)] = [get(x, 0) for x in w]
        return flat, starts

    def choose(self, counts: dict[tuple[int, int], int]) -> None:
        """Pick each window's rarest shingle and index the windows by it."""
        self.prefix: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        picked: dict[int, list[tuple[int, int, int]]] = {n: [] for n in self.sizes}
        for k, length in enumerate(self.length.tolist()):
            n = min(SHINGLE_WORDS, length)
            codes = self.shingles(self.rows[k, :length], n).tolist()
            _, offset = min((counts.get((n, c), 0), at) for at, c in enumerate(codes))
            picked[n].append((codes[offset], k, offset))
        for n, rows in picked.items():
            code, window, offset = (np.array(x, np.int64) for x in zip(*sorted(rows), strict=True)) if rows else (np.zeros(0, np.int64),) * 3
            self.prefix[n] = code, window, offset

    def find(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Verified (start in flat, window) pairs of all occurrences."""
        at_all, window_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        width = self.rows.shape[1]
        padded = np.concatenate([flat, np.zeros(width, np.int64)])
        for n, (code, window, offset) in self.prefix.items():
            here = self.shingles(flat, n)
            at = np.flatnonzero(here)
            lo, hi = np.searchsorted(code, here[at]), np.searchsorted(code, here[at], "right")
            at, lo, size = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            for block in np.array_split(np.arange(len(at)), max(1, int(size.sum()) // 500_000)):
                total = int(size[block].sum())
                k = np.repeat(lo[block], size[block]) + np.arange(total) - np.repeat(np.cumsum(size[block]) - size[block], size[block])
                start, w = np.repeat(at[block], size[block]) - offset[k], window[k]
                # Position and length: the window must begin and end within its document.
                doc = np.searchsorted(starts, start + offset[k], "right") - 1
                ok = (start >= starts[doc]) & (start + self.length[w] <= starts[doc + 1] - 1)
                start, w = start[ok], w[ok]
                same = np.ones(len(w), bool)
                for j in range(width):
                    same &= (self.rows[w, j] == padded[start + j]) | (j >= self.length[w])
                at_all.append(start[same])
                window_all.append(w[same])
        return np.concatenate(at_all), np.concatenate(window_all)


def _groups(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    start, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t or b"")
        if chars >= GROUP_BYTES or i + 1 == len(texts):
            yield start, i + 1
            start, chars = i + 1, 0


def _counter(shared):
    kinds = {"n": pa.int32(), "code": pa.int64(), "count": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        seen = {n: np.zeros(len(codes), np.int64) for n, codes in block.codes.items()}
        for b in batches:
            texts = b.column(0).to_pylist()
            for lo, hi in _groups(texts):
                flat, _ = block.numbers([words_of(t) for t in texts[lo:hi]])
                for n, codes in block.codes.items():
                    here = block.shingles(flat, n)
                    here = here[here > 0]
                    at = np.searchsorted(codes, here).clip(max=max(0, len(codes) - 1))
                    hit = at[codes[at] == here] if len(codes) else at[:0]
                    seen[n] += np.bincount(hit, minlength=len(codes))
        for n, codes in block.codes.items():
            hit = np.flatnonzero(seen[n])
            yield batch({"n": np.full(len(hit), n), "code": codes[hit], "count": seen[n][hit]}, kinds)

    return run


def _marker(shared):
    kinds = {"doc_id": pa.int64(), "text_hash": pa.int64(), "n_words": pa.int64(), "starts": pa.list_(pa.int64()), "stops": pa.list_(pa.int64()), "items": pa.list_(pa.string())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        for b in batches:
            ids, hashes, texts = (c.to_pylist() for c in b.columns)
            for lo, hi in _groups(texts):
                found = [words_of(t) for t in texts[lo:hi]]
                flat, starts = block.numbers(found)
                at, window = block.find(flat, starts)
                cover = np.zeros(len(flat) + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + block.length[window], -1)
                inside = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
                edge = np.flatnonzero(inside[1:] != inside[:-1])
                first, last = edge[::2], edge[1::2]
                doc = np.searchsorted(starts, first, "right") - 1
                spans: dict[int, list[tuple[int, int]]] = {}
                for d, x, y in zip(doc.tolist(), first.tolist(), last.tolist()):
                    spans.setdefault(d, []).append((x - int(starts[d]), y - int(starts[d])))
                held: dict[int, set[str]] = {}
                for d, w in set(zip((np.searchsorted(starts, at, "right") - 1).tolist(), window.tolist())):
                    held.setdefault(d, set()).update(block.items[w])
                n = hi - lo
                yield batch(
                    {
                        "doc_id": ids[lo:hi], "text_hash": hashes[lo:hi], "n_words": [len(w) for w in found],
                        "starts": [[x for x, _ in spans.get(d, ())] for d in range(n)], "stops": [[y for _, y in spans.get(d, ())] for d in range(n)],
                        "items": [sorted(held.get(d, ())) for d in range(n)],
                    },
                    kinds,
                )

    return run


FOUND = "doc_id long, text_hash long, n_words long, starts array<long>, stops array<long>, items array<string>"


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of several blocks on one text as maximal runs."""
    for b in batches:
        rows = b.to_pylist()
        for r in rows:
            pairs = sorted(zip(r["starts"], r["stops"], strict=True))
            runs: list[list[int]] = []
            for x, y in pairs:
                if runs and x <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], y)
                else:
                    runs.append([x, y])
            r["starts"], r["stops"] = [x for x, _ in runs], [y for _, y in runs]
        yield pa.RecordBatch.from_pylist(rows, schema=b.schema)


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, starts and stops of maximal hit runs (in words), sorted items."""
    spark = docs.sparkSession
    found = cut(windows(benchmark, size), "windows")
    blocks = max(1, -(-found.count() // block_windows))
    named = found.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    out = None
    for k in range(blocks):
        own = named.where(F.col("block") == k).orderBy("words").collect()  # about block_windows rows
        block = Block([(r["words"], r["items"]) for r in own])
        held = spark.sparkContext.broadcast(block)
        counted = rows.select("text").mapInArrow(_counter(held), "n int, code long, count long").groupBy("n", "code").agg(F.sum("count").alias("count")).collect()
        block.choose({(r["n"], r["code"]): r["count"] for r in counted})
        part = rows.mapInArrow(_marker(spark.sparkContext.broadcast(block)), FOUND)
        out = part if out is None else out.unionAll(part)
    if blocks == 1:
        return out
    # Equal rows of one table stand together in every block: each block has seen all copies.
    one = out.groupBy("doc_id", "text_hash", "n_words").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("stops")).alias("stops"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.count("*").alias("seen")
    )
    one = one.withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("seen") / blocks).cast("int")))).drop("seen", "copy")
    return one.mapInArrow(_unite, FOUND)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and items found of every document."""
    found = hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(F.zip_with("starts", "stops", lambda x, y: y - x), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")).withColumn("contaminated", F.col("n_hit") > 0)
