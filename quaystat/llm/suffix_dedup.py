"""Removal of repeated byte passages by threshold-bounded interval expansion.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else, in the same text or another. Sorting all suffixes of a corpus is not
needed for that: of the ``length - GRAM + 1`` grams of any such string the one
with the least hash (leftmost on ties) is an anchor, and equal strings have it at
the same place, so only suffixes at anchors are sorted, in one group for each
gram that occurs at several places.

Inside a group the suffixes' next ``length`` bytes are sorted, and intervals are
expanded breadth first by one byte backwards at a time: the bytes before the
suffixes of an interval are a stretch of the Burrows-Wheeler transform, and a
stable sort of that stretch splits the interval into those that share one byte
more. An interval of one suffix is given up. After ``a`` steps, neighbours whose
forward prefixes agree on ``length - a`` bytes share a string of ``length`` bytes
that starts ``a`` bytes before the anchor; expansion stops at that length.

A gram of more than ``HOT_SUFFIXES`` suffixes isn't gathered. Its suffixes are dealt by
all the bytes around them: where two are wholly alike, every string there is
repeated; one of them then stands for its kind. The strings of those that
remain are counted one by one by digest, with partial counts before the shuffle.

Exact copies of a text are seen first: each of their strings occurs elsewhere, so
copies of at least ``length`` bytes lose everything, and one of them stands
for all in the search. The texts are shuffled once; grams and groups refer to them.

Defined cases: null text is empty; texts under ``length`` bytes keep everything;
repeated rows are copies of each other; an empty table gives no row; rows are
told apart by doc_id and text alone, so null ids are allowed; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystat.llm.common import batch, partition_count, table

LENGTH = 200
GRAM = 50
#: Suffixes expanded, and windows of grams searched, at once; windows and grams of one search must be fewer than 2^20.
GROUP_SUFFIXES = 60_000
HOT_SUFFIXES = 20_000
WINDOWS = 500_000
#: Tasks over which the rows of one gram are dealt when they are counted.
SALTS = 16
_PLACE = np.uint64((1 << 20) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Anchor places in ``data`` (bytes of one text) and the hashes of their grams."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        # Hash of each gram by doubling: a run of 2n bytes from two runs of n, and two overlapping runs for the rest.
        runs = {1: (data.astype(np.uint64) + np.uint64(1)) * _ODD}
        n = 1
        while 2 * n <= gram:
            x = runs[n]
            y = x[: len(x) - n] * _MIX + x[n:]
            runs[2 * n] = (y ^ (y >> np.uint64(32))) * _ODD
            del runs[n]
            n *= 2
        x = runs[n]
        h = x[: len(data) - gram + 1] * _MIX + x[gram - n : gram - n + len(data) - gram + 1]
        h = (h ^ (h >> np.uint64(29))) * _ODD
        h ^= h >> np.uint64(32)
    width = length - gram + 1
    found = [_least(h[at : at + WINDOWS + width - 1], width) + at for at in range(0, len(h) - width + 1, WINDOWS)]
    places = np.concatenate(found)
    places = places[np.concatenate([[True], places[1:] != places[:-1]])]
    return places, h[places].view(np.int64)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the least hash, leftmost on ties, of each window of ``width`` hashes; repeats in a row are dropped.

    The low bits of a hash give way to its place, so one minimum finds both.
    """
    count = len(h) - width + 1
    ranked = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    ranked[: len(h)] = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    blocks = ranked.reshape(-1, width)  # a window's least is that of one block's end or of the next one's begin
    begins = np.minimum.accumulate(blocks, axis=1).ravel()
    ends = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    places = (np.minimum(ends[:count], begins[width - 1 : width - 1 + count]) & _PLACE).astype(np.int64)
    return places[np.concatenate([[True], places[1:] != places[:-1]])]


def own_repeats(text: bytes, places: np.ndarray, grams: np.ndarray, length: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Anchors to keep, and runs of bytes known as repeated inside the text itself.

    Anchors with all the same bytes around them hold the same strings, which
    are repeated by that alone; the first and last of them stand for the rest.
    """
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return np.arange(len(places)), []
    shared = np.zeros(len(places), bool)
    shared[order[1:][same]] = shared[order[:-1][same]] = True
    reach = length - GRAM
    around: dict[bytes, list[int]] = {}
    for k in np.flatnonzero(shared).tolist():
        p = int(places[k])
        around.setdefault(b"%d:" % min(p, reach) + text[max(0, p - reach) : p + length], []).append(k)
    keep, runs = np.ones(len(places), bool), []
    for rows in around.values():
        if len(rows) > 1:
            keep[rows[1:-1]] = False
            runs += [(max(0, int(places[k]) - reach), min(len(text), int(places[k]) + length)) for k in rows]
    return np.flatnonzero(keep), runs


def merged(runs: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal runs of touching or overlapping ones."""
    out: list[list[int]] = []
    for x, y in sorted(runs):
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    return out


def _anchor_rows(length: int):
    kinds = {"key": pa.int64(), "gram": pa.int64(), "place": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                keys, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                got = []
                for t in texts:
                    places, grams = anchors(np.frombuffer(t, np.uint8), length)
                    keep, _ = own_repeats(t, places, grams, length)
                    got.append((places[keep], grams[keep]))
                sizes = [len(p) for p, _ in got]
                yield batch(
                    {"key": np.repeat(np.array(keys, np.int64), sizes), "gram": np.concatenate([np.zeros(0, np.int64), *(g for _, g in got)]), "place": np.concatenate([np.zeros(0, np.int64), *(p for p, _ in got)])},
                    kinds,
                )

    return run


SUFFIX = "key long, gram long, place int, hot boolean, before binary, after binary"
SUFFIX_KINDS = {"key": pa.int64(), "gram": pa.int64(), "place": pa.int32(), "hot": pa.bool_(), "before": pa.binary(), "after": pa.binary()}


def _contexts(length: int):
    """For each suffix at a repeated gram: the bytes that lie before it, nearest first, and its next bytes."""
    reach = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                rows = {k: [] for k in SUFFIX_KINDS}
                for key, text, anchors_ in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for anchor in anchors_:
                        place = anchor["place"]
                        rows["key"].append(key)
                        rows["gram"].append(anchor["gram"])
                        rows["place"].append(place)
                        rows["hot"].append(anchor["hot"])
                        rows["before"].append(text[max(0, place - reach) : place][::-1])
                        rows["after"].append(text[place : place + length])
                yield batch(rows, SUFFIX_KINDS)

    return run


def _kinds_of(length: int):
    """Suffixes of hot grams, wholly like ones in a row: for each kind its first row and whether there are more.

    Of a kind with several rows, all but the first come back as covered runs (start and stop set).
    """
    kinds = SUFFIX_KINDS | {"several": pa.bool_(), "start": pa.int64(), "stop": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, several = None, False
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                out = []
                for row in zip(*(c.to_pylist() for c in b.slice(at, 2000).columns), strict=True):
                    if open_ is not None and row[1] == open_[1] and row[4:] == open_[4:]:
                        several = True
                        out.append((*row, True, *_whole(row, length)))
                        continue
                    if open_ is not None:
                        out.append((*open_, several, None, None))
                    open_, several = row, False
                yield batch(dict(zip(kinds, zip(*out) if out else [[]] * len(kinds), strict=True)), kinds)
        if open_ is not None:
            yield batch(dict(zip(kinds, zip(*[(*open_, several, None, None)]), strict=True)), kinds)

    return run


def _whole(row: tuple, length: int) -> tuple[int, int]:
    """The run of bytes around a suffix that all its strings cover; empty if there are too few bytes for one."""
    place, before, after = row[2], row[4], row[5]
    if len(before) + len(after) < length:
        return 0, 0
    return place - len(before), place + len(after)


def _strings(length: int):
    """Digest of every string of ``length`` bytes that holds the gram at a suffix, with the gram and its place in the string.

    So one string seen from two anchors isn't taken for two.
    """
    kinds = {"key": pa.int64(), "place": pa.int32(), "step": pa.int32(), "string": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                rows = {k: [] for k in kinds}
                for key, gram, place, before, after in zip(*(c.to_pylist() for c in b.slice(at, 200).columns), strict=True):
                    around = before[::-1] + after
                    for step in range(max(0, length - len(after)), len(before) + 1):
                        start = len(before) - step
                        rows["key"].append(key)
                        rows["place"].append(place)
                        rows["step"].append(step)
                        rows["string"].append(hashlib.md5(b"%d,%d:" % (gram, step) + around[start : start + length]).digest())
                yield batch(rows, kinds)

    return run


def _hot_covers(dealt: DataFrame, length: int) -> DataFrame:
    """Covered runs (key, start, stop) of suffixes at hot grams."""
    # The condition that never fails keeps the filter behind the shuffle, which the other grams share.
    hot = dealt.where(F.col("hot") & (F.monotonically_increasing_id() >= 0)).sortWithinPartitions("dealt", "gram", "before", "after")
    kinds = hot.select(*SUFFIX_KINDS).mapInArrow(_kinds_of(length), f"{SUFFIX}, several boolean, start long, stop long")
    alike = kinds.where("start is not null and stop > start").select("key", "start", "stop")
    first = kinds.where("start is null")
    size = F.octet_length("before") + F.octet_length("after")
    place = F.col("place").cast("long")
    whole = first.where(F.col("several") & (size >= length)).select("key", (place - F.octet_length("before")).alias("start"), (place + F.octet_length("after")).alias("stop"))
    strings = first.select("key", "gram", "place", "before", "after").mapInArrow(_strings(length), "key long, place int, step int, string binary")
    twice = strings.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string")
    found = strings.join(twice, "string").groupBy("key", "place").agg(F.min("step").alias("least"), F.max("step").alias("most"))
    single = found.select("key", (F.col("place") - F.col("most")).cast("long").alias("start"), (F.col("place") - F.col("least") + length).cast("long").alias("stop"))
    return alike.unionAll(whole).unionAll(single)


def expand(group: np.ndarray, before: list[bytes], after: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """First and last step (or -1) at which each suffix shares a string of ``length`` bytes with another of its group."""
    n, reach = len(group), length - GRAM
    first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    order = np.array(sorted(range(n), key=lambda i: (group[i], after[i])), np.int64)
    nxt = np.frombuffer(b"".join(x.ljust(length, b"\0") for x in after), np.uint8).reshape(n, length)
    size = np.array([len(x) for x in after], np.int64)
    prev = np.frombuffer(b"".join(x.ljust(reach, b"\0") for x in before), np.uint8).reshape(n, reach).T.copy()
    room = np.array([len(x) for x in before], np.int64)

    def common(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Bytes that the forward strings of rows i and j share."""
        out = np.empty(len(i), np.int64)
        for s in range(0, len(i), 20_000):
            a, b = i[s : s + 20_000], j[s : s + 20_000]
            apart = nxt[a] != nxt[b]
            out[s : s + 20_000] = np.minimum(np.where(apart.any(axis=1), apart.argmax(axis=1), length), np.minimum(size[a], size[b]))
        return out

    # Intervals as runs of rows in suffix order: joined[k] says that rows k and k + 1 lie in one interval.
    joined = group[order[1:]] == group[order[:-1]]
    shared = np.where(joined, common(order[:-1], order[1:]), -1) if n > 1 else np.zeros(0, np.int64)
    for step in range(reach + 1):
        if step:
            # Backward extension: rows without a further byte leave; the rest split by that byte.
            byte = prev[step - 1][order].astype(np.int16)
            byte[room[order] < step] = -1
            alone = ~(np.append(joined, False) | np.insert(joined, 0, False))
            keep = (byte >= 0) & ~alone
            interval = np.concatenate([[0], np.cumsum(~joined)])
            split = joined & (byte[1:] != byte[:-1])
            mixed = np.zeros(int(interval[-1]) + 1, bool)
            mixed[interval[:-1][split]] = True
            again = mixed[interval]
            rank = np.arange(len(order))
            if again.any():
                move = np.flatnonzero(again)
                rank[move] = move[np.lexsort((byte[move], interval[move]))]
            old = order
            order, byte, interval, keep, again = old[rank], byte[rank], interval[rank], keep[rank], again[rank]
            shared_old = shared
            order, byte, interval, again, rank = order[keep], byte[keep], interval[keep], again[keep], rank[keep]
            if len(order) < 2:
                break
            joined = (interval[1:] == interval[:-1]) & (byte[1:] == byte[:-1])
            beside = rank[1:] == rank[:-1] + 1
            shared = np.full(len(joined), -1, np.int64)
            shared[joined & beside] = shared_old[rank[:-1][joined & beside]]
            fresh = np.flatnonzero(joined & ~beside)
            shared[fresh] = common(order[fresh], order[fresh + 1])
        hit = joined & (shared >= length - step)
        rows = order[np.append(hit, False) | np.insert(hit, 0, False)]
        last[rows] = step
        first[rows[first[rows] < 0]] = step
        # Neighbours that share too little even with every byte before them need no further step.
        if not joined.any():
            break
    return first, last


def _covers(length: int):
    kinds = {"key": pa.int64(), "start": pa.int64(), "stop": pa.int64()}

    def solve(cols: list[list]) -> pa.RecordBatch:
        key, gram, place, _, before, after = cols
        _, group = np.unique(np.array(gram, np.int64), return_inverse=True)
        first, last = expand(group, before, after, length)
        hit = np.flatnonzero(last >= 0)
        at = np.array(place, np.int64)[hit]
        # All strings found at one anchor hold its gram, so together they cover one run.
        return batch({"key": np.array(key, np.int64)[hit], "start": at - last[hit], "stop": at - first[hit] + length}, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in SUFFIX_KINDS]
        for b in batches:
            for at in range(0, b.num_rows, 5000):
                for h, c in zip(held, b.slice(at, 5000).columns, strict=True):
                    h += c.to_pylist()
                if len(held[0]) >= GROUP_SUFFIXES:
                    whole = held[1].index(held[1][-1])  # rows come gram by gram; the last gram may go on
                    if whole:
                        yield solve([h[:whole] for h in held])
                        held = [h[whole:] for h in held]
        if held[0]:
            yield solve(held)

    return run


def _removed(length: int):
    """Text without its covered runs."""
    kinds = {"key": pa.int64(), "starts": pa.list_(pa.int64()), "stops": pa.list_(pa.int64()), "kept": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                rows = {k: [] for k in kinds}
                for key, text, pairs in zip(*(c.to_pylist() for c in b.slice(at, 500).columns), strict=True):
                    _, own = own_repeats(text, *anchors(np.frombuffer(text, np.uint8), length), length)
                    runs = merged([(p["start"], p["stop"]) for p in pairs] + own)
                    edges = [0, *(v for r in runs for v in r), len(text)]
                    rows["key"].append(key)
                    rows["starts"].append([r[0] for r in runs])
                    rows["stops"].append([r[1] for r in runs])
                    rows["kept"].append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
                yield batch(rows, kinds)

    return run


def _repeated(grams: DataFrame, parts: int) -> DataFrame:
    """``grams`` (key, gram, place) of which there are several, with their number n.

    A gram's rows are dealt over ``SALTS`` tasks, counted there and the counts added up; the
    sums go back to those tasks alone that hold rows of the gram.
    """
    salted = grams.withColumn("salt", F.pmod(F.xxhash64("key", "place"), F.lit(SALTS)).cast("int"))
    # Count and join share one shuffle: the count names all columns, and what joins ask for (no nulls) holds for both.
    dealt = salted.where("key is not null and gram is not null and salt is not null").repartition(parts, "gram", "salt")
    counted = dealt.groupBy("gram", "salt").agg(F.expr("count(key, place)").alias("n"))
    total = counted.groupBy("gram").agg(F.sum("n").alias("n"), F.bit_or(F.expr("shiftleft(1, salt)")).alias("salts")).where("n > 1")
    held = F.filter(F.array(*[F.lit(i) for i in range(SALTS)]), lambda i: F.getbit("salts", i) == 1)
    total = total.select("gram", "n", F.explode(held).alias("salt"))
    return dealt.join(total.hint("merge"), ["gram", "salt"]).select("key", "gram", "place", "n")


def repeated_passages(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What of ``docs`` is repeated, as three tables.

    Rows: doc_id, digest (SHA-256 of the text), n_bytes, one row per document.
    Texts: digest, copies and key of each distinct text of at least ``length`` bytes.
    Kept: key, starts, stops (maximal removed runs, in bytes) and kept (the
    remaining bytes) of each distinct text that holds repeated strings.
    """
    n = partition_count(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("long"), F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    by_text = rows.where(F.col("n_bytes") >= length).groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"))
    by_text = by_text.select("digest", "copies", F.xxhash64("doc_id", "digest").alias("key"))
    # The row of the least id stands for each distinct text. Its text is shuffled once, for all three joins.
    texts = docs.select(F.col("doc_id").cast("long"), text.alias("text")).where(F.octet_length("text") >= length)
    texts = texts.select(F.xxhash64("doc_id", F.unhex(F.sha2("text", 256))).alias("key"), "text").repartition(n, "key")
    own = texts.join(by_text.select("key").hint("merge"), "key", "left_semi")

    grams = own.mapInArrow(_anchor_rows(length), "key long, gram long, place int")
    several = _repeated(grams, n)
    at = several.groupBy("key").agg(F.collect_list(F.struct("gram", "place", (F.col("n") > HOT_SUFFIXES).alias("hot"))).alias("at"))
    suffixes = own.join(at.hint("merge"), "key").select("key", "text", "at").mapInArrow(_contexts(length), SUFFIX)
    dealt = F.when(F.col("hot"), F.xxhash64("gram", "before", "after")).otherwise(F.col("gram"))
    suffixes = suffixes.withColumn("dealt", dealt).repartition(n, "dealt")
    plain = suffixes.where(~F.col("hot") & (F.monotonically_increasing_id() >= 0)).sortWithinPartitions("dealt")
    covers = plain.select(*SUFFIX_KINDS).mapInArrow(_covers(length), "key long, start long, stop long").unionAll(_hot_covers(suffixes, length))
    runs = covers.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    kept = own.join(runs.hint("merge"), "key").select("key", "text", "runs").mapInArrow(_removed(length), "key long, starts array<long>, stops array<long>, kept binary")
    return rows, by_text, kept


def with_texts(rows: DataFrame, texts: DataFrame, kept: DataFrame) -> DataFrame:
    """``rows`` with copies (1 or null where the text has none) and the columns of ``kept``, null where nothing is repeated."""
    found = texts.join(kept, "key", "left").where((F.col("copies") > 1) | F.col("starts").isNotNull()).drop("key")
    return rows.join(found, "digest", "left")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and runs removed from every document, and the digest of what stays."""
    rows, texts, kept = repeated_passages(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("starts", "stops", lambda x, y: y - x), F.lit(0).cast("long"), lambda a, x: a + x)
    kept = kept.select("key", "starts", removed.alias("removed"), F.size("starts").cast("long").alias("spans"), F.sha2("kept", 256).alias("sha"))
    found = with_texts(rows, texts, kept)
    copy = F.col("copies") > 1
    return found.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("sha", F.lower(F.hex("digest")))).alias("kept_sha256"),
    )
