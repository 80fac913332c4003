r"""Removal of repeated word windows by level-wise doubling.

A word goes if a window of ``words`` consecutive words that covers it also starts in a
document with a smaller id. Windows are compared level by level:

* Level 1 is half that length (7 of 13). Of the short windows inside a window the one with the least
  hash, leftmost on ties, speaks for it; equal windows have it at the same place, so one
  short window in four is enough. Those that occur in one text alone end there, and with
  them every window they speak for.
* Level 2 extends the rest to ``words`` words and decides what is removed. Each window repeated
  there gets its origin, the first place of the first text that has it, which names its content.
* Each further level extends windows repeated at one length, where the next window of that
  length is repeated as well, to twice the length, until no candidate survives. Two windows whose
  origins follow each other are one passage of the origin's text, so their union is known without
  a search; only unions across two passages are looked for, by the pair of origins. So a text's
  state is a few runs of places, and no level reads texts. The levels tell how long a
  text's repeated passages are, down to a factor of two.

Hashes of level 1 have 48 bits, as a false match there only costs work; those of level 2 have 96 and
pairs of origins 128.

Exact copies are seen first: the one of least id stands for all, and in the others every
window starts in a smaller document. A window that a sample of documents shows to be
frequent isn't gathered: it skips level 1, and later its rows are spread over tasks, its
origin is found by partial aggregates, and the result, at most ``HOT`` hashes, is broadcast.
The sample decides on routes only, never on results.

Defined cases: null text has no words; a text of fewer words keeps all; rows without id come after
all others and not before each other; rows of one id are not before each other; repeated
rows get the same result; an empty table gives no row; a text's words are hashed in
blocks, so memory grows by 16 bytes a word and the text itself; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaystat.llm.common import batch, cut, join_groups, partition_count, table

WORDS = 13
#: Frequent windows are looked for in about this many documents; those in more than this share of them, at most so many, are spread.
SAMPLE, SHARE, HOT = 4000, 0.005, 1000
#: Bytes of text split into words, and windows hashed, at once.
BLOCK, STRETCH = 1 << 20, 1 << 18
#: Bytes of short texts hashed together.
TOGETHER = 1 << 16
_PLACE = np.uint64((1 << 20) - 1)
#: Bits that are kept of a short window's hash, and of the second half of a window's.
_SHORT, _SECOND = np.uint64((1 << 48) - 1), np.uint64((1 << 32) - 1)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
# Fixed values of the hashes, one column per lane: odd multipliers, the base of a word's polynomial and a number for each byte.
_MULTIPLY = np.array([[0x9E3779B97F4A7C15], [0xC2B2AE3D27D4EB4F]], np.uint64)
_AGAIN = np.array([[0xD6E8FEB86659FD93], [0xFF51AFD7ED558CCD]], np.uint64)
_BASE = (0x9FB21C651E98DF25, 0xA0761D6478BD642F)
_BYTES = np.random.Generator(np.random.PCG64(11)).integers(0, 2**64, (2, 256), np.uint64)


def word_blocks(text: bytes) -> Iterator[bytes]:
    """A text in blocks that end between words."""
    at = 0
    while at < len(text):
        gap = _SPACE.search(text, at + BLOCK) if at + BLOCK < len(text) else None
        stop = gap.start() if gap else len(text)
        yield text[at:stop]
        at = stop


class WordHashes:
    """Hashes of the words of texts, by sums of byte numbers times powers of a base modulo 2^64.

    Sums from the block's begin are taken once; a word's is a difference, brought to a common power.
    """

    def __init__(self):
        self.powers = self.back = np.ones((2, 1), np.uint64)

    def _grow(self, n: int) -> None:
        if self.powers.shape[1] < n:
            size = max(2 * self.powers.shape[1], n)
            with np.errstate(over="ignore"):
                steps = np.ones((2, size), np.uint64)
                steps[:, 1:] = np.array([_BASE], np.uint64).T
                self.powers = np.multiply.accumulate(steps, axis=1)
                steps[:, 1:] = np.array([[pow(b, -1, 2**64) for b in _BASE]], np.uint64).T
                self.back = np.multiply.accumulate(steps, axis=1)

    def block(self, text: bytes, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        """Where words start, and their hashes."""
        data = np.frombuffer(text, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, stops = edges[::2], edges[1::2]
        self._grow(len(data))
        out = np.empty((lanes, len(starts)), np.uint64)
        for lane in range(lanes):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_BYTES[lane].take(data) * self.powers[lane, : len(data)], out=sums[1:])
            out[lane] = (sums.take(stops) - sums.take(starts)) * self.back[lane].take(starts)
        return starts, joined(out, (stops - starts).astype(np.uint64))

    def each(self, texts: list[bytes], lanes: int = 2) -> Iterator[np.ndarray]:
        """For each text one column for each word and one row for each lane of 64 bits; short texts are hashed together."""
        at = 0
        while at < len(texts):
            upto, size = at + 1, len(texts[at])
            while upto < len(texts) and size + len(texts[upto]) <= TOGETHER:
                size += len(texts[upto]) + 1
                upto += 1
            if upto == at + 1:
                found = [self.block(b, lanes)[1] for b in word_blocks(texts[at])]
                yield found[0] if len(found) == 1 else np.concatenate([np.zeros((lanes, 0), np.uint64), *found], axis=1)
            else:
                starts, h = self.block(b"\n".join(texts[at:upto]), lanes)
                ends = np.cumsum([len(t) + 1 for t in texts[at:upto]])
                cuts = np.searchsorted(starts, ends).tolist()
                for x, y in zip([0, *cuts], cuts, strict=False):
                    yield h[:, x:y]
            at = upto


def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hashes of windows from those of a beginning and an end that cover them."""
    with np.errstate(over="ignore"):
        z = x * _MULTIPLY[: len(x)]
        z += y
        z ^= z >> np.uint64(29)
        z *= _AGAIN[: len(x)]
        z ^= z >> np.uint64(32)
    return z


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` words, by doubling."""
    count = words.shape[1] - length + 1
    if count < 1:
        return words[:, :0]
    h, n = words, 1
    while 2 * n <= length:
        h = joined(h[:, : h.shape[1] - n], h[:, n:])
        n *= 2
    return h if n == length else joined(h[:, :count], h[:, length - n : length - n + count])


def short_length(words: int) -> int:
    return (words + 1) // 2


def spoken_for(words: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By stretches of a text: the first window's place, hashes of all short windows there, and for each window of
    ``length`` words the place (in the stretch) of the short one that speaks for it."""
    short = short_length(length)
    width = length - short + 1
    for at in range(0, max(0, words.shape[1] - length + 1), STRETCH):
        h = window_hashes(words[:, at : at + STRETCH + length - 1], short)
        # The low bits of a hash give way to its place, so that one minimum finds both, the leftmost on ties.
        least, n = (h[0] & ~_PLACE) | np.arange(h.shape[1], dtype=np.uint64), 1
        while 2 * n <= width:
            least = np.minimum(least[: len(least) - n], least[n:])
            n *= 2
        if n < width:
            least = np.minimum(least[: len(least) - (width - n)], least[width - n :])
        yield at, h, (least & _PLACE).astype(np.int64)


def _speakers(place: np.ndarray) -> np.ndarray:
    """Distinct places, which never fall."""
    return place[np.concatenate([[True], place[1:] != place[:-1]])] if len(place) else place


def _short_windows(length: int, hot: np.ndarray):
    """Rows (key, h): the distinct short windows that speak for windows of a text, but for hot ones."""
    kinds = {"key": pa.int64(), "h": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                keys, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for key, words in zip(part.column(0).to_pylist(), hashes.each(part.column(1).to_pylist(), lanes=1), strict=True):
                    of = [h[0, _speakers(place)] & _SHORT for _, h, place in spoken_for(words, length)]
                    if of:
                        found.append(np.unique(of[0] if len(of) == 1 else np.concatenate(of)))
                        keys.append(np.full(len(found[-1]), key, np.int64))
                key, h = np.concatenate(keys), np.concatenate(found)
                keep = ~np.isin(h, hot)
                yield batch({"key": key[keep], "h": h[keep].view(np.int64)}, kinds)

    return run


# A window by its hashes. It is dealt by h1, or by its text where h1 is hot: only there h1 is kept beside that.
WINDOW = "key long, doc long, place int, dealt long, h1 long, h2 long"
WINDOW_KINDS = {"key": pa.int64(), "doc": pa.int64(), "place": pa.int32(), "dealt": pa.int64(), "h1": pa.int64(), "h2": pa.int64()}


def _windows(length: int, hot_short: np.ndarray, hot: np.ndarray):
    """Rows of ``WINDOW``: the windows of a text whose short window is repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, short = WordHashes(), short_length(length)
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                cols: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
                found, none = [np.zeros((2, 0), np.uint64)], [np.zeros(0, bool)]
                rows = [r for r in zip(*(part.column(c).to_pylist() for c in ("key", "doc", "text", "alive")), strict=True) if r[3] or len(hot_short)]
                for (key, doc, _, alive), words in zip(rows, hashes.each([r[2] for r in rows]), strict=True):
                    known = np.concatenate([np.array(alive or [], np.int64).view(np.uint64), hot_short])
                    for start, h, place in spoken_for(words, length):
                        speaks = np.zeros(h.shape[1], bool)
                        at_ = _speakers(place)
                        speaks[at_] = np.isin(h[0, at_] & _SHORT, known)
                        p = np.flatnonzero(speaks[place])
                        for c, v in zip(cols, (np.full(len(p), key), np.full(len(p), doc or 0), p + start), strict=True):
                            c.append(v)
                        found.append(joined(h[:, p], h[:, p + length - short]))
                        none.append(np.full(len(p), doc is None))
                key, doc, place = (np.concatenate(c) for c in cols)
                h = np.concatenate(found, axis=1)
                doc, h1, h2 = pa.array(doc, mask=np.concatenate(none)), h[0].view(np.int64), (h[1] & _SECOND).view(np.int64)
                is_hot = np.isin(h[0], hot)
                yield batch({"key": key, "doc": doc, "place": place, "dealt": np.where(is_hot, key, h1), "h1": pa.array(h1, mask=~is_hot), "h2": h2}, WINDOW_KINDS)

    return run


def repeated(windows: DataFrame) -> DataFrame:
    """key and hits of every text with windows (rows of ``WINDOW``) that several texts have.

    A hit is (at, origin): at is twice the place, plus one if the window also starts in a document with a smaller id;
    the origin is null where it is the window itself.
    """
    dealt = windows.repartition(partition_count(windows.sparkSession), "dealt")
    place = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "key", "place")
    least, several = F.min(place).alias("least"), (F.min("key") < F.max("key")).alias("several")
    same = Window.partitionBy("dealt", "h2")
    rows = behind(dealt, F.lit(True)).select("key", "doc", "place", "h1", "h2", F.min(place).over(same).alias("own_least"), (F.min("key").over(same) < F.max("key").over(same)).alias("own_several"))
    # As many as there are hot hashes, at most HOT.
    firsts = F.broadcast(behind(dealt, F.col("h1").isNotNull()).groupBy("h1", "h2").agg(least, several))
    rows = rows.join(firsts, ["h1", "h2"], "left").withColumn("least", F.coalesce("least", "own_least")).where(F.coalesce("several", "own_several"))
    late = F.coalesce(F.col("doc") > F.col("least.doc"), F.col("least.doc").isNotNull())
    at = F.col("place").cast("long") * 2 + late.cast("long")
    origin = F.when((F.col("key") != F.col("least.key")) | (F.col("place") != F.col("least.place")), begin_of("least.key") + F.col("least.place"))
    return rows.groupBy("key").agg(F.collect_list(F.struct(at.alias("at"), origin.alias("origin"))).alias("hits"))


def begin_of(key: str) -> Column:
    """Origin of a text's first place. Only differences of origins within one text have a meaning."""
    return F.shiftright(F.xxhash64(key), 1)


def behind(rows: DataFrame, condition: Column) -> DataFrame:
    """``rows`` that meet the condition, filtered above whatever made them and with all columns, so that several uses share that."""
    whole = (F.monotonically_increasing_id() >= 0) | (F.xxhash64(*rows.columns) == 0)  # always true
    return rows.where(F.when(whole, condition))


NEXT = "key long, doc long, late boolean, starts array<int>, counts array<int>, origins array<long>, lates array<boolean>, places array<int>, h1 array<long>, h2 array<long>"
NEXT_KINDS = {
    "key": pa.int64(), "doc": pa.int64(), "late": pa.bool_(), "starts": pa.list_(pa.int32()), "counts": pa.list_(pa.int32()), "origins": pa.list_(pa.int64()),
    "lates": pa.list_(pa.bool_()), "places": pa.list_(pa.int32()), "h1": pa.list_(pa.int64()), "h2": pa.list_(pa.int64()),
}
Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def as_runs(places: np.ndarray, origins: np.ndarray, late: np.ndarray) -> Runs:
    """Windows (by rising place) as runs: first place, number, first origin and whether they are late."""
    if not len(places):
        return places, places, origins, late
    first = np.concatenate([[True], (places[1:] != places[:-1] + 1) | (origins[1:] != origins[:-1] + 1) | (late[1:] != late[:-1])])
    at = np.flatnonzero(first)
    return places[at], np.diff(np.append(at, len(places))), origins[at], late[at]


def twice(runs_: Runs, length: int) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray]:
    """From windows of a level those of twice the length: runs within one passage, and the places and
    pairs of origins of those that two passages make."""
    starts, counts, origins, late = runs_
    inner = counts > length
    known = (starts[inner], counts[inner] - length, origins[inner], late[inner])
    # A window whose next one lies behind its run; at most ``length`` in a run.
    size = np.minimum(counts, length)
    run = np.repeat(np.arange(len(starts)), size)
    p = (starts + counts)[run] - np.repeat(np.cumsum(size), size) + np.arange(len(run))
    other = np.searchsorted(starts, p + length, "right") - 1
    ok = (other > run) & (p + length < (starts + counts)[other])
    p, run, other = p[ok], run[ok], other[ok]
    return known, p, origins[run] + p - starts[run], origins[other] + p + length - starts[other]


def _hits(part: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places (rising), origins and lateness of each row's hits; a text's own origins follow its begin."""
    column = part.column("hits")
    flat = column.flatten()
    at, origin = flat.field(0).to_numpy(zero_copy_only=False), pc.fill_null(flat.field(1), 0).to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    begin = np.repeat(part.column("begin").to_numpy(zero_copy_only=False), sizes)
    origin = np.where(flat.field(1).is_null().to_numpy(zero_copy_only=False), begin + (at >> 1), origin)
    stops = np.cumsum(sizes).tolist()
    out = []
    for x, y in zip([0, *stops], stops, strict=False):
        a, first = np.unique(at[x:y], return_index=True)
        out.append((a >> 1, origin[x:y][first], (a & 1).astype(bool)))
    return out


def _result(length: int):
    """What a text loses, and its windows of twice the length that may be repeated."""
    kinds = {"digest": pa.binary(), "n_words": pa.int64(), "lost_starts": pa.list_(pa.int64()), "lost_stops": pa.list_(pa.int64()), "kept_sha256": pa.string(), "kept": pa.binary(), **NEXT_KINDS}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                rows = []
                for key, doc, digest, text, hits in zip(*(part.column(c).to_pylist() for c in ("key", "doc", "digest", "text")), _hits(part), strict=True):
                    places, origins, late = hits
                    starts, stops = runs(places[late], length)
                    n, kept = without(text, starts, stops)
                    known, *pairs = twice(as_runs(places, origins, late), length)
                    rows.append((digest, n, starts, stops, hashlib.sha256(kept).hexdigest(), kept, key, doc, len(starts) > 0, *known, *pairs))
                yield batch(dict(zip(kinds, zip(*rows) if rows else [[]] * len(kinds), strict=True)), kinds)

    return run


def runs(places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of words covered by windows at ``places`` (rising)."""
    if not len(places):
        return places, places
    apart = np.flatnonzero(places[1:] > places[:-1] + length)
    return places[np.concatenate([[0], apart + 1])], places[np.concatenate([apart, [len(places) - 1]])] + length


def without(text: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[int, bytes]:
    """How many words a text has, and those outside the runs, joined by one space."""
    n, kept = 0, []
    for block in word_blocks(text):
        words, at, own = block.split(), 0, []
        first, last = np.searchsorted(stops, n, "right"), np.searchsorted(starts, n + len(words))
        for x, y in zip((starts[first:last] - n).tolist(), (stops[first:last] - n).tolist(), strict=True):
            own += words[at : max(x, 0)]
            at = y
        own += words[at:]
        n += len(words)
        if own:
            kept.append(b" ".join(own))
    return n, b" ".join(kept)


def _extend(length: int):
    """From a level's candidates and the hits among their pairs, whether a window is late, and the candidates of twice the length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                rows = []
                known = ("starts", "counts", "origins", "lates")
                for key, doc, starts, counts, origins, lates, hits in zip(*(part.column(c).to_pylist() for c in ("key", "doc", *known)), _hits(part), strict=True):
                    counts = np.array(counts, np.int64)
                    step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    places, origin = (np.concatenate([np.repeat(np.array(v, np.int64), counts) + step, h]) for v, h in ((starts, hits[0]), (origins, hits[1])))
                    late = np.concatenate([np.repeat(np.array(lates, bool), counts), hits[2]])
                    order = np.argsort(places)
                    runs_, *pairs = twice(as_runs(places[order], origin[order], late[order]), length)
                    if late.any() or len(runs_[0]) or len(pairs[0]):
                        rows.append((key, doc, bool(late.any()), *runs_, *pairs))
                yield batch(dict(zip(NEXT_KINDS, zip(*rows) if rows else [[]] * len(NEXT_KINDS), strict=True)), NEXT_KINDS)

    return run


def longest(state: DataFrame, length: int) -> DataFrame:
    """key and longest: for texts of ``state`` (rows of ``NEXT``: candidates of twice ``length``) the greatest length of the
    levels at which a window also starts in a smaller document. Texts without one are not listed."""
    spark = state.sparkSession
    found = [state.where("late").select("key", F.lit(length).cast("long").alias("longest"))]
    while True:
        length *= 2
        size = state.agg(F.count_if(F.size("starts") + F.size("places") > 0).alias("texts"), F.sum(F.size("places")).alias("pairs")).first()
        if not size["texts"]:
            break
        state = state.where(F.size("starts") + F.size("places") > 0)
        rows = state.select("key", "doc", F.explode(F.arrays_zip("places", "h1", "h2")).alias("w")).select("key", "doc", F.col("w.places").alias("place"), "w.h1", "w.h2")
        some = state.sample(min(1.0, SAMPLE / size["texts"]), seed=11).select("key", F.explode("h1").alias("h1")).distinct()
        hot = frequent(some, "h1", min(SAMPLE, size["texts"]))
        is_hot = F.col("h1").isin([int(x) for x in hot.view(np.int64)]) if len(hot) else F.lit(False)
        windows = rows.select("key", "doc", "place", F.when(is_hot, F.col("key")).otherwise(F.col("h1")).alias("dealt"), F.when(is_hot, F.col("h1")).alias("h1"), "h2")
        both = state.join(repeated(windows), "key", "left").withColumn("begin", begin_of("key"))
        state = cut(both.mapInArrow(_extend(length), NEXT), "window-level")
        found.append(state.where("late").select("key", F.lit(length).cast("long").alias("longest")))
    return reduce(DataFrame.unionAll, found).groupBy("key").agg(F.max("longest").alias("longest"))


def frequent(rows: DataFrame, column: str, documents: int) -> np.ndarray:
    """The most frequent values, at most HOT, among those in more than SHARE of the sampled documents."""
    counts = rows.groupBy(column).agg(F.count("*").alias("n")).where(F.col("n") > max(1.0, SHARE * documents))
    return np.array([r[column] for r in counts.orderBy(F.desc("n"), column).limit(HOT).collect()], np.int64).view(np.uint64)


def _sampled(length: int):
    """Rows (level, h): distinct short and whole windows of each text."""
    kinds = {"level": pa.int32(), "h": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, short = WordHashes(), short_length(length)
        for b in batches:
            for words in hashes.each(b.column(0).to_pylist(), lanes=1):
                for _, h, place in spoken_for(words, length):
                    whole = joined(h[:, : len(place)], h[:, length - short : length - short + len(place)])
                    for level, values in ((1, np.unique(h[0, _speakers(place)] & _SHORT)), (2, np.unique(whole[0]))):
                        yield batch({"level": np.full(len(values), level), "h": values.view(np.int64)}, kinds)

    return run


def removals(docs: DataFrame, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """What of ``docs`` is repeated, as two tables.

    Rows: doc_id and digest (SHA-256 of the text), one row per document, stored.
    Texts: of each distinct text digest, n (its documents), first (their least id), n_words, lost_starts and lost_stops (maximal
    removed runs, in words), kept (the other words joined by a space), kept_sha256, and what ``longest`` goes on from.
    """
    spark = docs.sparkSession
    n = partition_count(spark)
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    rows = cut(whole.select(F.col("doc").alias("doc_id"), "digest"), "window-rows")
    pairs = rows.groupBy("doc_id", "digest").agg(F.count("*").alias("n"))
    size = pairs.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    by_text = pairs.groupBy("digest").agg(F.min("doc_id").alias("first"), F.sum("n").alias("n"))
    total = size["rows"] or 0

    few = whole.select("text").sample(min(1.0, SAMPLE / max(1, total)), seed=11)
    seen = cut(few.mapInArrow(_sampled(words), "level int, h long"), "window-sample")
    hot_short, hot = (frequent(seen.where(F.col("level") == k), "h", min(SAMPLE, total)) for k in (1, 2))

    if (size["most"] or 0) > 1:  # repeated rows become one before they move
        whole = whole.groupBy("doc", "digest").agg(F.first("text").alias("text"))
    # An id that names one text is its key; where one doesn't, digests make keys.
    shared = pairs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").limit(1).count()
    key = (lambda doc: F.xxhash64(doc, "digest")) if shared else F.col
    # The text of least id stands for its copies; texts are shuffled once, for all three passes.
    moved = whole.select(key("doc").alias("key"), "doc", "digest", "text").repartition(n, "key")
    own = behind(moved, F.lit(True)).join(by_text.select(key("first").alias("key")).hint("merge"), "key", "left_semi")
    short = own.select("key", "text").mapInArrow(_short_windows(words, hot_short), "key long, h long")
    often = short.withColumn("n", F.count("*").over(Window.partitionBy("h"))).where("n > 1")
    alive = often.groupBy("key").agg(F.collect_list("h").alias("alive"))
    windows = own.join(alive.hint("merge"), "key", "left").select("key", "doc", "text", "alive").mapInArrow(_windows(words, hot_short, hot), WINDOW)
    result = f"digest binary, n_words long, lost_starts array<long>, lost_stops array<long>, kept_sha256 string, kept binary, {NEXT}"
    hits = repeated(windows)
    texts = own.join(hits.hint("merge"), "key", "left").withColumn("begin", begin_of("key")).mapInArrow(_result(words), result)
    # Were two keys equal, a copy could pass beside its text of least id.
    return rows, texts.join(by_text, "digest").where(F.col("doc").eqNullSafe(F.col("first")))


def op11_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document, the digest of what stays, and the level its longest repeated passage reaches."""
    rows, texts = removals(table(spark, sf_dir, "documents"))
    texts = cut(texts.drop("kept"), "window-texts")
    longer = longest(texts.select(*NEXT_KINDS), WORDS)
    lost = F.aggregate(F.zip_with("lost_starts", "lost_stops", lambda x, y: y - x), F.lit(0).cast("long"), lambda a, x: a + x)
    groups = texts.join(longer, "key", "left").select("digest", "first", "n", "n_words", lost.alias("lost"), "kept_sha256", F.coalesce("longest", F.lit(0).cast("long")).alias("longest"))
    found = join_groups(rows, groups, ["digest"])
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.col("first").isNotNull())
    gone = copy & (F.col("n_words") >= WORDS)
    level = F.lit(WORDS) * F.pow(F.lit(2), F.floor(F.log2(F.col("n_words") / WORDS)))
    return found.select(
        "doc_id", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.col("lost")).alias("n_removed"),
        F.when(gone, F.sha2(F.lit(b""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(gone, level.cast("long")).otherwise(F.col("longest")).alias("longest"),
    )


#: The same in DuckDB, by joining all windows of each length.
ORACLE_SQL = """
WITH RECURSIVE rows_ AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce("text", ''), '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents),
lengths AS (SELECT 13 AS n UNION ALL SELECT n * 2 FROM lengths WHERE n * 2 <= (SELECT max(len(w)) FROM rows_)),
windows AS MATERIALIZED (SELECT r, doc_id, n, p, md5(array_to_string(w[p:p + n - 1], ' ')) AS k
  FROM (SELECT r, doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM rows_, lengths)),
firsts AS (SELECT n, k, min(doc_id) AS least FROM windows GROUP BY n, k),
late AS MATERIALIZED (SELECT DISTINCT r, n, p FROM windows JOIN firsts USING (n, k) WHERE coalesce(doc_id > least, least IS NOT NULL)),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 13)) AS p FROM late WHERE n = 13),
lost AS (SELECT r, count(*) AS lost, list(p) AS places FROM gone GROUP BY r),
levels AS (SELECT r, max(n) AS longest FROM late GROUP BY r)
SELECT a.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(lost, 0) AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: places IS NULL OR NOT list_contains(places, i)), ' ')) AS kept_sha256, CAST(coalesce(longest, 0) AS BIGINT) AS longest
FROM rows_ a LEFT JOIN lost USING (r) LEFT JOIN levels USING (r)"""
