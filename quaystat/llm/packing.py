"""Packing of documents into sequences by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut into full pieces and a rest; full
pieces are sequences by themselves. All other pieces are dealt by a hash of
their row number into blocks of bounded size. For each block several islands
evolve populations of groupings: crossover injects whole well-filled bins of
one parent into the other, drops the bins that then hold a piece twice, and
puts the displaced pieces back by best fit. Between epochs each island sends
its best grouping to the next island of the block. The best grouping of a
block stands, but for its poorly filled bins: their pieces are dealt anew
with those of other blocks, and packed again.

Defined cases: null or empty text is one piece (the end id alone); repeated
rows are packed each for itself; an empty table gives no row; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaystat.llm.common import batch, cut, table
from quaystat.llm.encode import memory

SEQUENCE_TOKENS = 4096
#: Pieces of one block; all islands of a block hold the same pieces.
BLOCK_PIECES = 1500
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 6
#: Bins filled less than this share go to the next round.
WELL_FILLED = 0.999
ROUNDS = 3
#: Words that the operator's own encoder keeps per worker process; in the pipeline, whose workers hold other things, it keeps ``encode.WORDS_KEPT``.
WORDS_KEPT = 1_500_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SOLUTION = "block long, island int, fitness double, uids binary, lens binary, bins binary"


def cut_pieces(docs: DataFrame, tokenizer: str, limit: int = SEQUENCE_TOKENS, kept: int | None = None) -> DataFrame:
    """Pieces of at most ``limit`` ids of every whole document, each with the checksum of its ids.

    ``kept``: words that the encoder of a worker process keeps; they decide on time and memory only."""
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = memory(tokenizer, kept)
        for b in batches:
            rows = []
            parts = (b.slice(at, 1000) for at in range(0, b.num_rows, 1000))
            for doc, ids in ((d, i) for p in parts for d, i in zip(p.column(0).to_pylist(), words.encode(p.column(1).to_pylist()), strict=True)):
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield batch(dict(zip(kinds, zip(*rows) if rows else [[]] * 5, strict=True)), kinds)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


class Grouping:
    """Pieces in bins of one capacity, with the free room of each bin."""

    def __init__(self, lens: list[int], capacity: int):
        self.lens, self.capacity = lens, capacity
        self.bins: list[list[int]] = []
        self.free: list[int] = []

    def best_fit(self, pieces: list[int]) -> None:
        """Put pieces, in the order given, each into the bin that it leaves the least room in, or a new one."""
        rooms = sorted((f, b) for b, f in enumerate(self.free) if f)
        for p in pieces:
            n = self.lens[p]
            at = bisect_left(rooms, (n, -1))
            if at < len(rooms):
                room, b = rooms.pop(at)
                self.bins[b].append(p)
                self.free[b] = room - n
            else:
                b = len(self.bins)
                self.bins.append([p])
                self.free.append(self.capacity - n)
            if self.free[b]:
                insort(rooms, (self.free[b], b))

    def fitness(self) -> float:
        """Mean squared fill: rises with fewer bins and with room gathered in few of them."""
        c = self.capacity
        return sum(((c - f) / c) ** 2 for f in self.free) / max(1, len(self.free))

    def assignment(self) -> np.ndarray:
        out = np.empty(len(self.lens), np.int32)
        for b, pieces in enumerate(self.bins):
            out[pieces] = b
        return out

    @classmethod
    def of(cls, lens: list[int], capacity: int, assignment: np.ndarray) -> Grouping:
        g = cls(lens, capacity)
        g.bins = [[] for _ in range(int(assignment.max()) + 1)] if len(assignment) else []
        for p, b in enumerate(assignment.tolist()):
            g.bins[b].append(p)
        g.free = [capacity - sum(lens[p] for p in pieces) for pieces in g.bins]
        return g


def crossover(a: Grouping, b: Grouping, rng: np.random.Generator) -> Grouping:
    """A child of ``a`` with some of the best filled bins of ``b``."""
    by_fill = np.argsort(b.free, kind="stable")
    good = by_fill[: max(1, len(by_fill) // 2)]
    injected = rng.choice(good, size=max(1, len(good) // 2), replace=False).tolist()
    child = Grouping(a.lens, a.capacity)
    child.bins = [list(b.bins[k]) for k in injected]
    child.free = [b.free[k] for k in injected]
    taken = {p for pieces in child.bins for p in pieces}
    displaced: list[int] = []
    poor = set(np.argsort(a.free, kind="stable")[::-1][: max(1, len(a.free) // 20)].tolist())
    for k, pieces in enumerate(a.bins):
        if k not in poor and taken.isdisjoint(pieces):
            child.bins.append(list(pieces))
            child.free.append(a.free[k])
        else:
            displaced += [p for p in pieces if p not in taken]
    displaced.sort(key=lambda p: -a.lens[p])
    child.best_fit(displaced)
    return child


def evolve(lens: list[int], capacity: int, population: list[Grouping], seed: int) -> list[Grouping]:
    """Some generations of crossover; the least filled grouping gives way to a better child."""
    rng = np.random.default_rng(seed)
    least = -(-sum(lens) // capacity)
    while len(population) < POPULATION:
        g = Grouping(lens, capacity)
        jitter = rng.uniform(0.8, 1.25, len(lens)) if population else np.ones(len(lens))
        g.best_fit(np.argsort(-np.array(lens) * jitter, kind="stable").tolist())
        population.append(g)
    population.sort(key=Grouping.fitness, reverse=True)
    for _ in range(GENERATIONS * POPULATION):
        if len(population[0].bins) == least and min(population[0].free, default=0) == 0 and population[0].free.count(0) >= least - 1:
            break
        i, j = rng.choice(len(population), size=2, replace=False)
        child = crossover(population[min(i, j)], population[max(i, j)] if rng.random() < 0.5 else population[0], rng)
        if child.fitness() > population[-1].fitness():
            population[-1] = child
            population.sort(key=Grouping.fitness, reverse=True)
    return population


def _solution(block: int, island: int, uids: np.ndarray, lens: np.ndarray, g: Grouping) -> tuple:
    return block, island, g.fitness(), uids.tobytes(), lens.tobytes(), g.assignment().tobytes()


def pack_block(items: DataFrame, capacity: int, blocks: int, round_: int) -> DataFrame:
    """Evolve every block of ``items`` (uid, length) and return the best grouping: block, uid, length, bin."""

    def first(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block, island = key
        pdf = pdf.sort_values("uid")
        uids, lens = pdf["uid"].to_numpy(np.int64), pdf["length"].to_numpy(np.int32)
        best = evolve(lens.tolist(), capacity, [], seed=(int(block) * ISLANDS + int(island)) * 7 + round_)
        return pd.DataFrame([_solution(block, island, uids, lens, g) for g in best], columns=SOLUTION_NAMES)

    def later(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block, island = key
        pdf = pdf.sort_values(["fitness", "bins"], ascending=False).head(POPULATION)
        uids, lens = np.frombuffer(pdf["uids"].iloc[0], np.int64), np.frombuffer(pdf["lens"].iloc[0], np.int32)
        known = [Grouping.of(lens.tolist(), capacity, np.frombuffer(x, np.int32)) for x in pdf["bins"]]
        best = evolve(lens.tolist(), capacity, known, seed=(int(block) * ISLANDS + int(island)) * 7 + round_ + 1000)
        return pd.DataFrame([_solution(block, island, uids, lens, g) for g in best[:1]], columns=SOLUTION_NAMES)

    dealt = items.select(
        "uid", "length", F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    )
    solved = dealt.groupBy("block", "island").applyInPandas(first, SOLUTION)
    for _ in range(EPOCHS - 1):
        rank = F.row_number().over(Window.partitionBy("block", "island").orderBy(F.desc("fitness"), "bins"))
        # The elite of an island also joins the next one in the ring.
        homes = F.when(F.col("rank") == 1, F.array("island", (F.col("island") + 1) % ISLANDS)).otherwise(F.array("island"))
        solved = solved.withColumn("rank", rank).withColumn("island", F.explode(homes)).drop("rank").groupBy("block", "island").applyInPandas(later, SOLUTION)

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                yield pd.DataFrame({"block": row.block, "uid": np.frombuffer(row.uids, np.int64), "length": np.frombuffer(row.lens, np.int32).astype("int64"), "bin": np.frombuffer(row.bins, np.int32)})

    best = solved.groupBy("block").agg(F.max_by(F.struct("uids", "lens", "bins"), F.struct("fitness", "bins")).alias("s")).select("block", "s.*")
    return best.mapInPandas(places, "block long, uid long, length long, bin int")


SOLUTION_NAMES = ["block", "island", "fitness", "uids", "lens", "bins"]


def pack(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """Sequence and place of every piece: the columns of ``pieces`` plus sequence_id and offset.

    ``pieces`` needs a column length of 1 to ``capacity``. Sequences are
    numbered apart by round and block, not gaplessly.
    """
    rows = cut(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    left = rows.where(F.col("length") < capacity).select("uid", "length")
    done = rows.where(F.col("length") >= capacity).select("uid", "length", F.col("uid").alias("sequence_id"))
    placed = None
    for round_ in range(ROUNDS):
        blocks = max(1, -(-left.count() // BLOCK_PIECES))
        got = pack_block(left, capacity, blocks, round_)
        filled = F.sum("length").over(Window.partitionBy("block", "bin"))
        # Negative numbers, one range for each round, keep clear of the full pieces' own.
        name = -(F.lit(1) + F.lit(round_) + F.lit(ROUNDS) * (F.col("block") * F.lit(BLOCK_PIECES * 8) + F.col("bin")))
        got = cut(got.select("uid", "length", name.alias("sequence_id"), filled.alias("filled")), f"packed-{round_}")
        last = round_ == ROUNDS - 1 or blocks == 1
        kept = got if last else got.where(F.col("filled") >= F.lit(WELL_FILLED * capacity))
        placed = kept if placed is None else placed.unionAll(kept)
        if last:
            break
        left = got.where(F.col("filled") < F.lit(WELL_FILLED * capacity)).select("uid", "length")
    at = done.unionAll(placed.select("uid", "length", "sequence_id"))
    before = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    at = at.select("uid", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))
    return rows.join(at, "uid").drop("uid")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence, place and checksum of every piece of every document."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return pack(cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), kept=WORDS_KEPT))
