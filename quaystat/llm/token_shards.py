"""Token ids as raw binary shards with a minimal perfect hash index.

``write_shards`` encodes every whole text, deals the documents by ascending
key into shards of consecutive keys and writes each shard as one file of raw
little-endian ids (two bytes an id where the vocabulary allows, else four),
in key order. Beside it stands a directory table (key, shard, offset, length).
``build_index`` hashes keys into parts of bounded size and gives each part a
minimal perfect hash: a cascade of bit arrays in which a key's first lone bit,
counted by rank, is its slot. A slot stores the key's fingerprint and its
place, so a lookup costs a constant number of reads, and a key that was never
stored is refused but for a 64-bit fingerprint clash.

Defined cases: null text is empty (the end id alone); null keys are written
first and can't be looked up; equal keys are written one after another in text
order and the index leads to the first of them, with their number, so all are
found; an empty table gives no shard and no index part; other columns are ignored.
"""

from __future__ import annotations

import io
import os
import posixpath
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaystat.llm.common import batch, cut, drop_at_exit
from quaystat.llm.encode import forget, memory
from quaystat.session import qualified, scratch_path

#: Keys of one index part; a part is built and searched within one task.
PART_KEYS = 50_000
#: Bits of a level of the hash for each key that reaches it.
LEVEL_BITS = 2
LEVELS = 40
#: Texts encoded between two Arrow batches of ids.
ENCODE_ROWS = 1000
#: Words whose ids a worker keeps, some 150 bytes each; the encoder is all that its stage holds.
WORDS_KEPT = 1_500_000
DIRECTORY = "key long, shard int, position long, offset long, n_tokens long"


@dataclass(frozen=True)
class Store:
    """A written set of shards: payload folder, id width in bytes, directory, index and shard starts."""

    path: str
    width: int
    directory: DataFrame
    index: DataFrame
    starts: DataFrame


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser over key plus seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bits, slot = rank of the key's bit."""

    def __init__(self, levels: list[np.ndarray], last: np.ndarray):
        self.levels = levels
        self.last = last  # keys that no level separated, in order; their slots follow
        sizes = [int(b.sum()) for b in levels]
        self.before = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ranks = [np.concatenate([[0], np.cumsum(b)]).astype(np.int64) for b in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, levels = keys.astype(np.uint64), []
        while len(left) and len(levels) < LEVELS:
            size = LEVEL_BITS * len(left) + 1
            at = (_mix(left, len(levels) + 1) % np.uint64(size)).astype(np.int64)
            lone = np.bincount(at, minlength=size) == 1
            levels.append(lone)
            left = left[~lone[at]]
        return cls(levels, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; any slot, or -1, for a key that wasn't built in."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            at = (_mix(keys[open_], k + 1) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self.before[k] + self.ranks[k][at[hit]]
            open_ = open_[~hit]
        if len(self.last) and len(open_):
            at = np.searchsorted(self.last, keys[open_]).clip(max=len(self.last) - 1)
            hit = self.last[at] == keys[open_]
            out[open_[hit]] = self.before[-1] + at[hit]
        return out

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, last=self.last, sizes=np.array([len(b) for b in self.levels], np.int64), **{f"b{k}": np.packbits(b) for k, b in enumerate(self.levels)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        z = np.load(io.BytesIO(raw))
        return cls([np.unpackbits(z[f"b{k}"], count=int(n)).astype(bool) for k, n in enumerate(z["sizes"])], z["last"])


def _encoder(tokenizer: str, width: int):
    kinds = {"key": pa.int64(), "ids": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = memory(tokenizer, WORDS_KEPT)
        for b in batches:
            for at in range(0, b.num_rows, ENCODE_ROWS):
                part = b.slice(at, ENCODE_ROWS)
                ids = words.encode(part.column(1).to_pylist())
                packed = [_packed(x, width) for x in ids]
                yield batch({"key": part.column(0), "ids": packed}, kinds)

    return run


def _packed(ids: bytes, width: int) -> bytes:
    """Ids of four bytes in ``width`` bytes; an id that doesn't fit is an error."""
    if width == 4:
        return ids
    values = np.frombuffer(ids, "<u4")
    if len(values) and int(values.max()) >> (8 * width):
        raise ValueError(f"token id {int(values.max())} doesn't fit {width} bytes: choose a larger width")
    return values.astype(f"<u{width}").tobytes()


def _writer(path: str, width: int):
    kinds = {"key": pa.int64(), "shard": pa.int32(), "position": pa.int64(), "offset": pa.int64(), "n_tokens": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        fs, root = _fs(path)
        shard, out, name, offset, position = None, None, "", 0, 0
        for b in batches:
            rows = {k: [] for k in kinds}
            for key, at, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if at != shard:
                    if out is not None:
                        _publish(fs, out, name, shard, root)
                    # A name of its own until done: a task that runs twice never leaves half a shard.
                    shard, offset, position, name = at, 0, 0, posixpath.join(root, f".{at:06d}.{os.urandom(6).hex()}")
                    out = fs.open_output_stream(name)
                out.write(ids)
                n = len(ids) // width
                for k, v in (("key", key), ("shard", shard), ("position", position), ("offset", offset), ("n_tokens", n)):
                    rows[k].append(v)
                offset, position = offset + n, position + 1
            yield batch(rows, kinds)
        if out is not None:
            _publish(fs, out, name, shard, root)

    return run


def shard_name(root: str, shard: int) -> str:
    return posixpath.join(root, f"shard-{shard:06d}.bin")


def _publish(fs: pafs.FileSystem, out, name: str, shard: int, root: str) -> None:
    out.close()
    fs.move(name, shard_name(root, shard))


def write_shards(docs: DataFrame, tokenizer: str, path: str, shards: int, key: str = "doc_id", text: str = "text", width: int = 2) -> DataFrame:
    """Write the shards of ``docs`` under ``path`` and return the directory, a table of one row per document.

    Shards hold ranges of keys with about equal numbers of documents. The
    bounds come from a pass over the key column alone; texts are encoded where
    they are read and only ids are shuffled.
    """
    spark = docs.sparkSession
    path = qualified(spark, path)  # a path without scheme means the same place to Spark and to Python workers
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    cuts = rows.select(F.percentile_approx("key", [i / shards for i in range(1, shards)] or [0.5], 20 * shards).alias("c")).first()["c"] if shards > 1 else []
    bounds = np.unique(np.array(cuts or [], np.int64))
    fs, root = _fs(path)
    fs.create_dir(root, recursive=True)
    ids = rows.mapInArrow(_encoder(tokenizer, width), "key long, ids binary")
    shard = F.lit(0)
    if len(bounds):
        # Number of bounds at or below the key, by halving: a balanced tree of comparisons.
        def tree(lo: int, hi: int):
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(F.col("key") >= int(bounds[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

        shard = tree(0, len(bounds))
    dealt = ids.select("key", shard.cast("int").alias("shard"), "ids").repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "ids")
    return cut(dealt.mapInArrow(_writer(path, width), DIRECTORY), "token-directory")


def build_index(directory: DataFrame) -> DataFrame:
    """One row per part: its perfect hash and, by slot, fingerprint, shard, position, offset, length and copies."""
    keys = directory.where("key is not null").groupBy("key").agg(F.min(F.struct("shard", "position", "offset", "n_tokens")).alias("at"), F.count("*").alias("copies"))
    parts = max(1, -(-keys.count() // PART_KEYS))

    def build(pdf):
        k = pdf["key"].to_numpy(np.int64)
        hashed = PerfectHash.build(k)
        order = np.argsort(hashed.slots(k))
        by_slot = pdf.iloc[order]
        import pandas as pd

        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "hash": [hashed.to_bytes()], "prints": [_mix(k[order], 99).tobytes()]} | {c: [by_slot[c].to_numpy(np.int64).tobytes()] for c in ("shard", "position", "offset", "n_tokens", "copies")})

    return (
        keys.select("key", _part("key", parts).alias("part"), "at.*", "copies")
        .groupBy("part")
        .applyInPandas(build, "part int, hash binary, prints binary, shard binary, position binary, offset binary, n_tokens binary, copies binary")
        .withColumn("parts", F.lit(parts))
    )


def _part(key: str, parts: int):
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def lookup(keys: DataFrame, store: Store) -> DataFrame:
    """Place of each asked key (column ``key``) by the index: key, shard, position, offset, n_tokens, copies; unknown keys give no row."""
    got = store.index.select("parts").first()
    if got is None:
        return store.directory.select("key", "shard", "position", "offset", "n_tokens", F.lit(1).cast("long").alias("copies")).limit(0)
    asked = keys.where("key is not null").select("key", _part("key", got["parts"]).alias("part"))

    def find(left, right):
        import pandas as pd

        names = ["shard", "position", "offset", "n_tokens", "copies"]
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ["key", *names]})
        row = right.iloc[0]
        k = left["key"].to_numpy(np.int64)
        slot = PerfectHash.from_bytes(row["hash"]).slots(k)
        prints = np.frombuffer(row["prints"], np.uint64)
        ok = (slot >= 0) & (prints[slot] == _mix(k, 99))
        return pd.DataFrame({"key": k[ok]} | {c: np.frombuffer(row[c], np.int64)[slot[ok]] for c in names})

    return asked.groupBy("part").cogroup(store.index.drop("parts").groupBy("part")).applyInPandas(find, "key long, shard long, position long, offset long, n_tokens long, copies long")


def build_store(spark: SparkSession, docs: DataFrame, tokenizer: str, shards: int | None = None, path: str | None = None, width: int = 2) -> Store:
    """Shards, directory and index of ``docs`` under ``path`` (a new folder beside the checkpoints if None)."""
    if path is None:
        path = scratch_path(spark, "token-shards")
        drop_at_exit(spark, path)
    path = qualified(spark, path)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    directory = write_shards(docs, tokenizer, path, shards, width=width)
    index = cut(build_index(directory), "token-index")
    by_shard = directory.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    # One row per shard: a few bytes for each file written.
    starts = by_shard.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    return Store(path, width, directory, index, starts)


def read_documents(places: DataFrame, store: Store, each: Callable[[bytes], object] | None = None, kind: tuple[str, pa.DataType] = ("binary", pa.binary())) -> DataFrame:
    """Ids of the documents at ``places`` (from ``lookup`` or the directory), read from the shard files.

    One row per document: key, shard, offset, n_tokens and ids (raw
    little-endian uint32), or what ``each`` makes of them, of type ``kind``.
    Each task opens a shard once and reads its places in order.
    """
    path, width = store.path, store.width
    kinds = {"key": pa.int64(), "shard": pa.int32(), "offset": pa.int64(), "n_tokens": pa.int64(), "ids": kind[1]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        fs, root = _fs(path)
        shard, file = None, None
        for b in batches:
            for start in range(0, b.num_rows, 1000):
                part = b.slice(start, 1000)
                key, at, off, n = (c.to_pylist() for c in part.columns)
                ids = []
                for s, o, k in zip(at, off, n, strict=True):
                    if s != shard:
                        shard, file = s, fs.open_input_file(shard_name(root, s))
                    raw = file.read_at(k * width, o * width)
                    raw = np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()
                    ids.append(each(raw) if each else raw)
                yield batch(dict(zip(kinds, (key, at, off, n, ids), strict=True)), kinds)

    n = int(store.directory.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = places.select("key", F.col("shard").cast("int").alias("shard"), "offset", "n_tokens")
    return rows.repartition(n, "shard", (F.col("offset") / F.lit(4_000_000)).cast("long")).sortWithinPartitions("shard", "offset").mapInArrow(run, f"key long, shard int, offset long, n_tokens long, ids {kind[0]}")


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, from the files by the index: place, number of ids and their checksum."""
    import public_tokenizers

    from quaystat.llm.common import table

    docs = table(spark, sf_dir, "documents")
    store = build_store(spark, docs, public_tokenizers.path("word_bpe_49k.json"))
    found = lookup(docs.select(F.col("doc_id").alias("key")).distinct(), store)
    # Copies of a key, and documents without one, stand in the directory beside the first.
    single = found.where("copies = 1").select("key", "shard", "offset", "n_tokens")
    several = found.where("copies > 1").select("key").join(store.directory, "key").select("key", F.col("shard").cast("long"), "offset", "n_tokens")
    unnamed = store.directory.where("key is null").select("key", F.col("shard").cast("long"), "offset", "n_tokens")
    rows = read_documents(single.unionAll(several).unionAll(unnamed), store, zlib.crc32, ("long", pa.int64()))
    digests = rows.select(F.col("key").alias("doc_id"), "shard", "offset", "n_tokens", F.col("ids").alias("ids_crc32"))
    return digests.join(F.broadcast(store.starts), "shard").select("doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
