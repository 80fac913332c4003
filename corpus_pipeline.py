"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark text, packing.

Each stage works on every row its predecessor kept and returns the columns it
was given, but for the last, which returns the packed pieces. Rules for odd
rows: a null text is judged as empty text and stays null unless a stage cuts it;
rows without id are told apart by their text; columns beside those of documents
are handed on as they are. An empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, MapType, StringType, StructField, StructType
from pyspark.sql.window import Window

from quaystat.llm import common, decontaminate, packing, quality, simhash, suffix_dedup


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality ranking, learnt from the labels, accepts."""
    ranker = quality.learn(docs, common.table(spark, sf_dir, "labels"))
    (score,) = common.unused(docs.columns, "__quality")
    return quality.score(docs, ranker, docs.columns, score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component: that of the least id (rows without id last, then by text).

    Of rows with the same id and text the one with the least hash of all its columns stays.
    """
    found = simhash.near_duplicates(docs)
    own_id, own_hash, hash_of, copy = common.unused(docs.columns, "__id", "__hash", "__hash_of", "__copy")
    best = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("text_hash").isNull().alias("no_text"), "text_hash")
    chosen = found.groupBy("component").agg(F.min(best).alias("best")).select("best.*").select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash))
    marked = docs.withColumn(hash_of, F.xxhash64("text"))
    kept = marked.join(chosen, marked["doc_id"].eqNullSafe(chosen[own_id]) & marked[hash_of].eqNullSafe(chosen[own_hash]), "left_semi")
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, MapType)]  # maps have no hash
    first = F.row_number().over(Window.partitionBy("doc_id", hash_of).orderBy(F.xxhash64(*hashed)))
    return kept.withColumn(copy, first).where(F.col(copy) == 1).select(*docs.columns)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere; one left without words goes.

    All that copies of a text hold occurs elsewhere, so they go if they are long enough for a passage.
    """
    _, texts, kept = suffix_dedup.repeated_passages(docs)
    digest, left = common.unused(docs.columns, "__digest", "__left")
    found = texts.join(kept, "key", "left").select(F.col("digest").alias(digest), F.when(F.col("copies") > 1, F.lit(b"")).otherwise(F.col("kept")).alias(left))
    whole = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return _replace_texts(docs.withColumn(digest, F.unhex(F.sha2(whole, 256))), found.where(F.col(left).isNotNull()), docs.columns, digest, left)


def _replace_texts(docs: DataFrame, found: DataFrame, columns: list[str], key: str, left: str) -> DataFrame:
    """``docs`` with the bytes ``left`` by ``key`` for text, where there are any; part characters at the cuts go."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [x.decode(errors="ignore") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[key, left])

    texts = found.select(key, left).mapInArrow(decode, StructType([found.schema[key], StructField(left, StringType())]))
    joined = docs.join(texts, key, "left")
    joined = joined.where(F.col(left).isNull() | F.col(left).rlike("\\S"))
    new = {"text": F.coalesce(left, "text")}
    if "n_chars" in columns:
        new["n_chars"] = F.when(F.col(left).isNotNull(), F.length(left).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return joined.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in columns])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words inside benchmark windows; one left without words goes."""
    found = decontaminate.hits(docs, common.table(spark, sf_dir, "benchmark")).where(F.size("starts") > 0)
    own_id, own_hash, hash_of, key, left = common.unused(docs.columns, "__id", "__hash", "__hash_of", "__key", "__left")
    spans = found.select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash), F.col("starts"), F.col("stops")).distinct()
    marked = docs.withColumn(key, F.xxhash64("doc_id", "text")).withColumn(hash_of, F.xxhash64("text"))
    texts = marked.select(key, "doc_id", hash_of, F.col("text").cast("binary").alias("text"))
    same = texts["doc_id"].eqNullSafe(spans[own_id]) & (texts[hash_of] == spans[own_hash])
    hit = texts.join(spans, same).select(key, "text", "starts", "stops").dropDuplicates([key])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = [decontaminate.without(t, x, y) for t, x, y in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cut, pa.binary())], names=[key, left])

    cleaned = hit.mapInArrow(clean, StructType([StructField(key, LongType()), StructField(left, BinaryType())]))
    return _replace_texts(marked, cleaned, docs.columns, key, left)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their sequence and place in it."""
    return packing.pack(packing.cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("passages", cut_passages),
    ("benchmark", drop_benchmark),
    ("packing", pack),
]

#: Scores learnt from labels, the trie join's components and token places are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.cut(stage(spark, docs, sf_dir), name)
    return docs
