"""Labels to learn from, and bounded, repeatable samples of labelled documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystat.llm.common import is_held_out


def learning_labels(labels: DataFrame, label: str) -> DataFrame:
    """Distinct (doc_id, y) of all learning rows: held-out rows, null labels and null ids are never among them."""
    return labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & ~is_held_out(F.col("doc_id"))).distinct()


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, y, text) of at most ``per_class`` learning rows of each label, and how many rows each label has.

    Held-out rows, null labels and null ids are never taken. The rows with the
    least hashes of their id are, so a sample repeats. A document with two labels
    counts as both.
    """
    known = learning_labels(labels, label)
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id")
    picked = reduce(DataFrame.unionAll, [known.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class) for y in (0, 1)])
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(picked), "doc_id")  # 2 * per_class ids at most
    return rows.select("doc_id", "y", "text"), {y: counts.get(y, 0) for y in (0, 1)}
