"""Helpers shared by the operators: input tables, scratch tables, Arrow output."""

from __future__ import annotations

from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystat.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return the table read back.

    Cuts the lineage on storage that outlives any executor. Unless ``keep``,
    the folder goes when the driver ends.
    """
    return written(df, name, keep)[0]


def written(df: DataFrame, name: str, keep: bool = False) -> tuple[DataFrame, str]:
    """As ``cut``, with the path of the table, for a later ``delete``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if not keep:
        drop_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def delete(spark: SparkSession, path: str) -> None:
    """Remove a table that no later step reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_at_exit(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)


def batch(columns: dict[str, object], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    """A record batch with exactly the columns of ``types``, in their order."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], type=kind) for name, kind in types.items()], names=list(types)
    )


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, lengthened where a column is called so already, in whatever case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, UPPER, UPPER.lower())


def partition_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: A key with more than this share of all rows (one in so many) is hot; there are fewer such keys than this number.
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the columns of ``groups`` (one row a key, n = how many rows of all have it), without n.

    Hot keys, at most ``HOT_SHARE`` of them, are broadcast, so that none goes through one
    task; all others are joined as Spark sees fit. Null keys equal each other. ``rows`` is
    read twice, so hand over a stored table.
    """
    total = groups.agg(F.sum("n")).first()[0] or 0
    values = [c for c in groups.columns if c not in on and c != "n"]
    named = groups.select(*[F.col(k).alias(f"__group_{k}") for k in on], *values, (F.col("n") * HOT_SHARE > total).alias("__hot"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__group_{k}")) for k in on])
    hot = F.broadcast(named.where("__hot"))
    out = [*rows.columns, *values]
    spread = rows.join(hot, same).select(*out)
    rest = rows.join(hot, same, "left_anti").join(named.where("not __hot"), same).select(*out)
    return spread.unionAll(rest)


def is_held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's decimal text is divisible by 5; null ids are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))
