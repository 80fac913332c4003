"""Integrity checks that the database enforced with constraints.

Each check is a DataFrame of violations (empty when the data is sound), so
it can be counted, shown or written like any other result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystat.schema import FACT_KEY

# Keys that must be unique, by the name a violation is reported under.
UNIQUE = {
    "dim_date": [("dim_date", ["date_key"]), ("dim_date.full_date", ["full_date"])],
    "dim_stop": [("dim_stop", ["stop_key"]), ("dim_stop.stop_place_id", ["stop_place_id"])],
    "dim_quay": [("dim_quay", ["quay_key"]), ("dim_quay.quay_id", ["quay_id"])],
    "dim_line": [("dim_line", ["line_key"]), ("dim_line.line_id", ["line_id"])],
    "fact": [("fact", ["observation_key"]), ("fact.natural", FACT_KEY)],
}
# References: child column -> parent table and key.
FACT_REFERENCES = {
    "date_key": ("dim_date", "date_key"),
    "stop_key": ("dim_stop", "stop_key"),
    "quay_key": ("dim_quay", "quay_key"),
    "line_key": ("dim_line", "line_key"),
}


def _key_text(key: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("<null>")) for k in key])


def key_duplicates(df: DataFrame, keys: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Keys occurring more than once: (table_name, key_text, occurrences). All keys of a table in one scan."""
    names = F.explode(F.array(*[F.struct(F.lit(n).alias("table_name"), _key_text(k).alias("key_text")) for n, k in keys]))
    rows = df.select(names.alias("k")).groupBy("k.table_name", "k.key_text").agg(F.count(F.lit(1)).alias("occurrences"))
    return rows.filter(F.col("occurrences") > 1)


def fk_violations(child: DataFrame, references: dict[str, tuple[DataFrame, str]], table: str, unique: bool = False) -> DataFrame:
    """Non-null child keys without a parent row: (relation, key_value, rows).

    One scan of the child: each parent is joined by a left join with a flag. ``unique``: parents' keys are
    known to be (or are checked elsewhere).
    """
    checked = child
    for column, (parent, pk) in references.items():
        flag = parent.select(F.col(pk).alias(column), F.lit(True).alias(f"_has_{column}"))
        checked = checked.join(flag if unique else flag.distinct(), column, "left")
    broken = [
        F.when(
            F.col(c).isNotNull() & F.col(f"_has_{c}").isNull(),
            F.struct(F.lit(f"{table}.{c}").alias("relation"), F.col(c).cast("string").alias("key_value")),
        )
        for c in references
    ]
    rows = checked.select(F.explode(F.filter(F.array(*broken), lambda b: b.isNotNull())).alias("b"))
    return rows.groupBy("b.relation", "b.key_value").agg(F.count(F.lit(1)).alias("rows"))


def warehouse_key_duplicates(wh) -> DataFrame:
    """Uniqueness of every primary, natural and fact key."""
    frames = [key_duplicates(getattr(wh, table), keys) for table, keys in UNIQUE.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def warehouse_fk_violations(wh) -> DataFrame:
    """The five references of the schema."""
    fact = {c: (getattr(wh, table), pk) for c, (table, pk) in FACT_REFERENCES.items()}
    quay = {"stop_key": (wh.dim_stop, "stop_key")}
    return fk_violations(wh.fact, fact, "fact").unionByName(fk_violations(wh.dim_quay, quay, "dim_quay"))


def hour_violations(rows: DataFrame) -> DataFrame:
    """Rows breaking the 0..23 hour constraint."""
    return rows.filter(~F.col("departure_hour").between(0, 23))


NOT_NULL = [
    "collected_at_utc", "stop_place_id", "stop_name", "line_id", "transport_mode", "service_journey_id",
    "realtime", "aimed_departure_utc", "expected_departure_utc", "delay_seconds", "departure_hour", "service_date",
]
INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def broken_rules() -> Column:
    """Names of the rules of a staged row's own that it breaks: missing values, hour and delay out of range."""
    missing = [F.when(F.col(c).isNull(), F.lit(f"not_null.{c}")) for c in NOT_NULL]
    hour = F.when(~F.col("departure_hour").between(0, 23), F.lit("hour outside 0..23"))
    delay = F.when(~F.col("delay_seconds").between(INT_MIN, INT_MAX), F.lit("delay outside the integer range"))
    return F.filter(F.array(*missing, hour, delay), lambda r: r.isNotNull())


def may_repeat(rows: DataFrame, key: Sequence[str]) -> bool:
    """Whether any key may occur more than once, by 64-bit hashes; False is certain, and only hashes are shuffled."""
    return not rows.groupBy(F.xxhash64(*key).alias("_hash")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).isEmpty()


def delta_violations(delta: DataFrame, dims: dict[str, DataFrame], changed: Sequence[str]) -> DataFrame:
    """(rule, key_text, rows) of what a load would break, from its delta and the dimensions it changed: keys that occur twice
    (a key that the store held twice comes back twice in the delta) and references without a dimension row.

    The delta's keys are written out as texts only if their hashes say that one may occur twice."""
    keyed = [(delta if may_repeat(delta, FACT_KEY) else delta.limit(0), [("fact.natural", FACT_KEY)]), *((dims[name], UNIQUE[name]) for name in changed)]
    texts = [df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), _key_text(k).alias("key_text")) for n, k in keys])).alias("k")) for df, keys in keyed]
    twice = reduce(DataFrame.unionAll, texts).groupBy("k.rule", "k.key_text").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
    references = fk_violations(delta, {c: (dims[t], pk) for c, (t, pk) in FACT_REFERENCES.items()}, "fact", unique=True)
    return twice.unionByName(references.select(F.col("relation").alias("rule"), F.col("key_value").alias("key_text"), "rows"))
