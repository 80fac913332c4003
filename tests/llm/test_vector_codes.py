"""Vector codes against plain Lloyd rounds in Python integers."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quaystat.llm import vector_codes
from quaystat.llm.common import join_groups

DDL = "vec_id long, embedding array<double>, label int, q int, code string, n long"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(code, error) of each valid row and the codebooks, by comparing with every entry in Python integers."""
    import math

    kept = [(i, [math.floor(scale * x) for x in v], y) for i, v, y in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(kept[0][1]) // parts
    cut = [[v[p * d : (p + 1) * d] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            out.append([min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)])
        return out

    for _ in range(rounds):
        hits = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, h in zip(cut, hits, strict=True) if h[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    hits = assign()
    text = ",".join(str(x) for b in books for e in b for x in e)
    return {(i, "".join(f"{k:02x}" for _, k in h), sum(x for x, _ in h), y) for (i, _, y), h in zip(kept, hits, strict=True)}, hashlib.sha256(text.encode()).hexdigest(), len(kept)


def vectors(seed, n, size=16, grid=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.3, (n, size)) + rng.integers(0, 4, (n, 1)) * 0.5
    if grid:
        x = np.round(x * grid) / grid  # many ties
    return [(int(i), x[i].tolist(), int(i) % 3 or None) for i in range(n)]


ODD = [(900, None, 1), (901, [], 1), (902, [float("nan")] * 16, 1), (903, [None] + [0.1] * 15, 2), (904, [float("inf")] + [0.0] * 15, 2), (905, [0.5] * 8, None)]


@pytest.mark.parametrize("rows", [vectors(1, 300), vectors(2, 200, grid=2), vectors(3, 5), vectors(4, 60, grid=1) * 2 + [(None, [0.25] * 16, 7)]])
def test_codes_equal_plain_rounds(spark, rows):
    df = spark.createDataFrame([(i, v, y, 1, "c", 2) for i, v, y in rows + ODD], DDL).repartition(3)
    found = vector_codes.compress(df)
    want, digest, n = brute(rows)
    got = [(r["vec_id"], r["code"].hex(), r["error"], r["label"]) for r in found.rows.collect()]
    assert len(got) == n and set(got) == want and found.digest() == digest


def test_balls_skip_work_and_keep_the_result():
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (16, 8))
    q = centres[rng.integers(0, 16, 5000)] + rng.integers(-300, 300, (5000, 8))
    book = centres + rng.integers(-50, 50, (16, 8))
    own = vector_codes.nearest(q, centres)[0]
    best, least, work = vector_codes.ball_nearest(q, own, book)
    plain = vector_codes.nearest(q, book)
    assert np.array_equal(best, plain[0]) and np.array_equal(least, plain[1])
    assert work < 5000 * 16 / 4


@pytest.mark.parametrize("seed", range(20))
def test_balls_equal_every_entry_from_any_start(seed):
    rng = np.random.default_rng(seed)
    q, book = rng.integers(-4, 5, (400, 2)), rng.integers(-4, 5, (12, 2))  # equal entries and ties
    best, least, _ = vector_codes.ball_nearest(q, rng.integers(0, 12, 400), book)
    plain = vector_codes.nearest(q, book)
    assert np.array_equal(best, plain[0]) and np.array_equal(least, plain[1])


def test_odd_tables(spark):
    empty = vector_codes.compress(spark.createDataFrame([], DDL))
    assert empty.rows.columns == ["vec_id", "label", "code", "error"] and not empty.rows.collect()
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([(1, [0.0] * 9, 1, 1, "", 1)], DDL))
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([(1, [1e12] * 16, 1, 1, "", 1)], DDL))


def test_query_equals_its_sql(spark, tmp_path):
    rows = vectors(7, 150) + ODD[:-1]
    spark.createDataFrame([(i, v, y, 1, "c", 2) for i, v, y in rows], DDL).select("vec_id", "embedding", "label").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {tuple(r) for r in vector_codes.op13_vector_codes(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert got == set(con.execute(vector_codes.ORACLE_SQL).fetchall())
    want, digest, n = brute(rows)
    by_label = {}
    for _, _, e, y in want:
        by_label[y] = by_label.get(y, 0) + e
    assert got == {(i, c, e, by_label[y], digest) for i, c, e, y in want} and len(got) == n


def test_hot_groups_join_like_others(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 1700).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("total"))
    got = {(r["id"], r["total"]) for r in join_groups(rows, groups, ["k"]).collect()}
    totals = {r["k"]: r["total"] for r in groups.collect()}
    assert got == {(r["id"], totals[r["k"]]) for r in rows.collect()}
