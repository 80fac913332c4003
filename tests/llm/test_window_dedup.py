"""Repeated word windows against a plain search, level by level."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quaystat.llm import window_dedup
from quaystat.llm.common import cut

DDL = "doc_id long, text string, key string, digest int, n int, places int"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, length=13):
    """(doc_id, n_words, n_removed, kept_sha256, longest level) of every row."""
    first = {}  # window -> least id
    sizes = []
    size = length
    while size <= max((len(words_of(t)) for _, t in rows), default=0):
        sizes.append(size)
        size *= 2
    for i, t in rows:
        w = words_of(t)
        for s in sizes:
            for p in range(len(w) - s + 1) if i is not None else ():
                k = tuple(w[p : p + s])
                first[k] = min(i, first.get(k, i))
    out = []
    for i, t in rows:
        w = words_of(t)
        gone, longest = [False] * len(w), 0
        for s in sizes:
            for p in range(len(w) - s + 1):
                f = first.get(tuple(w[p : p + s]))
                if f is not None and (i is None or f < i):
                    longest = s
                    if s == length:
                        gone[p : p + s] = [True] * s
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), longest))
    return out


def prose(seed, n, vocabulary=400):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}é" if x % 7 == 0 else f"w{x}" for x in rng.integers(0, vocabulary, n))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, 3) for r in rows], DDL).repartition(3)


def found(spark, tmp_path, rows):
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in window_dedup.op11_window_dedup(spark, str(tmp_path)).collect()), key=str)


PASSAGE, LONG = prose(1, 13), prose(2, 300)
ODD = [
    (1, None), (2, ""), (3, " \n\t\x0b\x0c\r "), (4, prose(3, 12)), (5, prose(3, 12)), (6, PASSAGE), (7, "a " + PASSAGE.replace(" ", "\n\t") + "\xa0b"), (8, PASSAGE + " x"),
    (9, LONG), (10, "z " + LONG + " z"), (11, LONG), (11, LONG), (12, LONG[: len(LONG) // 2]), (None, "q " + LONG), (None, "q " + LONG), (None, prose(4, 30)), (None, prose(4, 30) + " t"),
    (13, "x " * 60), (14, "x " * 40), (15, "x " * 13 + "y"), (16, prose(5, 40) + " " + PASSAGE + " " + prose(6, 20) + " " + PASSAGE), (17, prose(7, 26)), (17, prose(7, 26) + " more"), (0, "c\x00d \x1c " + prose(8, 15)),
]


def test_odd_rows(spark, tmp_path):
    assert found(spark, tmp_path, ODD) == sorted(brute(ODD), key=str)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("seed", range(3))
def test_random_joins(spark, tmp_path, monkeypatch, seed, hot):
    if hot:  # nearly every window that is repeated takes the spread route
        monkeypatch.setattr(window_dedup, "SHARE", 0.0)
    else:
        monkeypatch.setattr(window_dedup, "SHARE", 1.0)
    monkeypatch.setattr(window_dedup, "STRETCH", 40)  # stretches and blocks end inside passages
    monkeypatch.setattr(window_dedup, "BLOCK", 64)
    rng = np.random.default_rng(seed)
    pool = [prose(100 + k, int(rng.integers(5, 70)), 30).split() for k in range(8)]
    rows = []
    for i in rng.permutation(60).tolist():
        w = []
        for k in rng.integers(0, 8, int(rng.integers(0, 5))):
            a = int(rng.integers(0, 10))
            w += pool[k][a:] if rng.random() < 0.7 else prose(1000 + i, 9, 30).split()
        rows.append((i if rng.random() < 0.9 else None, " ".join(w)))
    rows = [r for r in rows if r[0] is not None] if seed == 2 else rows + rows[:4]  # ids that name one text, or not
    assert found(spark, tmp_path, rows) == sorted(brute(rows), key=str)


def test_empty_table(spark):
    rows, texts = window_dedup.removals(frame(spark, []))
    assert rows.count() == 0 and texts.count() == 0


def test_kept_text_and_runs(spark):
    rows = [(1, PASSAGE), (2, f"a b  {PASSAGE}\nc")]
    _, texts = window_dedup.removals(frame(spark, rows))
    got = {r["doc"]: (r["lost_starts"], r["lost_stops"], bytes(r["kept"])) for r in texts.collect()}
    assert got == {1: ([], [], PASSAGE.encode()), 2: ([2], [15], b"a b c")}


def test_hashes_of_a_long_text_are_those_of_its_words(monkeypatch):
    text = prose(9, 5000).encode()
    hashes = window_dedup.WordHashes()
    plain = next(hashes.each([text]))
    assert plain.shape == (2, 5000) and np.array_equal(next(hashes.each([text], lanes=1)), plain[:1])
    some = [b"", text[:500], b" \n", text[500:900], b"", text, b"x"]
    together = list(hashes.each(some))
    monkeypatch.setattr(window_dedup, "BLOCK", 100)
    monkeypatch.setattr(window_dedup, "TOGETHER", 0)
    assert all(np.array_equal(x, y) for x, y in zip(together, hashes.each(some), strict=True))
    assert np.array_equal(plain, next(hashes.each([b" " + text + b"\n"]))) and np.array_equal(plain, together[5])
    words = text.split()
    assert all(len({tuple(plain[:, i]) for i, x in enumerate(words) if x == w}) == 1 for w in words[:50])
    assert len({tuple(c) for c in plain.T}) == len(set(words))
    whole = window_dedup.window_hashes(plain, 13)
    assert whole.shape[1] == 5000 - 12 and np.array_equal(window_dedup.window_hashes(plain[:, 77:90], 13)[:, 0], whole[:, 77])


def test_hashes_tell_like_words_apart():
    words = [bytes([a, b]) for a in range(97, 123) for b in range(97, 123)] + [b"a" * n for n in range(1, 300)] + [b"ab" * n for n in range(2, 300)] + [b"ba" * n for n in range(2, 300)]
    got = next(window_dedup.WordHashes().each([b" ".join(words)]))
    assert all(len(set(lane.tolist())) == len(set(words)) for lane in got)


def test_query_equals_its_sql(spark, tmp_path):
    rows = [r for r in ODD if r[0] is not None and "\x00" not in (r[1] or "")]
    got = found(spark, tmp_path, rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.execute(window_dedup.ORACLE_SQL).fetchall(), key=str) == [r for r in got]
