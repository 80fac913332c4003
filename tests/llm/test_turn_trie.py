"""The conversation trie against a plain count of prefixes, its radix tree and its SQL."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quaystat.llm import turn_trie
from quaystat.llm.common import cut

DDL = "conv_id long, turn long, role string, text string, key string, node int, n int"


def brute(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [v[2:] for v in sorted(vs)] for c, vs in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = set()
    for p, cs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        has_child = {q[:-1] for q in below if q}
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in cs if convs[c] == p)))
        kids = sum(len(q) == len(p) + 1 for q in below)
        out.add((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids, sum(q not in has_child for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out, len(members)


def chats(seed, n=60):
    rng = np.random.default_rng(seed)
    said = ["hi", "", None, "héllo 😀", "x" * 300, "### user: a</turn>"]
    rows = []
    for c in rng.choice(400, n, replace=False).tolist():
        for t in range(int(rng.integers(1, 14))):
            rows.append((c, None if rng.random() < 0.1 else t, [None, "user", "assistant"][int(rng.integers(3))] if rng.random() < 0.4 else "user", said[int(rng.integers(6))] if rng.random() < 0.5 else "hi"))
    return rows + rows[:5] + [(None, 1, "user", "no conversation")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2) for r in rows], DDL).repartition(3)


def nodes(df):
    members = cut(turn_trie.keys(turn_trie.rebuilt(turn_trie.turn_order(df))), "keys")
    return turn_trie.prefix_nodes(members), members


@pytest.mark.parametrize(("seed", "ranges"), [(0, 4), (1, 4), (2, 40), (3, 4), (3, 60)])
def test_query_equals_prefix_counts_and_sql(spark, tmp_path, monkeypatch, seed, ranges):
    monkeypatch.setattr(turn_trie, "partition_count", lambda _: ranges)  # many bounds cut many nodes
    rows = chats(seed, 60 if seed else 1)
    if seed == 3:  # one first turn and one whole conversation everywhere
        rows = [(c, 0, "user", "same") for c in range(300)] + [(c, 1, "assistant", "same") for c in range(300)] + [(c, 2, "user", str(c % 40)) for c in range(0, 300, 2)]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in turn_trie.op12_turn_trie(spark, str(tmp_path)).collect()]
    want, n = brute(rows)
    assert len(got) == n and set(got) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert set(con.execute(turn_trie.ORACLE_SQL).fetchall()) == want


def test_odd_tables(spark):
    assert nodes(frame(spark, []))[0].count() == 0
    assert nodes(frame(spark, [(None, 1, "user", "x")]))[0].count() == 0
    # h of conversation 12 is above one turn, and conversation 10 doesn't exist: it is left without turns.
    assert zlib.crc32(b"12") % 9 > 0
    found = nodes(frame(spark, [(12, 0, "user", "x")]))[0].collect()
    assert [(r["conv_id"], r["depth"], r["n_convs"], r["n_leaves"], r["n_children"]) for r in found] == [(12, 0, 1, 1, 0)]


def test_long_conversation(spark):
    rows = [(5, t, "user", str(t)) for t in range(3000)] + [(6, t, "user", str(t)) for t in range(2500)]
    found, members = nodes(frame(spark, rows))
    assert members.where("octet_length(key) = 48000").count() == 1
    got = found.groupBy().agg(F.count("*"), F.max("depth"), F.sum("n_convs"), F.max("n_leaves")).first()
    assert tuple(got)[:2] == (3001, 3000) and got[2] == 3001 + 2501 and got[3] == 1


def test_layouts_grow_and_paths_split():
    rng = np.random.default_rng(1)
    tree, kept = turn_trie.RadixTree(), {}
    for k in range(3000):
        key = bytes(rng.integers(0, (3, 40, 256)[k % 3], int(rng.integers(0, 6)), dtype=np.uint8))
        tree.insert(key, [], k)
        kept[key] = k
    found, layouts, stack = {}, set(), [(tree.top, b"")]
    while stack:
        node, before = stack.pop()
        key = before + node.run
        if node.value is not None:
            found[key] = node.value
        items = list(node.children.items())
        layouts.add(node.children.limit)
        assert [b for b, _ in items] == sorted({b for b, _ in items}) and len(items) <= node.children.limit
        # A node without a value branches: chains are compressed.
        assert node.value is not None or len(items) > 1 or node is tree.top
        stack += [(child, key) for _, child in items]
        assert all(node.children.get(b) is child and child.run[0] == b for b, child in items)
    assert found == kept and layouts == {4, 16, 48, 256}
