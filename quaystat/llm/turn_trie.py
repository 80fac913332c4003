"""Prefix trie of conversations by adaptive radix trees over fixed-width turn ids.

A turn's id is the first 16 bytes of the SHA-256 of its role and text, so ids need no
table, and a conversation is a key: its turns' ids one after another, 16 bytes a
turn however long the texts are. Texts are read once and never gathered.

Equal keys become one with the number and the least of their conversations. The keys
are sorted into ranges, and each range builds an adaptive radix tree: inner nodes
grow from 4 over 16 and 48 to 256 children, and a run of bytes without a
branch is kept in one node. A walk of the tree emits trie nodes, but only at
depths that are whole turns, which may lie inside a compressed run.

A trie node's conversations are neighbours in key order, so it lies in one range unless
a bound cuts it. The bound's two keys tell which nodes it cuts. These come
from several ranges with sums that add up: a node's bytes and its place among its
parent's children count in the first range that holds it, a leaf is the end of a key that the
next key doesn't continue. Only cut nodes are grouped; all others are final where they are.

Defined cases: null role and text are empty; turns go by number (null first), then role and
text; repeated rows are turns of their own; rows without conversation id belong to no
conversation and count nowhere; an empty table gives no row, as its root has no
member; a conversation is one value in a task, with 16 bytes a turn; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaystat.llm.common import batch, cut, partition_count, table

#: Bytes of a turn id.
WIDTH = 16
#: Conversations of five following ids share a beginning in the query's rebuilt set, of up to this many turns less one.
FAMILY = 5
HEADS = 9


class Small:
    """Up to ``limit`` children, their bytes sorted beside them (layouts of 4 and 16)."""

    __slots__ = ("bytes", "nodes", "limit")

    def __init__(self, limit: int = 4):
        self.bytes, self.nodes, self.limit = bytearray(), [], limit

    def get(self, byte: int):
        at = bisect_left(self.bytes, byte)
        return self.nodes[at] if at < len(self.bytes) and self.bytes[at] == byte else None

    def put(self, byte: int, node) -> Small | Indexed:
        """Add or replace a child; returns the layout that holds it, a larger one if this is full."""
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.nodes[at] = node
            return self
        if len(self.nodes) == self.limit:
            bigger = Small(16) if self.limit == 4 else Indexed()
            for b, n in self.items():
                bigger.put(b, n)
            return bigger.put(byte, node)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def items(self):
        return zip(self.bytes, self.nodes, strict=True)


class Indexed:
    """Up to 48 children, found through one index byte for each of 256."""

    __slots__ = ("index", "nodes")
    limit = 48

    def __init__(self):
        self.index, self.nodes = bytearray(256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node) -> Indexed | Direct:
        if self.index[byte]:
            self.nodes[self.index[byte] - 1] = node
            return self
        if len(self.nodes) == self.limit:
            bigger = Direct()
            for b, n in self.items():
                bigger.put(b, n)
            return bigger.put(byte, node)
        self.nodes.append(node)
        self.index[byte] = len(self.nodes)
        return self

    def items(self):
        return ((b, self.nodes[at - 1]) for b, at in enumerate(self.index) if at)


class Direct:
    """One place for each of 256 bytes."""

    __slots__ = ("nodes",)
    limit = 256

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node) -> Direct:
        self.nodes[byte] = node
        return self

    def items(self):
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


class Node:
    """Bytes without a branch, the value of the key that ends behind them (if one does), children by their first byte
    and the sizes of the turns of some key through here."""

    __slots__ = ("run", "value", "children", "sizes")

    def __init__(self, run: bytes, sizes: list[int], value=None):
        self.run, self.sizes, self.value, self.children = run, sizes, value, Small()


class RadixTree:
    """Adaptive radix tree from byte keys to values."""

    def __init__(self):
        self.top = Node(b"", [])

    def insert(self, key: bytes, sizes: list[int], value) -> None:
        node, at, above = self.top, 0, None
        while True:
            same = _common(node.run, key, at)
            if same < len(node.run):  # the run splits
                upper = Node(node.run[:same], node.sizes)
                upper.children = upper.children.put(node.run[same], node)
                node.run = node.run[same:]
                above[0].children = above[0].children.put(above[1], upper)
                node = upper
            at += same
            if at == len(key):
                node.value = value
                return
            child = node.children.get(key[at])
            if child is None:
                node.children = node.children.put(key[at], Node(key[at:], sizes, value))
                return
            above = (node, key[at])
            node = child


def _common(run: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``run`` the key has from ``at`` on."""
    if key.startswith(run, at):
        return len(run)
    n = 0
    for x, y in zip(run, key[at : at + len(run)], strict=False):
        if x != y:
            break
        n += 1
    return n


# A range's sums for one trie node: conversations, least id, own children, leaves and saved bytes below and in it.
_NODE = {
    "node": pa.binary(), "parent": pa.binary(), "depth": pa.int64(), "conv_id": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(),
    "n_children": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "cut": pa.bool_(), "parent_cut": pa.bool_(),
}
NODE_DDL = "node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, cut boolean, parent_cut boolean"


class Pending:
    """A trie node whose subtree is being walked."""

    __slots__ = ("state", "digest", "depth", "size", "on_first", "on_last", "own", "cut", "n", "least", "children", "leaves", "saved")

    def __init__(self, state, depth: int, size: int, on_first: bool, on_last: bool, shared_before: int, shared_after: int):
        self.state, self.digest, self.depth, self.size, self.on_first, self.on_last = state, state.digest(), depth, size, on_first, on_last
        self.own = int(not (on_first and depth <= shared_before))
        self.cut = not self.own or (on_last and depth <= shared_after)
        self.n = self.children = self.leaves = self.saved = 0
        self.least: int | None = None

    def add(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


def trie_nodes(tree: RadixTree, first: bytes, last: bytes, shared_before: int, shared_after: int) -> Iterator[list]:
    """Rows of ``_NODE`` (without the parent's id) for every whole-turn depth of the tree.

    ``shared_before`` turns of the ``first`` key are those of the key before the range, and ``shared_after``
    turns of the ``last`` key those of the key behind it (-1: there is no such key). Values are (conversations, least id).
    """
    path = [Pending(hashlib.sha256(), 0, 0, True, True, shared_before, shared_after)]

    def close(depth: int) -> Iterator[list]:
        """Emit the nodes deeper than ``depth`` and hand their sums up."""
        while path and path[-1].depth > depth:
            t = path.pop()
            t.saved += (t.n - t.own) * t.size
            up = path[-1] if path else None
            if up:
                up.add(t.n, t.least)
                up.children += t.own
                up.leaves += t.leaves
                up.saved += t.saved
            yield [t.digest, up and up.digest, t.depth, t.least, None, t.n, t.children, t.leaves, t.saved, t.cut, bool(up and up.cut)]

    stack = [(tree.top, 0, b"")]  # a node, the whole turns before it and the bytes of a turn begun there
    while stack:
        node, depth, begun = stack.pop()
        yield from close(depth)
        data = begun + node.run
        whole = len(data) // WIDTH
        for at in range(whole):
            up, turn = path[-1], data[at * WIDTH : (at + 1) * WIDTH]
            place = slice(up.depth * WIDTH, (up.depth + 1) * WIDTH)
            state = up.state.copy()
            state.update(turn)
            path.append(Pending(state, up.depth + 1, node.sizes[up.depth], up.on_first and first[place] == turn, up.on_last and last[place] == turn, shared_before, shared_after))
        children = list(node.children.items())
        if node.value is not None:
            end = path[-1]
            end.add(*node.value)
            # A leaf unless a key goes on from here, in this range or the next.
            end.leaves += not children and not (end.on_last and end.depth <= shared_after)
        stack += [(child, depth + whole, data[whole * WIDTH :]) for _, child in reversed(children)]
    yield from close(-1)


def _range_nodes(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie nodes of one range of keys."""
    tree, first, last, bounds = RadixTree(), None, None, (-1, -1)
    for b in batches:
        for k, n, least, sizes, *bounds in zip(*(b.column(c).to_pylist() for c in ("key", "n", "least", "sizes", "shared_before", "shared_after")), strict=True):
            tree.insert(k, sizes, (n, least))
            first = k if first is None or k < first else first
            last = k if last is None or k > last else last
    if first is None:
        return
    rows = list(trie_nodes(tree, first, last, *bounds))
    least = {row[0]: row[3] for row in rows}
    for row in rows:  # final unless the parent is cut
        row[4] = least.get(row[1])
    for at in range(0, len(rows), 20_000):
        yield batch(dict(zip(_NODE, zip(*rows[at : at + 20_000]), strict=True)), _NODE)


def turn_order(conversations: DataFrame) -> DataFrame:
    """conv, pos (from 1), id and size (bytes of the text) of every turn of a conversation with an id.

    Positions are counted in two steps, within and over runs of turn numbers, so no task sorts a long conversation alone.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    number = F.col("turn").cast("long")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), number.alias("turn"), F.coalesce(F.shiftright(number, 8), F.lit(-(2**62))).alias("chunk"),
        turn_id(role, text).alias("id"), F.octet_length(text).cast("long").alias("size"), role.alias("role"), text.alias("text"),
    )
    # Texts only order turns of one number.
    inside = Window.partitionBy("conv", "chunk").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    local = rows.withColumn("at", F.row_number().over(inside)).drop("role", "text", "turn")
    ahead = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy("conv", "chunk").agg(F.count("*").alias("n"))
    chunks = chunks.select("conv", "chunk", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("n0"))
    return local.join(chunks, ["conv", "chunk"]).select("conv", (F.col("at") + F.col("n0")).cast("long").alias("pos"), "id", "size")


def turn_id(role: Column, text: Column) -> Column:
    """Fixed-width id of a turn: the role's length keeps role and text apart."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, WIDTH)


def rebuilt(turns: DataFrame) -> DataFrame:
    """Turns (conv, part, pos, id, size) of conversations that begin with the first h turns of conversation c - c % 5 in place of their own h.

    h is crc32(c) % 9. Every conversation is listed: one left without turns has a row with a null id.
    """
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    own = turns.where(F.col("pos") > heads).select("conv", F.lit(1).alias("part"), "pos", "id", "size")
    convs = turns.where("pos = 1").select("conv", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), heads.alias("heads"))
    # At most eight turns for each of five conversations.
    first = turns.where(F.col("pos") < HEADS).select(F.col("conv").alias("base"), "pos", "id", "size")
    lent = convs.join(first, "base").where(F.col("pos") <= F.col("heads")).select("conv", F.lit(0).alias("part"), "pos", "id", "size")
    listed = convs.select("conv", F.lit(2).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"), F.lit(None).cast("long").alias("size"))
    return own.unionAll(lent).unionAll(listed)


def keys(rows: DataFrame) -> DataFrame:
    """conv, key (its turns' ids) and sizes of every conversation of ``rows`` (conv, part, pos, id, size)."""
    held = F.sort_array(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("part", "pos", "id", "size")))).alias("t")
    by_conv = rows.groupBy("conv").agg(held)
    # Joined as hex digits: arrays of binaries have no concatenation of their own.
    key = F.unhex(F.array_join(F.transform("t", lambda t: F.hex(t["id"])), ""))
    return by_conv.select("conv", key.alias("key"), F.transform("t", lambda t: t["size"]).alias("sizes"))


def _bounds(ranges: DataFrame) -> DataFrame:
    """How many turns a range's first key shares with the key before it and its last key with the key behind (-1: none). One row per range."""
    ends = ranges.groupBy("range").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    by = Window.orderBy("lo")

    def shared(a: pa.Array, b: pa.Array) -> list[int]:
        return [-1 if x is None or y is None else _common(x, y, 0) // WIDTH for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"range": pa.int32(), "shared_before": pa.int64(), "shared_after": pa.int64()}
        for b in batches:
            yield batch({"range": b.column(0), "shared_before": shared(b.column(1), b.column(2)), "shared_after": shared(b.column(3), b.column(4))}, kinds)

    pairs = ends.select("range", "lo", F.lag("hi").over(by).alias("before"), "hi", F.lead("lo").over(by).alias("after"))
    return pairs.mapInArrow(run, "range int, shared_before long, shared_after long")


def prefix_nodes(members: DataFrame) -> DataFrame:
    """Trie nodes of conversations (conv, key, sizes): node (digest of its beginning), depth, conv_id,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens."""
    n = partition_count(members.sparkSession)
    distinct = members.groupBy("key").agg(F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv").alias("least"))
    ranges = cut(distinct.repartitionByRange(n, "key").withColumn("range", F.spark_partition_id()), "trie-ranges")
    whole = ranges.join(_bounds(ranges), "range")  # one narrow row per range
    parts = cut(whole.groupBy("range").applyInArrow(_range_nodes, NODE_DDL), "trie-nodes")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    joined = parts.where("cut").groupBy("node", "parent", "depth").agg(F.min("conv_id").alias("conv_id"), *sums)
    # Nodes at a bound are as many as ranges times the turns that neighbours share; Spark broadcasts them if they are small.
    final = ["node", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    parents = joined.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    split = joined.join(parents, "parent", "left").select(final)
    inner = parts.where("not cut")
    below = inner.where("parent_cut").drop("parent_conv_id").join(parents, "parent", "left").select(final)
    return split.unionAll(below).unionAll(inner.where("not parent_cut").select(final))


def ends(members: DataFrame) -> DataFrame:
    """node and ends_sha256 of every key: digest of its conversations' ids in rising order, comma-joined.

    The digest of a key's ids needs them one after another; they are streamed, a batch at a time.
    """
    n = partition_count(members.sparkSession)
    rows = members.select(F.unhex(F.sha2("key", 256)).alias("node"), "conv").repartition(n, "node").sortWithinPartitions("node", "conv")
    kinds = {"node": pa.binary(), "ends_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            out = []
            for key, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if key == node:
                    state.update(b",%d" % conv)
                    continue
                if node is not None:
                    out.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256(b"%d" % conv)
            yield batch(dict(zip(kinds, zip(*out) if out else [[], []], strict=True)), kinds)
        if node is not None:
            yield batch({"node": [node], "ends_sha256": [state.hexdigest()]}, kinds)

    return rows.mapInArrow(run, "node binary, ends_sha256 string")


def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    members = cut(keys(rebuilt(turn_order(table(spark, sf_dir, "conversations")))), "trie-keys")
    found = prefix_nodes(members).join(ends(members), "node", "left")
    digest = F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest)


# CRC-32 of the id's digits, bit by bit: 3988292384 is the reversed polynomial 0xEDB88320.
_CRC = (
    "xor(list_reduce(list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT)), lambda a, b: "
    "list_reduce([CAST(0 AS BIGINT) FOR z IN range(8)], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), 4294967295), 4294967295)"
)

#: The same in DuckDB: a node is a list of turns, and a subtree all nodes that begin with it.
ORACLE_SQL = f"""
WITH turns AS (SELECT conv_id AS c, {{'r': coalesce(role, ''), 't': coalesce("text", '')}} AS u,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
whole AS (SELECT c, CAST(c AS VARCHAR) AS s, list(u ORDER BY pos) AS own FROM turns GROUP BY c),
heads AS (SELECT c, own, {_CRC} % {HEADS} AS h FROM whole),
convs AS MATERIALIZED (SELECT a.c, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) AS k FROM heads a LEFT JOIN whole b ON b.c = a.c - a.c % {FAMILY}),
prefixes AS (SELECT c, len(k) AS n, d, k[1:d] AS p FROM (SELECT c, k, unnest(range(0, len(k) + 1)) AS d FROM convs)),
nodes AS MATERIALIZED (SELECT p, d AS depth, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256,
  CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(any_value(p)[d].t) END AS own_saved FROM prefixes GROUP BY p, d),
children AS (SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS MATERIALIZED (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.p = c.p AND n.depth = c.depth),
up AS (SELECT p[1:a] AS p, a AS depth, sum(own_saved) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM full_nodes) GROUP BY ALL)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, n.n_children, u.leaves AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN up u ON n.p = u.p AND n.depth = u.depth LEFT JOIN nodes q ON n.depth > 0 AND q.depth = n.depth - 1 AND q.p = n.p[1:n.depth - 1]"""
