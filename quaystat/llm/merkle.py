"""Document fingerprints: Merkle trees over paragraphs and sections, in Spark's own functions.

A paragraph is a line; its node is the SHA-256 of its text. A section ends with each
paragraph whose node begins with one of ``SECTION_ENDS``, so an insertion moves no
later section's bounds; its node is the digest of its paragraphs' nodes, and
the root that of the sections'. Equal texts have equal roots; unequal roots are
told apart branch by branch (``changes``). Below a paragraph are its clauses (text up to
a mark of punctuation and a blank), long ones cut further by their own bytes, kept as
64-bit hashes with their length. A paragraph's node is the digest of its whole text, not
of these hashes; they follow from that text alone. The likeness of two trees is the share
of text in leaves that both have, each as often as it occurs.

Defined cases: null text is empty, one empty paragraph with one empty clause; a
text without line breaks is one paragraph; repeated rows have equal trees; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaystat.llm.common import table

#: First hex digits that end a section: one paragraph in four, on average.
SECTION_ENDS = "048c"
CLAUSE_END = "(?<=[.,;:!?|*%&$#]) "
#: Bytes of a longer clause's leaves, at most; such a clause is cut behind two bytes of the classes that follow.
LEAF_BYTES = 64
_CLASSES = ["".join(f"\\x{b:02x}" for b in range(256) if b % 4 == k) for k in (1, 2)]
LEAF = f"(?s).{{16,{LEAF_BYTES}}}?(?<=[{_CLASSES[0]}][{_CLASSES[1]}])|.{{1,{LEAF_BYTES}}}"
#: Rows of one bucket of consecutive ids, on average.
BUCKET_ROWS = 2000


def paragraph_nodes(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), lambda p: F.sha2(p, 256))


def section_nodes(paragraphs: Column) -> Column:
    """Digests of the runs of paragraph nodes up to each that ends a section."""
    # Joined nodes with a bar behind each end: the bars cut the sections.
    marked = F.concat_ws("", F.transform(paragraphs, lambda p: F.when(F.substring(p, 1, 1).isin(*SECTION_ENDS), F.concat(p, F.lit("|"))).otherwise(p)))
    return F.transform(F.split(F.regexp_replace(marked, "\\|$", ""), "\\|", -1), lambda s: F.sha2(s, 256))


def root_node(sections: Column) -> Column:
    return F.sha2(F.concat_ws("", sections), 256)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once for a row."""
    return F.transform(F.array(value), body)[0]


def clauses(text: Column) -> Column:
    """Leaves of the text's paragraphs in order, with repeats: hash and weight (bytes and the sign behind them)."""

    def leaves(clause: Column) -> Column:
        # One letter for each byte, so that the cuts need no white space and know every script.
        pieces = F.regexp_extract_all(F.decode(clause.cast("binary"), "ISO-8859-1"), F.lit(LEAF), F.lit(0))
        cut = F.transform(pieces, lambda p: F.struct(F.xxhash64(F.encode(p, "ISO-8859-1")).alias("hash"), (F.length(p) + 1).cast("long").alias("weight")))
        whole = F.array(F.struct(F.xxhash64(clause).alias("hash"), (F.octet_length(clause) + 1).cast("long").alias("weight")))
        return F.when(F.octet_length(clause) > LEAF_BYTES, cut).otherwise(whole)

    # A line break ends a clause as well: no leaf reaches into another paragraph.
    return F.flatten(F.transform(F.split(text, f"\n|{CLAUSE_END}", -1), leaves))


def likeness(a: Column, b: Column) -> Column:
    """Share of the weight of leaves in common, 0 to 1, each counted as often as it occurs."""
    signed = F.sort_array(F.concat(a, F.transform(b, lambda x: F.struct(x["hash"].alias("hash"), (-x["weight"]).alias("weight")))))

    def state(hash: Column, rest: Column, apart: Column, total: Column) -> Column:
        return F.struct(hash.alias("hash"), rest.alias("rest"), apart.alias("apart"), total.alias("total"))

    def add(s: Column, x: Column) -> Column:
        same = s["hash"] == x["hash"]
        rest = F.when(same, s["rest"]).otherwise(0) + x["weight"]
        return state(x["hash"], rest, s["apart"] + F.when(same, 0).otherwise(F.abs(s["rest"])), s["total"] + F.abs(x["weight"]))

    zero = F.lit(0).cast("long")
    return F.aggregate(signed, state(zero, zero, zero, zero), add, lambda s: 1.0 - (s["apart"] + F.abs(s["rest"])) / s["total"])


def with_tree(df: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """``df`` plus the tree of column ``text`` (null: empty): paragraphs, sections, root and clauses."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return (
        df.withColumn(f"{prefix}paragraphs", paragraph_nodes(whole))
        .withColumn(f"{prefix}sections", section_nodes(F.col(f"{prefix}paragraphs")))
        .withColumn(f"{prefix}root", root_node(F.col(f"{prefix}sections")))
        .withColumn(f"{prefix}clauses", clauses(whole))
    )


def _alike(a: Column, b: Column) -> Column:
    """How many nodes at the front are the same."""
    unlike = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(unlike == 0, F.size(a)).otherwise(unlike.cast("int") - 1)


def _pairs(a: Column, b: Column) -> Column:
    """Places of like nodes, the first in ``a`` with the first in ``b`` and so on; null where the other has no more."""

    def placed(nodes: Column, name: str) -> Column:
        return F.transform(nodes, lambda n, i: F.struct(n.alias("node"), F.lit(name).alias("side"), i.alias("place")))

    # As in section_nodes, bars cut the sorted places into those of one node each.
    def joined(s: Column) -> Column:
        sign = lambda x, i: F.when(i == 0, "").when(x["node"] == F.get(s, i - 1)["node"], ",").otherwise("|")
        return F.concat_ws("", F.transform(s, lambda x, i: F.concat(sign(x, i), x["side"], x["place"].cast("string"))))

    runs = F.split(bound(F.sort_array(F.concat(placed(a, "a"), placed(b, "b"))), joined), "[|]", -1)

    def side(run: Column, name: str) -> Column:
        return F.transform(F.filter(run, lambda x: x.startswith(name)), lambda x: F.substring(x, 2, 12).cast("int"))

    return F.flatten(F.transform(runs, lambda r: bound(F.split(r, ","), lambda x: F.zip_with(side(x, "a"), side(x, "b"), lambda i, j: F.struct(i.alias("a"), j.alias("b"))))))


def _moved(kept: Column) -> Column:
    """Of pairs in order of ``a``, those that stand behind another pair in ``b`` than in ``a``."""
    by_b = F.transform(F.sort_array(F.transform(kept, lambda p, r: F.struct(p["b"].alias("b"), r.alias("r")))), lambda x: x["r"])
    breaks = bound(by_b, lambda o: F.filter(F.transform(o, lambda r, j: F.when(r != F.coalesce(F.get(o, j - 1), F.lit(-1)) + 1, r)), lambda r: r.isNotNull()))
    return F.transform(breaks, lambda r: F.get(kept, r))


def changes(a: Column, b: Column) -> Column:
    """Struct of the places (from 0) in ``a`` and in ``b`` of the nodes that an edit touched; both are empty only for equal trees.

    Like nodes at both ends are set aside; of the rest, like nodes are paired in
    order. Touched are those without partner, as repeats taken out or put
    in are, and paired ones that follow another paired node than on the other
    side: a moved run gives the place of its first node and that of the one that was behind it.
    """

    def middle(t: Column) -> Column:
        def rest(n: Column, name: str) -> Column:
            return F.slice(t[name], n + 1, F.size(t[name]) - n).alias(name)

        return bound(_alike(t["a"], t["b"]), lambda n: F.struct(n.alias("at"), rest(n, "a"), rest(n, "b")))

    def trimmed(t: Column) -> Column:
        def rest(n: Column, name: str) -> Column:
            return F.slice(t[name], F.lit(1), F.size(t[name]) - n).alias(name)

        return bound(_alike(F.reverse(t["a"]), F.reverse(t["b"])), lambda n: F.struct(t["at"].alias("at"), rest(n, "a"), rest(n, "b")))

    def places(t: Column) -> Column:
        def found(p: Column) -> Column:
            alone = F.filter(p, lambda x: x["a"].isNull() | x["b"].isNull())
            kept = F.sort_array(F.filter(p, lambda x: x["a"].isNotNull() & x["b"].isNotNull()))
            return F.concat(alone, bound(kept, _moved))

        return touched(t["at"], bound(_pairs(t["a"], t["b"]), found))

    def touched(at: Column, found: Column) -> Column:
        def side(p: Column, name: str) -> Column:
            return F.sort_array(F.filter(F.transform(p, lambda x: x[name] + at), lambda i: i.isNotNull())).alias(name)

        return bound(found, lambda p: F.struct(side(p, "a"), side(p, "b")))

    return bound(bound(bound(F.struct(a.alias("a"), b.alias("b")), middle), trimmed), places)


def differing(a: Column, b: Column) -> Column:
    """Places (from 0) in ``a`` of ``changes``."""
    return changes(a, b)["a"]


def paragraph_places(paragraphs: Column) -> Column:
    """For each section the places of its paragraphs."""
    marked = F.concat_ws("", F.transform(paragraphs, lambda p, i: F.concat(i.cast("string"), F.when(F.substring(p, 1, 1).isin(*SECTION_ENDS), "|").otherwise(","))))
    return F.transform(F.split(F.regexp_replace(marked, "[|,]$", ""), "[|]", -1), lambda s: F.transform(F.split(s, ","), lambda i: i.cast("int")))


def paragraph_changes(changed: Column, a: Column, b: Column) -> Column:
    """``changes`` of the paragraphs ``a`` and ``b``, looked for in the sections that ``changed`` names only."""

    def below(t: Column, s: str) -> Column:
        return bound(paragraph_places(t[s]), lambda own: F.flatten(F.transform(t["changed"][s], lambda k: F.get(own, k))))

    def nodes(t: Column, u: Column, s: str) -> Column:
        return F.transform(u[s], lambda i: F.get(t[s], i))

    def places(t: Column, u: Column) -> Column:
        def whole(c: Column, s: str) -> Column:
            return F.transform(c[s], lambda i: F.get(u[s], i)).alias(s)

        return bound(changes(nodes(t, u, "a"), nodes(t, u, "b")), lambda c: F.struct(whole(c, "a"), whole(c, "b")))

    def descend(t: Column) -> Column:
        return bound(F.struct(below(t, "a").alias("a"), below(t, "b").alias("b")), lambda u: places(t, u))

    return bound(F.struct(changed.alias("changed"), a.alias("a"), b.alias("b")), descend)


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` (key, text) plus next_text: the text of the next row by key (null first, ties by text), the first's after the last.

    Rows go to buckets by equal stretches of the key's range, one shuffle of the
    texts; each bucket also gets the first row of the bucket behind it, so the
    neighbour is found within a bucket. Keys are taken to be spread over
    their range, as running ids are; a bucket is sorted on disk if need be.
    """
    size = df.agg(F.min(key), F.max(key), F.count("*")).first()
    low, high, rows = size
    buckets = max(1, -(-rows // BUCKET_ROWS))
    if low is None:
        low = high = 0
    stretch = (F.col(key) - F.lit(low)) / F.lit(float(high) - float(low) + 1.0)
    place = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.least(F.floor(stretch * buckets), F.lit(buckets - 1))).cast("long")
    placed = df.select(key, text, place.alias("bucket"))
    # One narrow row for each bucket in use: its least key and the bucket before it, the last one's before the first.
    least = placed.groupBy("bucket").agg(F.min(key).alias("least"))
    line = Window.orderBy("bucket")
    ends = least.select("bucket", "least", F.lag("bucket").over(line).alias("before"), F.max("bucket").over(Window.partitionBy()).alias("end"))
    ends = ends.select("bucket", "least", F.coalesce("before", "end").alias("target"))
    heads = placed.join(ends, (placed["bucket"] == ends["bucket"]) & placed[key].eqNullSafe(ends["least"])).select(placed[key], placed[text], ends["target"])
    heads = heads.groupBy("target").agg(F.min(F.struct(text)).alias("head"), F.first(key).alias(key)).select(key, F.col(f"head.{text}").alias(text), F.col("target").alias("bucket"), F.lit(1).alias("guest"))
    both = placed.withColumn("guest", F.lit(0)).unionByName(heads)
    by = Window.partitionBy("bucket").orderBy("guest", F.col(key).asc_nulls_first(), text)
    return both.withColumn("next_text", F.lead(text).over(by)).where("guest = 0").select(key, text, "next_text")


def op2_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, with their likeness."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", "text").withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2)
    edited = F.concat(F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 2) as int))"), F.expr("substring(next_text, 1, cast(floor(n_chars / 2) as int))"))
    rows = rows.withColumn("edited", F.when(half > 0, edited).otherwise(F.col("text")))
    rows = with_tree(with_tree(rows, "text"), "edited", "edited_").withColumn("next_clauses", clauses(F.col("next_text")))
    rows = rows.withColumn("changed", changes(F.col("sections"), F.col("edited_sections")))
    rows = rows.withColumn("below", paragraph_changes(F.col("changed"), F.col("paragraphs"), F.col("edited_paragraphs")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.col("root").alias("fingerprint"), F.col("edited_root").alias("edited_fingerprint"),
        likeness(F.col("clauses"), F.col("edited_clauses")).alias("near_edited"), likeness(F.col("clauses"), F.col("next_clauses")).alias("near_next"),
        F.size("paragraphs").alias("n_paragraphs"), F.size("sections").alias("n_sections"), *((F.size(f"{c}.a") + F.size(f"{c}.b")).alias(name) for c, name in (("changed", "sections_changed"), ("below", "paragraphs_changed"))),
    )
