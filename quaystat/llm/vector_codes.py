"""Product codes of vectors, with codebooks learnt by ball k-means in exact integers.

Components become integers, vectors are cut into equal consecutive parts, and each
part position has a codebook. A round assigns every part to its nearest entry and
moves each entry to the floor of its parts' mean.

Only the first assignment looks at every entry. Later each entry and its parts form a
ball. With D the squared distance of two entries and d that of a part to its own entry,
another entry can be as near only if D <= 4 d. So the ball's radius (its largest d)
names the neighbour entries; a part with 4 d below the nearest neighbour's D lies in
the stable core and isn't looked at; the others fall into rings between the neighbours'
D, and a ring's parts are compared with the neighbours up to there and no further. All
of that is integer arithmetic, so the result is that of comparing with every entry.

A round reads the vectors with their last codes and writes them with the new ones to
the shared folder; sums are added up within tasks, then over them. What reaches the
driver is as large as the codebooks, whatever the number of vectors.

Defined cases: rows whose vector is null, is empty or holds a null or non-finite component are
dropped, as are those of another length than most have (ties: the longer); the first
entries are the parts of the least ids (null ids last, then by components), fewer if there are
fewer rows; repeated rows count each; an empty table gives no row; a component so large that distances could
pass 64 bits, or a length that the parts don't divide, is a ValueError; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystat.llm.common import batch, delete, join_groups, table, written

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BATCH = 20_000
STATE = "vec_id long, label int, q array<long>, code binary, error long"
_KINDS = {"vec_id": pa.int64(), "label": pa.int32(), "q": pa.list_(pa.int64()), "code": pa.binary(), "error": pa.int64()}


@dataclass
class Codes:
    """What ``compress`` learnt: vec_id, label, code (one byte a part) and error of each vector, and the codebooks."""

    rows: DataFrame
    books: list[np.ndarray] = field(default_factory=list)

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and position."""
        return hashlib.sha256(",".join(str(x) for book in self.books for x in book.ravel().tolist()).encode()).hexdigest()


def nearest(q: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row and its squared distance, by comparing with every entry."""
    best, least = np.zeros(len(q), np.int64), ((q - book[0]) ** 2).sum(axis=1)
    for j in range(1, len(book)):
        d = ((q - book[j]) ** 2).sum(axis=1)
        less = d < least
        best[less], least[less] = j, d[less]
    return best, least


def ball_nearest(q: np.ndarray, own: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The same from the entries that rows had before; also the number of distances computed."""
    gap = ((book[:, None] - book[None]) ** 2).sum(axis=2)
    d = ((q - book[own]) ** 2).sum(axis=1)
    best, least, work = own.copy(), d.copy(), len(q)
    by_ball = np.argsort(own, kind="stable")
    for e, rows in zip(*_balls(own[by_ball], by_ball), strict=True):
        reach = d[rows]
        radius = reach.max()
        order = np.argsort(gap[e], kind="stable")
        for j in order[order != e].tolist():
            bound = -(-gap[e, j] // 4)  # D <= 4 d, without leaving 64 bits
            if bound > radius:
                break
            keep = reach >= bound
            rows, reach = rows[keep], reach[keep]
            dj = ((q[rows] - book[j]) ** 2).sum(axis=1)
            work += len(rows)
            better = (dj < least[rows]) | ((dj == least[rows]) & (j < best[rows]))
            at = rows[better]
            best[at], least[at] = j, dj[better]
    return best, least, work


def _balls(owners: np.ndarray, rows: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(owners):
        return [], []
    starts = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]]))
    return owners[starts].tolist(), np.split(rows, starts[1:])


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """Rows x parts x components."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), parts, -1)


def _assign(books: list[np.ndarray], first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                part = b.slice(at, BATCH)
                q = _matrix(part.column("q"), len(books))
                codes, error = np.zeros((len(q), len(books)), np.uint8), np.zeros(len(q), np.int64)
                old = None if first else np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(codes.shape)
                for p, book in enumerate(books):
                    found = nearest(q[:, p], book) if first else ball_nearest(q[:, p], old[:, p].astype(np.int64), book)
                    codes[:, p] = found[0]
                    error += found[1]
                yield batch({"vec_id": part.column("vec_id"), "label": part.column("label"), "q": part.column("q"), "code": [c.tobytes() for c in codes], "error": error}, _KINDS)

    return run


def _sums(parts: int, entries: int):
    kinds = {"part": pa.int32(), "entry": pa.int32(), "place": pa.int32(), "total": pa.int64(), "n": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = n = None
        for b in batches:
            if not b.num_rows:
                continue
            q = _matrix(b.column("q"), parts)
            codes = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(len(q), parts)
            if total is None:
                total, n = np.zeros((parts, entries, q.shape[2]), np.int64), np.zeros((parts, entries), np.int64)
            for p in range(parts):
                of = (codes[:, p] == np.arange(entries)[:, None]).astype(np.int64)
                total[p] += of @ q[:, p]
                n[p] += of.sum(axis=1)
        if total is not None:
            part, entry, place = (x.ravel() for x in np.indices(total.shape))
            yield batch({"part": part, "entry": entry, "place": place, "total": total.ravel(), "n": np.repeat(n.ravel(), total.shape[2])}, kinds)

    return run


def _moved(state: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks whose entries are the floored means of their parts; unused entries stay."""
    rows = state.select("q", "code").mapInArrow(_sums(len(books), len(books[0])), "part int, entry int, place int, total long, n long")
    rows = rows.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).where("n > 0")
    out = [b.copy() for b in books]
    for r in rows.collect():  # as many as the codebooks have components
        out[r["part"]][r["entry"], r["place"]] = r["total"] // r["n"]
    return out


def kept_vectors(vectors: DataFrame, parts: int, scale: int) -> DataFrame:
    """vec_id, label and integer components of the rows that count, null where there is no valid length."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(finite)
    good = good.select(F.col("vec_id").cast("long"), F.col("label").cast("int").alias("label"), F.transform("embedding", lambda x: x.cast("double") * scale).alias("x"))
    shape = good.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("x", lambda x: F.abs(x)))).alias("most"))
    top = shape.orderBy(F.desc("n"), F.desc("size")).first()
    if top is not None and top["size"] % parts:
        raise ValueError(f"{parts} equal parts don't fit vectors of {top['size']} components")
    if top is not None and (2 * top["most"] + 2) ** 2 * (top["size"] // parts) >= 2**62:
        raise ValueError(f"components up to {top['most'] / scale} are too large for exact distances")
    return good.where(F.size("x") == (top["size"] if top is not None else 0)).select("vec_id", "label", F.transform("x", lambda x: F.floor(x)).alias("q"))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Codes of ``vectors`` (vec_id, embedding, label) under codebooks learnt from all of them."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    kept = kept_vectors(vectors, parts, scale)
    firsts = kept.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    if not firsts:
        return Codes(vectors.sparkSession.createDataFrame([], STATE).drop("q"))
    seeds = np.array([r["q"] for r in firsts], np.int64).reshape(len(firsts), parts, -1)
    books = [seeds[:, p].copy() for p in range(parts)]
    state, path = written(kept.mapInArrow(_assign(books, first=True), STATE), "vector-codes")
    for _ in range(rounds):
        books = _moved(state, books)
        # The last round's parts move entries once more; then all are assigned again.
        before = path
        state, path = written(state.mapInArrow(_assign(books, first=False), STATE), "vector-codes")
        delete(state.sparkSession, before)
    return Codes(state.drop("q"), books)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every valid vector, the error summed by label, and a digest of the codebooks."""
    found = compress(table(spark, sf_dir, "embeddings"))
    by_label = found.rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    rows = join_groups(found.rows, by_label, ["label"])
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))


def _oracle() -> str:
    """The same in DuckDB, comparing with every entry in every round."""
    d = "list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        "good AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"parts AS MATERIALIZED (SELECT vec_id, label, p, q[p * len(q) // {PARTS} + 1 : (p + 1) * len(q) // {PARTS}] AS v FROM good, range({PARTS}) t(p))",
        f"b0 AS MATERIALIZED (SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, v FROM parts WHERE vec_id IN (SELECT vec_id FROM good ORDER BY vec_id LIMIT {ENTRIES}))",
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT vec_id, label, p, any_value(v) AS v, min({{'d': d, 'e': e}}) AS hit FROM "
            f"(SELECT p.vec_id, p.label, p.p, p.v, b.e, {d} AS d FROM parts p JOIN b{r} b ON p.p = b.p) GROUP BY vec_id, label, p)"
        )
        if r < ROUNDS:
            steps.append(
                f"m{r} AS MATERIALIZED (SELECT p, e, list(c ORDER BY i) AS v FROM (SELECT p, hit.e AS e, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS c "
                f"FROM a{r}, (SELECT unnest(range(1, (SELECT max(len(v)) FROM parts) + 1)) AS i) GROUP BY ALL) GROUP BY p, e)"
            )
            steps.append(f"b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN m{r} m ON b.p = m.p AND b.e = m.e)")
    return f"""WITH {', '.join(steps)},
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS}),
codes AS (SELECT vec_id, label, string_agg(lower(printf('%02x', hit.e)), '' ORDER BY p) AS code, CAST(sum(hit.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM codes, books"""


ORACLE_SQL = _oracle()
