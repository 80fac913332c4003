r"""Chat formatting into budgeted windows of whole turns, with a loss mask.

A turn is written ``### role: text</turn>`` and a line feed. In texts a backslash
goes before every backslash, ``###`` and ``</turn>``, in roles also before a colon,
so the output reads back exactly.

Windows follow from prefix sums of the turns' tokens alone. The sum, counted
behind the system turn, is cut into strides of budget - system - history tokens.
The turns that lie within one stride form a window's span; a turn that lies
across a bound is a span of its own. A window is the system turn, as many whole
turns before the span as fit the history allowance, and the span. Only texts of
assistant turns of the span are under the loss mask: what is repeated from before is
context. A window exceeds the budget only if the system turn and one turn do.

The sums are taken in two steps, within and over runs of ``CHUNK_TURNS`` turn
numbers, so that no task has to hold a long conversation.

Defined cases: null text and role are empty; turns go by number (null first), then role and
text; repeated rows are turns of their own; rows without conversation id form one
conversation without id; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from quaystat.llm.common import batch, cut, partition_count, table
from quaystat.llm.encode import memory

BUDGET = 1024
HISTORY = 256
CHUNK_TURNS = 256
NO_ID = "none"
#: Characters unescaped at once.
PIECE = 1 << 16
_ROLE = re.compile(r"### ((?:[^\\:]++|\\.)*+): ", re.S)
_END = "</turn>\n"
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\|###|</turn>)", r"\\$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(role, r"(\\|###|</turn>|:)", r"\\$1")


def unescape(text: str) -> str:
    """Drop the backslash before each escaped character, a piece of text at a time."""
    out, at = [], 0
    while at < len(text):
        stop = at + PIECE
        while stop < len(text) and text[stop - 1] == "\\":
            stop += 1
        out.append(_ESCAPED.sub(r"\1", text[at:stop]))
        at = stop
    return "".join(out)


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted window; fails on anything else in it.

    A turn ends at the first mark with an even number of backslashes before it: marks in texts have
    one more. Only places are kept while looking, so memory stays a small multiple of the turn.
    """
    out, at = [], 0
    while at < len(text):
        m = _ROLE.match(text, at)
        end = _unescaped(text, _END, m.end()) if m else -1
        if end < 0:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(m[1]), unescape(text[m.end() : end])))
        at = end + len(_END)
    return out


def _unescaped(text: str, mark: str, at: int) -> int:
    """Place of the first ``mark`` from ``at`` on that no backslash escapes, or -1."""
    found = text.find(mark, at)
    while found >= 0:
        before = found
        while before > at and text[before - 1] == "\\":
            before -= 1
        if (found - before) % 2 == 0:
            return found
        found = text.find(mark, found + 1)
    return -1


def _with_tokens(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``rows`` plus tokens, the number of ids of the formatted turn."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = memory(tokenizer)
        at = names.index("turn_text")
        for b in batches:
            n = [max(1, len(x) // 4) for x in words.encode(b.column(at).to_pylist(), end=False)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64())], names=[*names, "tokens"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("tokens", LongType())]))


def turns(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """Formatted turns: conv, pos (from 1), role, turn_text, mask bounds within it, tokens and before (tokens of earlier turns)."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(NO_ID)).alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.concat(F.lit("### "), escape_role(role), F.lit(": ")).alias("head"), escape(text).alias("body"),
    )
    rows = rows.select(
        "conv", "turn", "role", "text", F.coalesce(F.floor(F.col("turn") / CHUNK_TURNS), F.lit(-(2**40))).alias("chunk"),
        F.concat("head", "body", F.lit("</turn>\n")).alias("turn_text"), F.length("head").alias("lo"), (F.length("head") + F.length("body")).alias("hi"),
    )
    rows = _with_tokens(rows, tokenizer)
    inside = Window.partitionBy("conv", "chunk").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("pos", F.row_number().over(inside).cast("long")).withColumn("before", F.sum("tokens").over(upto) - F.col("tokens"))
    ahead = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy("conv", "chunk").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"))
    chunks = chunks.select("conv", "chunk", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("n0"), F.coalesce(F.sum("t").over(ahead), F.lit(0)).alias("t0"))
    both = local.join(chunks, ["conv", "chunk"])
    return both.select("conv", (F.col("pos") + F.col("n0")).alias("pos"), "role", "turn_text", "lo", "hi", "tokens", (F.col("before") + F.col("t0")).alias("before"))


def windows(conversations: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Formatted windows: conv, span (rising), first and last turn, context (repeated turns in front), tokens, text and mask (character ranges)."""
    rows = cut(turns(conversations, tokenizer), "turns")
    system = rows.where((F.col("pos") == 1) & (F.lower("role") == "system")).select("conv", F.col("tokens").alias("system"), F.struct("role", "turn_text", "lo", "hi", "tokens").alias("first"))
    at = rows.join(system.select("conv", "system"), "conv", "left").withColumn("system", F.coalesce("system", F.lit(0)))
    at = at.withColumn("is_system", (F.col("system") > 0) & (F.col("pos") == 1))
    at = at.withColumn("stride", F.greatest(F.lit(budget - history) - F.col("system"), F.lit(1)))
    # Counted behind the system turn, which lies before the first stride and opens the first span.
    at = at.withColumn("before", F.greatest(F.col("before") - F.col("system"), F.lit(0)))
    end = F.col("before") + F.when(F.col("is_system"), F.lit(0)).otherwise(F.col("tokens") - 1)
    first, last = F.floor(F.col("before") / F.col("stride")), F.floor(end / F.col("stride"))
    at = at.withColumn("span", F.when(F.col("is_system"), F.lit(-1)).otherwise(2 * first + (first != last).cast("int")))
    alone = at.where("not is_system")
    spans = alone.groupBy("conv", "span").agg(F.min("before").alias("begin"), F.min("pos").alias("first_turn"), F.first("stride").alias("stride"))
    held = ["role", "turn_text", "lo", "hi", "tokens"]
    own = alone.select("conv", "span", "pos", F.lit(False).alias("context"), *held)
    # A turn is history of the spans that begin behind it within the allowance; these begin in the strides up to there.
    reach = F.explode(F.sequence(F.floor((F.col("before") + F.col("tokens")) / F.col("stride")), F.floor((F.col("before") + F.lit(history)) / F.col("stride")))).alias("block")
    past = alone.where(F.col("tokens") <= history).select("conv", "pos", F.col("before").alias("from"), (F.col("before") + F.col("tokens")).alias("to"), *held, reach)
    starts = spans.select("conv", "span", "begin", F.floor(F.col("begin") / F.col("stride")).alias("block"))
    past = past.join(starts, ["conv", "block"]).where((F.col("begin") >= F.col("to")) & (F.col("begin") - F.col("from") <= history))
    past = past.select("conv", "span", "pos", F.lit(True).alias("context"), *held)
    # The system turn opens every window; in the first it is new, later repeated. Alone in its conversation it is a window by itself.
    opened = system.join(spans, "conv").select("conv", "span", F.lit(1).cast("long").alias("pos"), (F.col("first_turn") > 2).alias("context"), "first.*")
    lonely = system.join(spans, "conv", "left_anti").select("conv", F.lit(0).cast("long").alias("span"), F.lit(1).cast("long").alias("pos"), F.lit(False).alias("context"), "first.*")
    parts = own.unionByName(past).unionByName(opened).unionByName(lonely)
    # One group is one window: at most the budget, or the system turn and one turn.
    held_rows = F.sort_array(F.collect_list(F.struct("pos", "context", "turn_text", "lo", "hi", "tokens", "role"))).alias("t")
    window = parts.groupBy("conv", "span").agg(held_rows)
    trained = lambda t: ~t["context"] & (F.lower(t["role"]) == "assistant")
    ends = F.aggregate("t", F.array(F.lit(0)), lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + F.length(t["turn_text"]))))
    window = window.withColumn("ends", ends)
    mask = F.filter(
        F.transform("t", lambda t, i: F.when(trained(t), F.struct((F.get("ends", i) + t["lo"]).alias("start"), (F.get("ends", i) + t["hi"]).alias("stop")))), lambda m: m.isNotNull()
    )
    fresh = F.filter("t", lambda t: ~t["context"])
    return window.select(
        "conv", "span", F.get(fresh, F.lit(0))["pos"].alias("first_turn"), F.element_at(fresh, -1)["pos"].alias("last_turn"),
        F.size(F.filter("t", lambda t: t["context"])).alias("context"), F.aggregate(F.transform("t", lambda t: t["tokens"]), F.lit(0).cast("long"), lambda a, n: a + n).alias("tokens"),
        F.array_join(F.transform("t", lambda t: t["turn_text"]), "").alias("text"), mask.alias("mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, read from its windows in order: digests of the turns and of the text under the mask.

    A digest of a whole conversation has to see its turns one after another;
    they are streamed through one task, which holds one window at a time.
    """
    kinds = {"conv": pa.string(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def row() -> tuple:
            n, turns_, chars, loss, size = state
            return conv, n, turns_.hexdigest(), chars, loss.hexdigest(), size

        for b in batches:
            out = []
            for at in range(0, b.num_rows, 500):
                for name, context, text, mask in zip(*(c.to_pylist() for c in b.slice(at, 500).columns), strict=True):
                    if name != conv:
                        if conv is not None:
                            out.append(row())
                        conv, state = name, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    for role, said in read_turns(text)[context:]:
                        state[0] += 1
                        state[1].update(f"{role}\n{said}\n".encode())
                    for m in mask:
                        said = unescape(text[m["start"] : m["stop"]])
                        state[2] += len(said)
                        state[3].update(said.encode())
                    state[4] += len(text)
            yield batch(dict(zip(kinds, zip(*out) if out else [[]] * 6, strict=True)), kinds)
        if conv is not None:
            yield batch(dict(zip(kinds, zip(*[row()]), strict=True)), kinds)

    n = partition_count(formatted.sparkSession)
    ordered = formatted.repartition(n, "conv").sortWithinPartitions("conv", "span").select("conv", "context", "text", "mask")
    return ordered.mapInArrow(run, "conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of one that says the template's own marks, read back from the windows."""
    import public_tokenizers

    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    found = read_back(windows(rows.unionByName(extra), public_tokenizers.path("word_bpe_49k.json")))
    conv = F.when(F.col("conv") != NO_ID, F.col("conv").cast("long")).alias("conv_id")
    return found.select(conv, *found.columns[1:])
