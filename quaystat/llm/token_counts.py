"""Token counts under a unigram vocabulary, by dynamic programming along a trie.

Each task inserts the distinct pre-tokens it meets into a trie and walks it
depth first: a node's best forward score and its number of tokens follow from
the nodes above it, so a prefix that many pre-tokens share is scored once. A
pre-token's count is stored at its terminal; a text's count is the sum over
its pre-tokens. The work needs no shuffle and grows with the distinct
pre-tokens of a task, which are kept up to a bound and then emptied.

A pre-token is a blank-separated word behind the word mark U+2581. The score of
a segmentation is the sum of its pieces' scores; a character no piece
covers costs the least score less 10 and counts as its UTF-8 bytes. Equal
scores go to the segmentation whose last piece is longest.

Defined cases: null, empty and white text have 0 pre-tokens and 0 tokens;
repeated rows are counted each; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystat.llm.common import batch, table

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Terminals kept per worker process before they are emptied, and the longest pre-token kept.
KEPT = 1_000_000
KEPT_CHARS = 64


class UnigramTrie:
    """Terminal token counts of pre-tokens under scored pieces."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        # Lengths of pieces by their last character: the only cuts worth trying at a node.
        ends: dict[str, set[int]] = {}
        for piece in scores:
            ends.setdefault(piece[-1], set()).add(len(piece))
        self.ends = {c: sorted(n, reverse=True) for c, n in ends.items()}
        self.counts: dict[str, int] = {}

    def insert(self, pretokens: set[str]) -> None:
        """Score new pre-tokens; sorted order is a depth-first walk of their trie, the lists its open path."""
        best, tokens, path = [0.0], [0], ""
        scores, counts, ends = self.scores, self.counts, self.ends
        for word in sorted(pretokens):
            shared = 0
            for a, b in zip(word, path):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :]
            for stop in range(shared + 1, len(word) + 1):
                last = word[stop - 1]
                top, n = None, 0
                for size in ends.get(last, ()):
                    start = stop - size
                    if start >= 0:
                        score = scores.get(word[start:stop])
                        if score is not None and (top is None or best[start] + score > top):
                            top, n = best[start] + score, tokens[start] + 1
                if last not in scores:  # one unknown character
                    score = best[stop - 1] + self.unknown
                    if top is None or score > top:
                        top, n = score, tokens[stop - 1] + len(last.encode())
                best.append(top)
                tokens.append(n)
            path = word
            counts[word] = tokens[len(word)]

    def totals(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """Pre-tokens and tokens of each whole text."""
        words = [(t or "").split() for t in texts]
        new = set(chain.from_iterable(words)).difference(self.counts)
        if len(self.counts) + len(new) > KEPT:
            self.counts.clear()
            new = set(chain.from_iterable(words))
        self.insert_words(new)
        at = self.counts.__getitem__
        out = [(len(w), sum(map(at, w))) for w in words]
        for word in new:
            if len(word) > KEPT_CHARS:
                del self.counts[word]
        return out

    def insert_words(self, words: set[str]) -> None:
        """Insert words behind the word mark; their terminals are kept by the bare word."""
        marked = {MARK + w for w in words}
        self.insert(marked)
        for word in marked:
            self.counts[word[1:]] = self.counts.pop(word)


def piece_scores(model: str) -> dict[str, float]:
    """Pieces of a sentencepiece vocabulary that are ordinary text, with their stored scores scaled to log-likelihood size."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    # Stored scores of a merge vocabulary fall by rank; a Zipf law over the rank makes them log-likelihoods.
    import math

    ranked = sorted(ids, key=lambda i: -sp.get_score(i))
    return {sp.id_to_piece(i): -math.log(k + 10.0) for k, i in enumerate(ranked)}


_TRIES: dict[str, UnigramTrie] = {}


def trie(model: str) -> UnigramTrie:
    """The process's trie for the vocabulary at ``model``."""
    if model not in _TRIES:
        _TRIES[model] = UnigramTrie(piece_scores(model))
    return _TRIES[model]


def token_counts(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", rows: int = 1000) -> DataFrame:
    """(key, n_pretokens, n_tokens) of every whole text; ``rows`` texts share one insertion."""
    kinds = {"key": pa.int64(), "n_pretokens": pa.int64(), "n_tokens": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trie(model)
        for b in batches:
            keys, texts = b.column(0), b.column(1)
            got = [x for at in range(0, len(texts), rows) for x in known.totals(texts.slice(at, rows).to_pylist())]
            yield batch({"key": keys, "n_pretokens": [x[0] for x in got], "n_tokens": [x[1] for x in got]}, kinds)

    picked = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return picked.mapInArrow(run, "key long, n_pretokens long, n_tokens long").withColumnRenamed("key", key)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and tokens of every document."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
