"""Exact token ids of whole texts, encoded word by word with memory of words seen.

The vocabulary drops white space and never lets a token cross it, so the ids
of a text are the ids of its words joined. Each worker process keeps the ids
of words it has met (bounded, then emptied) as little-endian bytes: a text
then costs one dictionary lookup per word and one join. The words of a group
of texts that are new are encoded together.
"""

from __future__ import annotations

import ctypes
import gc
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
from tokenizers import Tokenizer

#: Words kept per worker process before the memory is emptied.
WORDS_KEPT = 300_000
#: Longer words are encoded each time.
WORD_CHARS_KEPT = 48
#: Closing marks that form one token run of their own behind a word of letters.
MARKS = ".,;:!?%$&*#|"
END_ID = 1
#: Characters of text encoded as one group.
GROUP_CHARS = 1_000_000

_END = np.array([END_ID], "<u4").tobytes()


def _byte_letters() -> dict[int, str]:
    """Byte -> printable letter, the public byte-level BPE rule: printable Latin-1 stays, the rest moves up from 256."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in keep}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(keep))
    return table


#: A stop or comma behind another mark; it begins with the stop, for which the search is fast.
_RUN_CUT = re.compile(r"[.,](?<=[^\w\s].|_.)")


def split_words(text: str, special: tuple[str, ...] = ()) -> list[str]:
    """The text's words in lower case, closing commas and stops set apart.

    A stop or comma behind a letter, digit or blank starts a run of marks of
    its own, so a blank before it changes no token; texts with one inside a
    run, and the few with rules of case or composition, keep words whole. So do
    texts where this would make or break one of the ``special`` strings, which
    the vocabulary looks for in the text as it stands.
    """
    if _RUN_CUT.search(text) is None and (text.isascii() or _simple(text)):
        made = text.lower().replace(",", " ,").replace(".", " .")
        if all(made.count(s) == text.count(s) for s in special):
            text = made
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def _simple(text: str) -> bool:
    return "İ" not in text and "Σ" not in text and unicodedata.is_normalized("NFC", text)


def plain_core(word: str) -> str | None:
    """Lower-cased word of letters; None where case or composition rules need the full tokenizer."""
    if not word.isalpha() or len(word) > WORD_CHARS_KEPT:
        return None
    if word.isascii():
        return word.lower()
    if "İ" in word or "Σ" in word or not unicodedata.is_normalized("NFC", word):
        return None
    lower = word.lower()
    return lower if lower.isalpha() else None


class WordMemory:
    """Ids of words as little-endian uint32 bytes."""

    def __init__(self, path: str, kept: int | None = None):
        self.kept = kept
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"]["end_of_word_suffix"]
        ends = np.zeros(max(spec["model"]["vocab"].values()) + 1, bool)
        ends[[i for t, i in spec["model"]["vocab"].items() if t.endswith(suffix)]] = True
        self.ends = ends
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        # The same merges over words that are already byte letters, split at blanks.
        spec |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.by_word = Tokenizer.from_str(json.dumps(spec))
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {"": b""}

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn_cores(self, cores: list[str]) -> None:
        if not cores:
            return
        letters = [c if c.isascii() else c.encode().decode("latin-1").translate(self.letters) for c in cores]
        ids = np.array(self.by_word.encode(" ".join(letters), add_special_tokens=False).ids, "<u4")
        stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        if len(stops) != len(cores):  # a vocabulary whose tokens don't mark word ends
            self.words.update((c, self.plain(c)) for c in cores)
            return
        raw = ids.tobytes()
        self.words.update(zip(cores, [raw[a:b] for a, b in zip([0, *stops], stops)], strict=True))

    def learn(self, new: set[str]) -> None:
        """Encode words not met before; those of letters together."""
        words = self.words
        simple = [w for w in new if w.isalpha() and w.isascii() and w.islower() and len(w) <= WORD_CHARS_KEPT]
        self.learn_cores(simple)
        rest, wanted = [], set()
        for word in new.difference(simple):
            bare = word.rstrip(MARKS)
            core = plain_core(bare) if bare else ""
            if core is None:
                words[word] = self.plain(word)
                continue
            marks = word[len(bare) :]
            if marks not in words:
                words[marks] = self.plain(marks)
            if core not in words:
                wanted.add(core)
            if core != word:
                rest.append((word, core, marks))
        self.learn_cores(list(wanted))
        for word, core, marks in rest:
            words[word] = words[core] + words[marks]

    def group(self, texts: list[str]) -> list[bytes]:
        found = [split_words(t, self.special) for t in texts]
        new = set().union(*found).difference(self.words)
        if new:
            if len(self.words) + len(new) > (self.kept or WORDS_KEPT):  # emptied: the group's own words are learnt again
                self.words = {"": b""}
                new = set().union(*found)
            self.learn(new)
        at = self.words.__getitem__
        out = [b"".join(map(at, words)) for words in found]
        for word in new:
            if len(word) > WORD_CHARS_KEPT:
                self.words.pop(word, None)
        return out

    def encode(self, texts: list[str | None], end: bool = True) -> Iterator[bytes]:
        """Ids of each whole text, in order, with the end id if ``end``; null text is empty."""
        start, chars = 0, 0
        for i, text in enumerate(texts):
            chars += len(text or "")
            if chars >= GROUP_CHARS or i + 1 == len(texts):
                for got in self.group([t or "" for t in texts[start : i + 1]]):
                    yield got + _END if end else got
                start, chars = i + 1, 0


_MEMORIES: dict[tuple[str, int | None], WordMemory] = {}


def memory(path: str, kept: int | None = None) -> WordMemory:
    """The process's memory for the vocabulary at ``path``, of ``kept`` words (``WORDS_KEPT``)."""
    if (path, kept) not in _MEMORIES:
        _MEMORIES[path, kept] = WordMemory(path, kept)
    return _MEMORIES[path, kept]


def forget() -> None:
    """Give back the memory of words held by a worker process that goes on to other work."""
    if _MEMORIES:
        _MEMORIES.clear()
        gc.collect()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library: freed memory stays with the process
            pass
