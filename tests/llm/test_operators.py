"""The operators against brute force on small tables, odd rows included."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from quaystat.llm import chat, components, decontaminate, encode, merkle, packing, simhash, suffix_dedup, token_counts, token_shards

WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, key string, bin int, place int, n int"  # names that operators use inside as well


def prose(seed: int, words: int) -> str:
    rng = np.random.default_rng(seed)
    made = ["".join(rng.choice(list("abcdeinorstué"), rng.integers(2, 9))) for _ in range(words)]
    return " ".join(made) + "."


LONG = prose(1, 6000)
PASSAGE = prose(2, 60)
TEXTS = [
    (1, prose(3, 80)), (2, prose(3, 80)), (3, prose(3, 80) + " tail"), (4, None), (5, ""), (6, " \n\t "), (7, LONG), (8, "x " * 300), (9, PASSAGE + prose(4, 30)),
    (10, prose(5, 30) + PASSAGE), (11, "日本語 😀 İΣ <|endoftext|> it's é"), (11, "日本語 😀 İΣ <|endoftext|> it's é"), (None, "no id " + prose(6, 40)), (12, "One. Two.\nThree."), (13, "%%% *** |"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "k", 1, 2, 3) for i, t in TEXTS], DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def ids():
    tok = Tokenizer.from_file(WORDS)
    return {(i, t): tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in TEXTS}


def crc(values) -> int:
    return zlib.crc32(np.array(values, "<u4").tobytes())


def test_encoder_equals_the_library():
    tok = Tokenizer.from_file(WORDS)
    odd = ["a.. b., c_. d%. x².y 3.5.,", "tab\tnl\n\r\nx", "İstanbul ΣΑΣ Σ", "x<|endoftext|>y", "don't they'RE 'S", "\x1c\x1d a\xa0b", "é ́x ǅ ŉ ﬁ ẞ", "a" * 500, "foo.'s", LONG, ""]
    got = encode.memory(WORDS).encode(odd, end=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [tok.encode(t, add_special_tokens=False).ids for t in odd]


def test_encoder_knows_special_strings_by_their_case():
    tok = Tokenizer.from_file(WORDS)
    odd = ["<|ENDOFTEXT|>", "<|EndOfText|>", "a <|endoftext|> b <|ENDOFTEXT|>, c.", "Word.<|StartOfText|>.", "<|endoftext|>", "x<|endOfText|>y it's. %.", "<|STARTOFTEXT|><|startoftext|>"]
    for texts in (odd, odd[::-1]):
        got = encode.WordMemory(WORDS).encode(texts, end=False)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_forgets_without_changing_results(monkeypatch):
    monkeypatch.setattr(encode, "WORDS_KEPT", 50)
    monkeypatch.setattr(encode, "GROUP_CHARS", 200)
    words = encode.WordMemory(WORDS)
    texts = [prose(s, 40) for s in range(8)]
    tok = Tokenizer.from_file(WORDS)
    assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(texts, end=False)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_shards_read_back_by_the_index(spark, docs, ids):
    store = token_shards.build_store(spark, docs, WORDS, shards=3)
    found = token_shards.lookup(docs.select(F.col("doc_id").alias("key")).distinct(), store)
    rows = {r["key"]: r for r in found.collect()}
    assert set(rows) == {i for i, _ in TEXTS if i is not None} and rows[11]["copies"] == 2
    read = token_shards.read_documents(found, store).collect()
    assert {r["key"]: np.frombuffer(r["ids"], "<u4").tolist() for r in read} == {i: v for (i, _), v in ids.items() if i is not None}
    # The files hold all documents in key order, those without key first.
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))
    flat = [x for row in order for x in ids[row]]
    fs, root = token_shards._fs(store.path)
    shards = sorted(r["shard"] for r in store.starts.collect())
    raw = b"".join(fs.open_input_file(token_shards.shard_name(root, s)).read() for s in shards)
    assert np.frombuffer(raw, "<u2").tolist() == flat


def test_index_refuses_unknown_keys(spark, docs):
    store = token_shards.build_store(spark, docs, WORDS, shards=2)
    assert token_shards.lookup(spark.range(1000, 3000).select(F.col("id").alias("key")), store).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(-(2**62), 2**62, n * 2)
    keys = np.unique(keys)[:n]
    h = token_shards.PerfectHash.from_bytes(token_shards.PerfectHash.build(keys).to_bytes())
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))


def test_empty_store(spark, empty):
    store = token_shards.build_store(spark, empty, WORDS, shards=2)
    assert token_shards.lookup(empty.select(F.col("doc_id").alias("key")), store).count() == 0


def test_packing(spark, docs, ids, empty):
    pieces = packing.cut_pieces(docs, WORDS, limit=256)
    rows = packing.pack(pieces, capacity=256).collect()
    expected = Counter((i, k, at, len(v[at : at + 256]), crc(v[at : at + 256])) for i, t in TEXTS for v in [ids[i, t]] for k, at in enumerate(range(0, len(v), 256)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r["length"] for r in rows)
    assert len(bins) <= -(-total // 256) + 1
    assert packing.pack(packing.cut_pieces(empty, WORDS)).count() == 0


def test_packing_is_near_the_bound(spark):
    lens = np.random.default_rng(5).integers(1, 900, 4000).tolist()
    rows = packing.pack(spark.createDataFrame([(i, n) for i, n in enumerate(lens)], "doc long, length long"), 1000)
    assert rows.select("sequence_id").distinct().count() <= -(-sum(lens) // 1000) * 1.01 + 1


def simhash_bits(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in ([words[i : i + 4] for i in range(len(words) - 3)] or [words])]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def same_classes(found, expected):
    pairs = set(zip(found, expected, strict=True))
    return len(pairs) == len(set(found)) == len(set(expected))


def test_simhash(docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    expected = Counter((i, simhash_bits(t)) for i, t in TEXTS)
    assert Counter((r["doc_id"], r["fp"] % 2**64) for r in rows) == expected
    fps = [r["fp"] % 2**64 for r in rows]
    assert same_classes([r["component"] for r in rows], roots_of(len(rows), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4))
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("rows_in_group", [10, 10_000])
def test_trie_join_equals_all_pairs(spark, monkeypatch, rows_in_group):
    """Clusters of near fingerprints, with groups small enough to be dealt again and not."""
    monkeypatch.setattr(simhash, "GROUP_ROWS", rows_in_group)
    rng = np.random.default_rng(11)
    fps = set()
    for c in rng.integers(0, 2**63, 12, dtype=np.uint64).tolist():
        for _ in range(25):
            x = c
            for b in rng.choice(64, rng.integers(0, 6), replace=False).tolist():
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    frame = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    comps = components.components(simhash.links(frame, 4)).collect()
    root = {r["node"] % 2**64: r["root"] % 2**64 for r in comps}
    expected = roots_of(len(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    assert same_classes([root.get(x, x) for x in fps], expected)


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (200, 200)], "u long, v long")
    got = {r["node"]: r["root"] for r in components.components(chain).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200}


def removed_bytes(texts, length):
    seen = Counter(t[a : a + length] for t in texts for a in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if seen[t[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        yield gone


def passages(docs, length=200):
    rows, texts, kept = suffix_dedup.repeated_passages(docs, length)
    out = []
    for r in suffix_dedup.with_texts(rows, texts, kept).collect():
        copy = (r["copies"] or 1) > 1
        spans = [(0, r["n_bytes"])] if copy else list(zip(r["starts"] or [], r["stops"] or [], strict=True))
        out.append((r["doc_id"], r["n_bytes"], tuple(spans)))
    return Counter(out)


def expected_passages(rows, length=200):
    out = []
    raw = [(t or "").encode() for _, t in rows]
    for (i, _), t, gone in zip(rows, raw, removed_bytes(raw, length), strict=True):
        edges = [k for k in range(len(t) + 1) if (k > 0 and gone[k - 1]) != (k < len(t) and gone[k])]
        out.append((i, len(t), tuple(zip(edges[::2], edges[1::2], strict=True))))
    return Counter(out)


def test_passages(docs, empty):
    assert passages(docs) == expected_passages(TEXTS)
    assert suffix_dedup.repeated_passages(empty)[0].count() == 0


@pytest.mark.parametrize("hot", [1, 20_000])
def test_passages_with_overlaps_and_periods(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_SUFFIXES", hot)
    rng = np.random.default_rng(3)
    parts = [bytes(rng.integers(97, 100, n).tolist()).decode() for n in (230, 199, 200, 201, 450, 90)]
    period = "abcde" * 80
    texts = [parts[0] + parts[1], parts[1] + parts[0], "z" + parts[2], parts[2] + "y", parts[3][1:], "q" + parts[3], parts[4][:300] + parts[5], parts[5] + parts[4][100:]]
    texts += ["m" + period, period[2:] + "n", period[:203], "x" * 199, "x" * 200, "w" * 201, parts[0] + parts[0], (parts[5] + "#") * 5, "é" * 150, "a" + "é" * 150, "b" * 5000]
    rows = list(enumerate(texts))
    assert passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == expected_passages(rows)


@pytest.mark.parametrize("hot", [1, 3, 20_000])
def test_passages_over_random_joins(spark, monkeypatch, hot):
    """Many texts sharing random stretches, in small windows, with grams held to be hot and not."""
    monkeypatch.setattr(suffix_dedup, "WINDOWS", 300)
    monkeypatch.setattr(suffix_dedup, "HOT_SUFFIXES", hot)
    rng = np.random.default_rng(8)
    pool = [bytes(rng.integers(97, 123, 400).tolist()).decode() for _ in range(12)]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rng.integers(1, 5)):
            p = pool[rng.integers(len(pool))]
            a, b = sorted(rng.integers(0, 401, 2).tolist())
            text += p[a:b]
        rows.append((i, text))
    assert passages(spark.createDataFrame(rows, "doc_id long, text string")) == expected_passages(rows)


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


BENCH = [("a", "One two THREE four five six seven eight nine ten eleven."), ("b", "short item"), ("c", "short ITEM!"), ("d", None), ("e", "..."), (None, "nine ten"), ("f", "é-1 two"), ("a", "zeta"), ("10", "loop loop loop")]
HELD = [
    (1, "x one two three four five six seven eight nine ten y"), (2, "two three four five six seven eight nine ten eleven"), (3, "one two three four five six seven eight nine"), (4, "Short, item short item; loop loop loop loop"),
    (5, None), (6, ""), (7, "nine ten ZETA é 1 two"), (8, "nothing here"), (8, "nothing here"), (None, "short item"), (9, "loop loop"), (9, "loop loop loop"),
]


@pytest.mark.parametrize("block", [200_000, 2])
def test_decontamination(spark, block):
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in HELD], "doc_id long, text string, n int, words string").repartition(2)
    bench = spark.createDataFrame([(i, t, 0) for i, t in BENCH], "item_id string, text string, at int")
    windows = {}
    for item, text in BENCH:
        w = words_of(text)
        for at in range(max(1, len(w) - 9)):
            if w:
                windows.setdefault(tuple(w[at : at + 10]), set()).update({item} - {None})
    expected = []
    for i, t in HELD:
        w = words_of(t)
        hit, items = set(), set()
        for win, names in windows.items():
            for at in range(len(w) - len(win) + 1):
                if tuple(w[at : at + len(win)]) == win:
                    hit.update(range(at, at + len(win)))
                    items |= names
        expected.append((i, len(w), len(hit), tuple(sorted(items))))
    got = decontaminate.hits(docs, bench, block_windows=block).collect()
    assert Counter((r["doc_id"], r["n_words"], sum(b - a for a, b in zip(r["starts"], r["stops"], strict=True)), tuple(r["items"])) for r in got) == Counter(expected)


def test_decontamination_of_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.hits(empty, none).count() == 0
    assert {len(r["starts"]) for r in decontaminate.hits(docs, none).collect()} == {0}


def test_token_counts(docs, empty):
    pieces = public_tokenizers.path("piece_bpe_32k.model")
    scores = token_counts.piece_scores(pieces)
    model = Tokenizer(models.Unigram([("<unk>", 0.0), *scores.items()], 0, False))

    def count(word):
        e = model.encode(token_counts.MARK + word)
        return sum(len((token_counts.MARK + word)[a:b].encode()) if i == 0 else 1 for i, (a, b) in zip(e.ids, e.offsets, strict=True))

    known = {w: count(w) for _, t in TEXTS for w in set((t or "").split())}
    got = Counter(tuple(r) for r in token_counts.token_counts(docs, pieces).collect())
    assert got == Counter((i, len((t or "").split()), sum(known[w] for w in (t or "").split())) for i, t in TEXTS)
    assert token_counts.token_counts(empty, pieces).count() == 0


def test_trie_keeps_nothing_of_dropped_words(monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT", 5)
    t = token_counts.UnigramTrie({"▁a": -1.0, "b": -1.0, "▁ab": -1.5, "▁": -2.0, "a": -3.0})
    assert t.totals(["ab a b abb", "ab " * 3, "a" * 100, None]) == [(4, 1 + 1 + 2 + 2), (3, 3), (1, 1 + 99), (0, 0)]


def test_merkle(spark, docs, empty):
    tree = merkle.with_tree(docs, "text")
    roots = {}
    for r in tree.collect():
        roots.setdefault(r["text"] or "", set()).add(r["root"])
    assert all(len(v) == 1 for v in roots.values()) and len({next(iter(v)) for v in roots.values()}) == len(roots)
    two = spark.createDataFrame([("a\nb\nc\nd\ne", "a\nb\nX\nd\ne")], "text string, other string")
    both = merkle.with_tree(merkle.with_tree(two, "text"), "other", "o_")
    assert both.select(merkle.differing(F.col("paragraphs"), F.col("o_paragraphs"))).first()[0] == [2]
    assert both.select(merkle.likeness(F.col("clauses"), F.col("clauses"))).first()[0] == 1.0
    assert merkle.with_tree(empty, "text").count() == 0


def test_merkle_sections_are_runs_of_paragraphs(docs):
    for r in merkle.with_tree(docs, "text").collect():
        nodes = [hashlib.sha256(p.encode()).hexdigest() for p in (r["text"] or "").split("\n")]
        runs, run = [], ""
        for k, n in enumerate(nodes):
            run += n
            if n[0] in merkle.SECTION_ENDS or k + 1 == len(nodes):
                runs.append(run)
                run = ""
        assert r["paragraphs"] == nodes and r["sections"] == [hashlib.sha256(x.encode()).hexdigest() for x in runs]
        assert r["root"] == hashlib.sha256("".join(r["sections"]).encode()).hexdigest()


@pytest.mark.parametrize("text", ["wordsandmore " * 400, "日本語文章" * 300, "".join(prose(s, 30)[:-1] for s in range(9))])
def test_merkle_likeness_of_text_without_marks(spark, text):
    other = "another sentence. " * (len(text) // 18)
    half = len(text) // 2
    rows = spark.createDataFrame([(text, text[:half] + other[:half], other)], "text string, edited string, other string")
    near = [merkle.likeness(merkle.clauses(F.col("text")), merkle.clauses(F.col(c))) for c in ("text", "edited", "other")]
    same, edited, apart = rows.select(*near).first()
    assert same == 1.0 and 0.3 < edited < 0.9 and apart < 0.05


def test_merkle_likeness_counts_repeats_within_paragraphs(spark):
    rows = [("One. Two.", "One. Two.", 1.0), ("Same. Same. Same. Same.", "Same.", 0.4), ("a b\nc d", "a b c d", 0.0), ("a, " + "long clause " * 4 + ".", "b, " + "long clause " * 4 + ".", 50 / 53), ("", "", 1.0), ("", "x", 0.0)]
    df = spark.createDataFrame(rows, "a string, b string, near double")
    for r in df.withColumn("got", merkle.likeness(merkle.clauses(F.col("a")), merkle.clauses(F.col("b")))).collect():
        assert r["got"] == pytest.approx(r["near"]), r


MOVES = [
    ("abcd", "bcda", {0, 1}, {0, 3}), ("abca", "abc", {3}, set()), ("abc", "abca", set(), {3}), ("abc", "abxyc", set(), {2, 3}), ("aab", "ab", {1}, set()), ("abc", "abc", set(), set()), ("", "a", set(), {0}), ("abcde", "abXde", {2}, {2}),
]


def test_merkle_changes_tell_moves_and_repeats(spark):
    rows = [(list(a), list(b), a, b) for a, b, _, _ in MOVES]
    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b = ("".join(rng.choice(list("abcd"), rng.integers(0, 7))) for _ in "ab")
        rows.append((list(a), list(b), a, b))
    found = spark.createDataFrame(rows, "a array<string>, b array<string>, x string, y string").withColumn("c", merkle.changes(F.col("a"), F.col("b"))).collect()
    got = {(r["x"], r["y"]): r["c"] for r in found}
    for a, b, in_a, in_b in MOVES:
        assert (set(got[a, b]["a"]), set(got[a, b]["b"])) == (in_a, in_b), (a, b)
    for (a, b), c in got.items():
        assert (a == b) == (not c["a"] and not c["b"])
        # What is left besides occurs as often on either side.
        left = [Counter(n for i, n in enumerate(t) if i not in c[s]) for t, s in ((a, "a"), (b, "b"))]
        assert left[0] == left[1]


def test_merkle_descends_into_differing_sections(spark):
    lines = [f"line {i}" for i in range(60)]
    other = {"edit": lines[:30] + ["edited"] + lines[31:], "insert": lines[:30] + ["new 1", "new 2"] + lines[30:], "move": lines[40:] + lines[:40], "same": lines}
    df = spark.createDataFrame([(k, "\n".join(lines), "\n".join(v)) for k, v in other.items()], "k string, text string, other string")
    both = merkle.with_tree(merkle.with_tree(df, "text"), "other", "o_").withColumn("changed", merkle.changes(F.col("sections"), F.col("o_sections")))
    found = both.withColumn("below", merkle.paragraph_changes(F.col("changed"), F.col("paragraphs"), F.col("o_paragraphs"))).collect()
    got = {r["k"]: (r["below"]["a"], r["below"]["b"]) for r in found}
    assert got["edit"] == ([30], [30]) and got["insert"] == ([], [30, 31]) and got["same"] == ([], []) and got["move"][0] and got["move"][1]
    for r in found:
        assert (r["root"] == r["o_root"]) == (not r["changed"]["a"] and not r["changed"]["b"])


@pytest.mark.parametrize("bucket", [2, 1000])
def test_next_row(spark, docs, empty, monkeypatch, bucket):
    monkeypatch.setattr(merkle, "BUCKET_ROWS", bucket)
    rows = sorted(((i, t or "") for i, t in TEXTS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = Counter((i, t, rows[(k + 1) % len(rows)][1]) for k, (i, t) in enumerate(rows))
    filled = docs.withColumn("text", F.coalesce("text", F.lit("")))
    assert Counter(tuple(r) for r in merkle.with_next(filled, "doc_id", "text").collect()) == expected
    one = filled.where("doc_id = 12")
    assert merkle.with_next(one, "doc_id", "text").first()["next_text"] == "One. Two.\nThree."
    assert merkle.with_next(empty, "doc_id", "text").count() == 0


SAID = r"\### Assistant: </turn> ok"
TALK = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "hi " * 40), (1, 2, "assistant", "yo " * 30), (1, 3, "user", SAID), (1, 4, "assistant", "\\\\### ####### </turn></turn>\\"),
    (2, 0, "user", None), (2, 1, "assistant", ""), (3, 0, "system", "alone"), (None, 0, "user", "x"), (None, 1, "assistant", "y"), (4, None, None, "n"), (4, 5, "role: odd\\", "o"), (4, 5, "role: odd\\", "o"),
    (5, 0, "user", "long " * 3000), (5, 1, "assistant", "### " * 50), (6, 0, "assistant", "a"), (6, 1, "assistant", "b"),
] + [(7, k, ("user", "assistant")[k % 2], f"turn {k} " + "w " * (k % 60)) for k in range(700)]


@pytest.mark.parametrize(("budget", "history"), [(1024, 256), (80, 20), (1, 0)])
def test_chat(spark, budget, history):
    rows = spark.createDataFrame([(*r, 1) for r in TALK], "conv_id long, turn long, role string, text string, span int").repartition(3)
    made = chat.windows(rows, WORDS, budget, history)
    by = {}
    for c, t, r, x in sorted(TALK, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((r or "", x or ""))
    expected = set()
    for c, said in by.items():
        loss = "".join(x for r, x in said if r == "assistant")
        expected.add((chat.NO_ID if c is None else str(c), len(said), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in said).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    assert {tuple(r)[:5] for r in chat.read_back(made).collect()} == expected
    system = {str(c): v[0] for c, v in by.items() if v[0][0] == "system"}
    for r in made.collect():
        turns = chat.read_turns(r["text"])
        fresh = len(turns) - r["context"]
        assert r["tokens"] <= budget or fresh == 1 and r["context"] <= (r["conv"] in system) or r["conv"] in system and fresh == 2
        if r["conv"] in system:
            assert turns[0] == system[r["conv"]]


def test_chat_of_an_empty_table(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.windows(rows, WORDS)).count() == 0


def test_reading_turns_takes_little_memory():
    import tracemalloc

    said = "word \\ ### </turn> " * 300_000
    escaped = said.replace("\\", "\\\\").replace("###", "\\###").replace("</turn>", "\\</turn>")
    text = f"### user: {escaped}</turn>\n### a\\:b: x</turn>\n"
    tracemalloc.start()
    got = chat.read_turns(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [("user", said), ("a:b", "x")] and peak < 8 * len(text)
    for broken in ("### user: x", "### user: x\\</turn>\n", "user: x</turn>\n", "### a\\: x</turn>\n"):
        with pytest.raises(ValueError):
            chat.read_turns(broken)


def test_ids_that_do_not_fit_are_an_error():
    ids = np.array([1, 65_535], "<u4").tobytes()
    assert np.frombuffer(token_shards._packed(ids, 2), "<u2").tolist() == [1, 65_535] and token_shards._packed(ids, 4) == ids
    with pytest.raises(ValueError):
        token_shards._packed(np.array([65_536], "<u4").tobytes(), 2)


@pytest.mark.parametrize("salts", [1, 16])
def test_grams_are_counted_over_salts(spark, monkeypatch, salts):
    monkeypatch.setattr(suffix_dedup, "SALTS", salts)
    rows = [(k, 7, p) for k in range(300) for p in range(3)] + [(1, 8, 0), (2, 9, 5), (3, 9, 5), (4, -1, 1)] + [(5, 10, p) for p in range(2)]
    got = suffix_dedup._repeated(spark.createDataFrame(rows, "key long, gram long, place int").repartition(3), 4).collect()
    n = Counter(g for _, g, _ in rows)
    assert Counter(tuple(r) for r in got) == Counter((*r, n[r[1]]) for r in rows if n[r[1]] > 1)


def test_shards_at_a_path_without_scheme(spark, tmp_path, docs):
    store = token_shards.build_store(spark, docs, WORDS, shards=2, path=str(tmp_path / "shards"))
    assert store.path == f"file://{tmp_path}/shards" and token_shards.read_documents(store.directory, store).count() == len(TEXTS)


def test_pieces_do_not_depend_on_the_words_kept(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"Word{i % 7}, other-{i} and 日本{i}. The end") for i in range(60)] + [(60, None)], "doc_id long, text string")
    few, many = (packing.cut_pieces(docs, WORDS, limit=8, kept=n).orderBy("doc_id", "piece").collect() for n in (5, packing.WORDS_KEPT))
    assert few == many and len(many) > 61
    assert packing.WORDS_KEPT > encode.WORDS_KEPT
