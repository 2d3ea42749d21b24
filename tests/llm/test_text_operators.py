"""Words, byte-level BPE, decontamination and the training order, against plain versions."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from terravia.llm import bpe, decontaminate, training_order
from terravia.llm.bpe import Coder
from terravia.llm.words import Words, chunks, shingles

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", "   ", "a", "Ünï–cödé ÉÉ", "<|endoftext|> x", "\x00\n\n\t  z", "🙂👍🏽 zz", "aaaa" * 300, "ab" * 999]


def plain_words(text):
    return PATTERN.findall((text or "").translate(LOW))


@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_follow_the_pattern(texts):
    words = Words([t for t in texts])
    number = {}
    for i, t in enumerate(texts):
        own = plain_words(t)
        assert words.counts()[i] == len(own)
        for w, h in zip(own, words.hash[words.first[i] : words.first[i + 1]]):
            assert number.setdefault(w, h) == h
    assert len(set(number.values())) == len(number)


def test_words_of_very_long_texts():
    long = "é" * 700_000 + " " + "word " * 300_000
    words = Words([long, "word"])
    assert words.counts().tolist() == [300_001, 1]
    assert len(set(words.hash[1:].tolist())) == 1


def test_shingles_depend_on_order_and_size():
    h = Words(["a b c a b"]).hash
    two = shingles(h, 2)
    assert two[0] == two[3] and two[0] != shingles(h[[1, 0]], 2)[0]
    assert len(shingles(h, 6)) == 0


def test_chunks_hold_every_row():
    assert list(chunks([5, 5, 100, 1], 10)) == [(0, 2), (2, 3), (3, 4)]
    assert list(chunks([], 10)) == []


def naive_bpe(ranks, word):
    parts = [bytes([b]) for b in word]
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


@given(st.lists(st.text("abc", min_size=2, max_size=5), max_size=25), st.lists(st.text("abc", max_size=30), max_size=6), st.randoms())
@settings(max_examples=150, deadline=None)
def test_merges_with_any_order_of_ranks(pieces, words, chance):
    pieces = sorted({p.encode() for p in pieces})
    chance.shuffle(pieces)  # a longer piece may come before its parts
    ranks = {bytes([b]): b for b in range(256)} | {p: 256 + i for i, p in enumerate(pieces)}
    coder = Coder(ranks, r"\S+")
    encoded = [w.encode() for w in words]
    assert [np.frombuffer(x, np.int32).tolist() for x in coder.merge(encoded)] == [naive_bpe(ranks, w) for w in encoded]


def test_encoding_equals_the_library(spark):
    coder = Coder.load(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={}
    )
    chance = random.Random(5)
    long = "".join(chance.choices("abcdefghij", k=50_000))
    texts = [*ODD, long, "".join(chance.choices("añ ß1,\n'sé", k=5000))]
    for t in texts:
        ids = library.encode_ordinary(t or "")
        assert coder.encode(t) == ids
        assert coder.decode(ids) == (t or "").encode()
    rows = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(rows, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).collect()
    assert [list(r["ids"]) for r in got] == [library.encode_ordinary(t or "") for t in texts]
    assert [bytes(r["decoded"]) for r in got] == [(t or "").encode() for t in texts]
    digests = bpe.digests(rows, RANKS, public_tokenizers.PATTERN).collect()
    for r, t in zip(digests, texts):
        ids = library.encode_ordinary(t or "")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode(rows.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_memory_of_pre_tokens_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    coder = Coder.load(RANKS, public_tokenizers.PATTERN)
    texts = [f"word{i} again " + "x" * 100 for i in range(50)]
    fresh = Coder.load(RANKS, public_tokenizers.PATTERN)
    assert [coder.encode(t) for t in texts] == [list(fresh.encode_all([t]))[0] for t in texts]
    # two generations of at most the limit and the pre-tokens of one call
    assert len(coder.known) <= 10 + 8 and len(coder.older) <= 10 + 8


def plain_overlaps(docs, items, window=10):
    windows = {}
    for item, text in items:
        if item is None or text is None:
            continue
        w = plain_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w = plain_words(text)
        hit, found = set(), set()
        for g, own in windows.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def overlap_rows():
    chance = random.Random(3)
    words = [chance.choice("abcdefgh") + str(chance.randrange(3)) for _ in range(60)]
    items = [(i, " ".join(chance.choices(words, k=chance.randrange(1, 40)))) for i in range(12)]
    items += [(3, "Same id, other text of the item"), (None, "no id"), (20, None), (21, ""), (22, "..."), (23, "a0"), (24, "a0 b1")]
    items += [items[0], (30, " ".join(["rep"] * 25))]
    docs = [(None, None), (1, ""), (1, "a0"), (2, "REP " * 40), (2, "REP " * 40)]
    for i in range(40):
        text = chance.choices(words, k=chance.randrange(0, 60))
        if i % 3 == 0:
            piece = plain_words(chance.choice(items)[1])
            at = chance.randrange(len(text) + 1)
            text[at:at] = piece[: chance.randrange(1, len(piece) + 1)] if piece else []
        docs.append((100 + i, ", ".join(text)))
    return docs, items


def test_overlaps_against_every_window(spark, overlap_rows):
    docs, items = overlap_rows
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in decontaminate.report(d, b).collect()), key=repr)
    assert got == plain_overlaps(docs, items)
    blocks = sorted((tuple(r) for r in decontaminate.report(d, b, block_bytes=300).collect()), key=repr)
    assert blocks == got


def test_overlaps_of_empty_tables_and_clashing_names(spark, overlap_rows):
    docs, items = overlap_rows
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, hits string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert not any(r["contaminated"] for r in decontaminate.report(d, b.limit(0)).collect())
    assert decontaminate.report(d.limit(0), b).count() == 0
    clean = decontaminate.remove_contaminated(d, b)
    assert clean.columns == d.columns
    expected = [r[0] for r in plain_overlaps(docs, items) if not r[5]]
    assert sorted((r["doc_id"] for r in clean.collect()), key=repr) == sorted(expected, key=repr)


def test_overlaps_with_some_shingles_missing(spark):
    words = [f"w{i}" for i in range(10)]
    near = words[:9] + ["other"]
    d = spark.createDataFrame([(1, " ".join(near)), (2, "w0 w1 w2 x y z w3 w4 w5 q")], "doc_id long, text string")
    b = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = {r["doc_id"]: r["items"] for r in decontaminate.find_overlaps(d, b, threshold=0.8).collect()}
    assert got == {1: ["7"], 2: []}
    assert all(not r["items"] for r in decontaminate.find_overlaps(d, b).collect())


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000])
def test_feistel_is_a_permutation(n):
    slots = training_order.feistel(np.arange(n), n, 17)
    assert sorted(slots.tolist()) == list(range(n))
    if n > 100:
        assert (slots != training_order.feistel(np.arange(n), n, 18)).any()
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.2


def test_shards_hold_every_text_in_order(spark, tmp_path):
    chance = random.Random(1)
    texts = [*ODD, "x " * 3000, *(" ".join(chance.choices(["alpha", "beta", "gamma"], k=chance.randrange(90))) for _ in range(60))]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "no id", 1)], "doc_id long, text string, slot int")
    folder = str(tmp_path / "shards")
    made = training_order.materialise(docs.repartition(3), RANKS, public_tokenizers.PATTERN, key=5, folder=folder, length=64, shard=7)
    rows = sorted((tuple(r) for r in made.collect()), key=lambda r: r[0])
    n = len(rows)
    assert [r[0] for r in rows] == list(range(n))
    assert all(r[1] == r[0] // 7 and r[2] == r[0] % 7 * 128 for r in rows)
    read = training_order.read_sequences(folder, 0, n, 64, 7)
    assert (read[5 : n - 3] == training_order.read_sequences(folder, 5, n - 8, 64, 7)).all()
    # Packed again without the order, the sequences are the same, each in its slot.
    library = training_order.encoder(RANKS, public_tokenizers.PATTERN)
    ends = sum(t is not None for t in texts) + 1
    body = sum(len(library.encode_ordinary(t)) for t in texts if t) + len(library.encode_ordinary("no id"))
    assert sum(r[3] for r in rows) == ends + body
    seen = [d for r in rows for d in r[4]]
    assert set(seen) == {i for i, t in enumerate(texts) if t is not None}
    again = str(tmp_path / "again")
    training_order.materialise(docs.repartition(3), RANKS, public_tokenizers.PATTERN, key=5, folder=again, length=64, shard=7).count()
    for f in sorted((tmp_path / "shards").iterdir()):
        assert f.read_bytes() == (tmp_path / "again" / f.name).read_bytes()


def test_unpacking_in_number_order_gives_the_texts_back(spark, tmp_path):
    texts = ["one two three " * 9, "", "four " * 50, "five"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    packed = training_order.sequences(docs, RANKS, public_tokenizers.PATTERN, length=32)
    placed, n = training_order.in_training_order(packed.cache(), 9, 4)
    slot_of = {r["number"]: r["slot"] for r in placed.collect()}
    training_order.write_shards(placed, n, str(tmp_path), 32, 4).count()
    flat = np.concatenate([training_order.read_sequences(str(tmp_path), slot_of[i], 1, 32, 4)[0] for i in range(n)])
    library = training_order.encoder(RANKS, public_tokenizers.PATTERN)
    back, own = [], []
    for i in flat.tolist():
        if i == training_order.END:
            back.append(library.decode(own))
            own = []
        else:
            own.append(i)
    assert back[: len(texts)] == texts and not "".join(back[len(texts) :])


def test_no_documents_give_no_sequences(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert training_order.materialise(docs, RANKS, public_tokenizers.PATTERN, folder=str(tmp_path)).count() == 0
