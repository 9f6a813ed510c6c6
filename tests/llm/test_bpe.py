"""Byte-level BPE against the public library, and decoding against Python's."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from twinproof.llm import bpe

NAMES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
TEXTS = [
    None, "", " ", "\n", "a", "hello world", "  two  spaces ", "don't we'll I'M", "x" * 300, "ab" * 200, "=" * 90, "1234567890 " * 9, "\x00\x1c\x85 ", "é" * 41,
    "<|endoftext|> <|im_start|>", "naïve 中文字符 🤗🏳️‍🌈 ﷽", "́́a", "tab\tand\r\nline", "𝔘𝔫𝔦" * 7, "ﬁ﻿ﬂ", "the of and " * 3000,
]


@pytest.fixture(scope="module", params=NAMES)
def both(request):
    ranks = bpe.read_ranks(public_tokenizers.path(request.param))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Vocabulary.of(ranks, public_tokenizers.PATTERN), theirs


def test_texts(both):
    ours, theirs = bpe.Encoder(both[0]), both[1]
    for text in TEXTS:
        assert list(ours.encode(text)) == theirs.encode_ordinary(text or ""), text


@pytest.mark.parametrize("states", [2, 500, bpe.STATES])
def test_pieces_of_any_bytes(both, states):
    vocabulary, theirs = both
    rnd, ours = random.Random(states), bpe.Transducer(vocabulary, states)
    some = [b"a", b"the", b"ing", b"\xc3", b"\xa9", b"==", b"-", b"0", b"\xe4\xb8\xad", b"aaaa", b"\n"]
    for k in range(700):
        if k % 3 == 0:
            piece = bytes(rnd.choice(b"abcdeinorst ") for _ in range(rnd.randrange(1, 60)))
        else:
            piece = b"".join(rnd.choice(some if k % 3 == 1 else vocabulary.tokens) for _ in range(rnd.randrange(1, 12)))
        assert list(ours.encode(piece)) == theirs._encode_single_piece(piece), piece
        assert len(ours.readings) <= states + 1


def test_lookahead_is_bounded(both):
    ours = bpe.Transducer(both[0])
    longest = max(map(len, both[0].tokens))
    for piece in (b"a" * 3000, b"abab" * 700, b" the" * 700, b"\xe4\xb8\xad" * 900):
        ours.encode(piece)
    assert max(len(told) for readings in ours.readings for *_, told in readings) <= longest


def test_tokens_that_no_merges_make():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"xyz": 257, b"abc": 258}
    theirs = tiktoken.Encoding("own", pat_str=r"\w+|\W+", mergeable_ranks=ranks, special_tokens={})
    vocabulary = bpe.Vocabulary.of(ranks, r"\w+|\W+")
    assert vocabulary.alone == {b"xyz"}
    ours = bpe.Encoder(vocabulary)
    for text in ("xyz", "xyzxyz", "abcxyz xyz", "aabcab"):
        assert list(ours.encode(text)) == theirs.encode_ordinary(text)


def test_older_pieces_come_back(both, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 3)
    ours = bpe.Encoder(both[0])
    text = "one two three four one two five six seven one " * 3
    assert list(ours.encode(text)) == both[1].encode_ordinary(text)
    assert len(ours.pieces) <= 3 and len(ours.words) <= 3


def test_decode_any_bytes(both):
    vocabulary, _ = both
    number = {t: i for i, t in enumerate(vocabulary.tokens)}
    rnd, ours = random.Random(4), bpe.Decoder(vocabulary.tokens)
    for _ in range(2000):
        raw = bytes(rnd.choice([rnd.randrange(256), rnd.randrange(0x80, 0xC0), 0xE4, 0xF0, 65]) for _ in range(rnd.randrange(0, 14)))
        ids = np.array([number[bytes([b])] for b in raw], np.int32)
        cut = rnd.randrange(0, len(raw) + 1)
        assert ours.feed(ids[:cut]) + ours.feed(ids[cut:]) + ours.end() == raw.decode("utf-8", "replace").encode()


def test_portions_end_between_characters(both):
    ours, text = bpe.Decoder(both[0].tokens), "🤗中é" * 20
    ids = np.array(both[1].encode_ordinary(text), np.int32)
    parts = [ours.feed(ids[i : i + 1]) for i in range(len(ids))] + [ours.end()]
    assert [p.decode() for p in parts] and b"".join(parts).decode() == text


def test_tables(spark, both, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH", 50)
    vocabulary, theirs = both
    rows = [(None if i == 3 else i // 2, t, "x", i) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens long")
    encoded = bpe.encode(docs, vocabulary)
    key = lambda r: (r[0] is None, r[0], r[1])
    assert sorted(map(tuple, encoded.collect()), key=key) == sorted(((d, theirs.encode_ordinary(t or "")) for d, t, *_ in rows), key=key)
    assert sorted(map(tuple, bpe.decode(encoded, vocabulary).collect()), key=key) == sorted(((d, t or "") for d, t, *_ in rows), key=key)
    assert bpe.encode(docs.limit(0), vocabulary).collect() == [] and bpe.digests(encoded.limit(0), vocabulary).collect() == []


def test_query(spark):
    import hashlib

    from twinproof.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    ranks = bpe.read_ranks(public_tokenizers.path(NAMES[0]))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = theirs.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(theirs.decode(ids)))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op12_byte_bpe"](spark, sf).collect()} == want


def test_a_task_of_the_query_has_one_python_process(spark, tmp_path):
    """Spark hands idle processes to any step, so with two steps in a task each of them comes to hold an encoder."""
    from twinproof.llm.queries import QUERIES

    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op12_byte_bpe"](spark, str(tmp_path))
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: r.n_tokens > 0 for r in found.collect()} == {i: bool(t) for i, t in enumerate(TEXTS)}
