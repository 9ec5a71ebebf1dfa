"""Encoders, token files: against the libraries, over odd texts and empty tables."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from riskflow.llm import sentencepiece_bpe as spb
from riskflow.llm import token_files as tf

from .conftest import LONG

PIECE = public_tokenizers.path("piece_bpe_32k.model")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "   ", "▁", "<s> </s>", "a" * 3000, "日本語 テキスト", "\n\n a  b\t c", "x" * 401 + " y", "<0x0A>", "the" * 700, "😀 é\u0301 \u0000 #2", LONG]


def _random_texts(n: int, seed: int) -> list[str]:
    rnd = random.Random(seed)
    alphabet = "abAB  \n\t▁éß漢字日本😀\u0000\u200b\u0301\x1c\x85.,0123<>|'s#/theing"
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(n)]


def test_codec_equals_the_library():
    lib, own = sentencepiece.SentencePieceProcessor(model_file=PIECE), spb.Codec(PIECE)
    texts = ODD + _random_texts(800, 1)
    ids, offsets = own.encode(texts)
    want = lib.encode(texts, add_bos=True, add_eos=True)
    got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == want
    assert own.decode(ids, offsets) == lib.decode(want)


def test_decoding_any_ids_equals_the_library():
    lib, own, rnd = sentencepiece.SentencePieceProcessor(model_file=PIECE), spb.codec(PIECE), random.Random(2)
    for _ in range(500):
        x = [rnd.randrange(300) if rnd.random() < 0.6 else rnd.randrange(32000) for _ in range(rnd.randrange(9))]
        assert own.decode(np.array(x, np.int64), np.array([0, len(x)])) == [lib.decode(x)]


def test_encode_rows(spark, docs):
    got = spb.encode(docs([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c")]), PIECE).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["decoded"]) for r in got) == [(-1, 3, "c"), (1, 2, ""), (2, 2, ""), (3, 4, "a b"), (3, 4, "a b")]
    assert spb.encode(docs([]), PIECE).count() == 0


def test_chunked_tokens_equal_the_library():
    lib, own = Tokenizer.from_file(WORD), tf.Tokens(WORD)
    texts = ODD + _random_texts(800, 3)
    texts = texts + texts[::-1]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    ids, size = own.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    ends = np.cumsum(size)
    got = [ids[e - n : e].tolist() for e, n in zip(ends, size, strict=True)]
    assert got == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(4)
    for top, lens in ((3, [0, 1, 5000, 2]), (49408, [3000] * 4), (2**31, [500, 0, 500]), (60000, [200_000]), (1, [64, 64])):
        lens = np.array(lens)
        ids = rng.integers(0, top, lens.sum()) if top > 100 else rng.integers(0, top + 1, lens.sum())
        ids[: len(ids) // 2] = np.resize(ids[:7], len(ids) // 2)
        raw = tf.compress(ids.astype(np.uint32), lens)
        shard = tf.Shard(raw)
        back, size = shard.documents()
        assert back.tolist() == ids.tolist() and size.tolist() == lens.tolist()
        ends = np.cumsum(lens)
        for i in range(len(lens)):
            assert shard.document(i).tolist() == ids[ends[i] - lens[i] : ends[i]].tolist()
    assert len(tf.compress(np.resize([5, 6, 7], 30000).astype(np.uint32), np.array([30000]))) < 5000
    assert tf.Shard(tf.compress(np.zeros(0, np.uint32), np.zeros(0, np.int64))).n_docs() == 0


def test_files_hold_every_document_in_order(spark, docs):
    rows = [(5, "one two two two"), (2, None), (9, LONG), (7, ""), (2, "ties # last"), (None, "no id"), (-3, "x y")]
    shards = tf.write(docs(rows), WORD, shard_ids=50)
    got = tf.checksums(tf.read(shards)).orderBy("start").collect()
    lib = Tokenizer.from_file(WORD)
    at = 0
    for r, (i, text) in zip(got, sorted(rows, key=lambda r: (r[0] if r[0] is not None else -(2**63), r[1] or "")), strict=True):
        ids = lib.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert tf.read(tf.write(docs([]), WORD)).count() == 0
