"""SentencePiece encoding and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_SMALL
from docsift.llm import pieces
from pyspark.sql import functions as F
from test_text_operators import HOSTILE, docs

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = pieces.load_model(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PARTS = ["a", "b", "e", "th", "er", "in", " ", "  ", "é", "漢", "字", "日本", "\n", "\t", "😀", "́", "0", "12", "▁", "=", "--", "aaaa", "www", "\x00",
         "Ⴀ", "　", "的", "是", "не", "при", "﻿", "�"]


def texts():
    rng = random.Random(1)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    out += [" " * 3000, "a" * 3000, "ab" * 3000, "the" * 3000, "x  " * 500 + " " * 2001 + "the", "</s><s><0x0A>", "=" * 999, "日本語" * 500]
    return out


def test_encode_and_decode_equal_the_library(spark):
    rows = HOSTILE + [(1000 + i, t) for i, t in enumerate(texts())]
    encoded = pieces.encode(docs(spark, rows), MODEL, block_chars=3000)
    got = pieces.decode(encoded.withColumn("decoded", F.lit("clash")), MODEL).collect()
    expected = []
    for i, t in rows:
        ids = LIBRARY.encode(t or "", add_eos=True)
        expected.append((str(i), len(ids), ids, LIBRARY.decode(ids)))
    assert sorted((str(r.doc_id), r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded).decode()) for r in got) == sorted(expected)
    empty = pieces.encode(docs(spark, []), MODEL)
    assert pieces.decode(empty, MODEL).count() == 0 and pieces.round_trip(docs(spark, []), MODEL).count() == 0


@pytest.mark.parametrize("rounds", [0, 1, 2, 5])
def test_heap_goes_on_from_any_round(rounds):
    for t in texts():
        if not t:
            continue
        code = np.array([ord(c) for c in (" " + t).replace(" ", "▁")])
        at, there = pieces._find(MODEL.chars, code)
        sym = np.where(there, MODEL.char_symbols[at], -1 - code)
        got, seg = pieces.merge_rounds(MODEL, sym, np.zeros(len(sym), np.int64), rounds)
        whole, _ = pieces.merge_rounds(MODEL, sym, np.zeros(len(sym), np.int64), 1 << 40)
        assert got.tolist() == whole.tolist() and not seg.any()


def test_decode_of_any_ids(spark):
    byte = [int(x) for x in MODEL.byte_ids]
    lists = [[], [2], [1, 264, 2], [byte[0xE3], byte[0x81], 29871, byte[0xFF], byte[0x41], 2], [259, 264], [1, 259, 264], [2, 2, 1, 260], [byte[0xC3], byte[0xA9]]]
    rows = [(i, np.array(x, "<u4").tobytes()) for i, x in enumerate(lists)] + [(99, None)]
    got = {r.n: bytes(r.decoded).decode() for r in pieces.decode(spark.createDataFrame(rows, "n int, ids binary"), MODEL).collect()}
    assert got == {i: LIBRARY.decode(x) for i, x in enumerate(lists)} | {99: ""}


def test_other_models_are_refused(tmp_path):
    (tmp_path / "m").write_bytes(b"")
    with pytest.raises(ValueError):
        pieces.load_model(str(tmp_path / "m"))


def test_op11_equals_the_library(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = pieces.op11(spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = LIBRARY.encode(rows[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
