import hashlib
import random

import numpy as np
import pytest
from conftest import SF001
from llm_helpers import SCHEMA, documents
from pyspark.sql import functions as F

from souk.llm import bpe
from souk.llm.bpe import Decoder, Encoder, Merges, Piece, bpe_decode, bpe_encode, decode_ids, encode_ids, op2_bpe, vocabulary_path


@pytest.fixture(scope="module")
def merges():
    with open(vocabulary_path(), encoding="utf-8") as f:
        return Merges(f.read())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_path())


def check(merges, library, text, chunk):
    ids = library.encode(text, add_special_tokens=False).ids
    assert encode_ids(merges, text, None, chunk).tolist() == ids, (text[:80], len(text), chunk)
    assert decode_ids(merges, np.array(ids, np.int32), 7) == library.decode(ids, skip_special_tokens=False)


def test_like_the_library(merges, library):
    rng = random.Random(5)
    letters = "aaaa   \n\t''''sstlldre.-=<|endoftext|>  é日本\x1c\x85    012²½A🙂‍"
    for _ in range(800):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        text += "<|endoftext|>" * (rng.random() < 0.3) + text[::-1]
        check(merges, library, text, rng.choice([1, 2, 3, 5, 64]))


def test_runs_longer_than_a_chunk(merges, library, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 64)
    rng = random.Random(6)
    texts = ["a" * 5000, " " * 5000 + "x", "-" * 7001, "\n" * 3000 + "  ", "=-" * 4000, "0" * 3000, "é" * 2000,
             (" " * 900 + "a") * 9, " " * 100 + "<|endoftext|>" + " " * 300 + "é", " " * 99 + "'s"]
    texts += ["".join(rng.choice("ab \n-e1") * rng.choice([1, 1, 40, 90, 200]) for _ in range(40)) for _ in range(60)]
    for text in texts:
        for chunk in (64, 63, 100):
            check(merges, library, text, chunk)


def test_lookahead_is_enough(merges):
    """Whatever follows, tokens that end lookahead bytes before stay."""
    rng = random.Random(7)
    pool = [t for t in merges.bytes_of.values() if len(t) > 1]
    for _ in range(300):
        head = b"".join(rng.choice(pool) for _ in range(90))[:2 * merges.lookahead]
        tail = b"".join(rng.choice(pool) for _ in range(20))
        short, long = merges.merge(head), merges.merge(head + tail)
        end = 0
        for a, b in zip(short, long, strict=False):
            end += len(merges.bytes_of[a])
            if end > len(head) - merges.lookahead:
                break
            assert a == b


def test_memory_is_bounded(merges):
    p, e = Piece(merges), Encoder(merges)
    for _ in range(50):
        for _ in p.feed(b"ab" * 4000):
            assert len(p.held) <= p.window
        for ids in e.feed("x" * bpe.CHUNK):
            for _ in ids:
                pass
        assert len(e.tail) + len(e.piece.held) <= 2 * bpe.CHUNK


def test_decoder_splits_characters(merges):
    d = Decoder(merges)
    ids = encode_ids(merges, "日本🙂é", None)
    assert "".join(d.feed([i]) for i in ids.tolist()) + d.finish() == "日本🙂é"
    assert Decoder(merges).feed([merges.byte_ids[0xE6]]) == "" and decode_ids(merges, np.array([merges.byte_ids[0xE6]])) == "�"


def test_improper_merges_are_refused():
    with pytest.raises(ValueError, match="once and before"):
        names = {c: i for i, c in enumerate(bpe.byte_names())}
        import json
        Merges(json.dumps({"added_tokens": [], "model": {"vocab": names | {"ab": 300, "abc": 301}, "merges": [["ab", "c"], ["a", "b"]]}}))


def test_operator(spark, library):
    rows = [(1, "a b"), (2, None), (3, ""), (3, ""), (None, "é <|endoftext|>"), (5, "word " * 60000)]
    df = documents(spark, rows).withColumn("decoded", F.lit(1)).withColumn("token_ids", F.lit("x"))
    got = bpe_decode(bpe_encode(df, vocabulary_path()), vocabulary_path()).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.token_ids == library.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "")
    assert bpe_encode(spark.createDataFrame([], SCHEMA), vocabulary_path()).count() == 0


def test_query_digests(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = op2_bpe(spark, SF001).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
