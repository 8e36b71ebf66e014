import zlib

import numpy as np
import pytest
from conftest import SF01
from llm_helpers import SCHEMA, documents
from pyspark.sql import functions as F

from souk.llm import common, language_id, quality
from souk.llm.language_id import Parser, op4_language_id, predict_language
from souk.llm.quality import buckets, op3_quality, score_quality, train


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


# ---- language ID

SAMPLE = [("de", "der hund und die katze sind im haus und schlafen dort"),
          ("en", "the dog and the cat are in the house and sleep there"), ("fr", "le chien et le chat sont dans la maison et dorment")]


def naive_phrases(text, sample):
    """Longest matches by substring search, on class strings."""
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        n, at = n + 1, at + size
    return n


def test_phrases_are_longest_matches():
    p = Parser(SAMPLE, block=1 << 20)
    texts = ["der hund schläft", "the cat!! 123 sleeps", "zzz", "x" * 500, "Le Chat et le chien " * 20, "a", "the dog and the cat"]
    got = p.phrases(texts)
    coded = ["".join(map(chr, p.alphabet.classes(t))) for _, t in SAMPLE]
    for i, t in enumerate(texts):
        c = "".join(map(chr, p.alphabet.classes(t)))
        assert got[i].tolist() == [naive_phrases(c, s) for s in coded], t


def test_blocks_of_a_long_text_add_up():
    whole, cut = Parser(SAMPLE, block=1 << 20), Parser(SAMPLE, block=64)
    text = "the dog and the cat are in the house " * 300
    a, b = whole.phrases([text])[0], cut.phrases([text])[0]
    n = -(-len(whole.alphabet.classes(text)) // 64)
    assert (b >= a).all() and (b - a <= n).all()


def test_language_operator(spark):
    rows = [(1, "the house and the dog"), (2, None), (3, ""), (4, "123 !!"), (5, "le chat dans la maison"), (5, "le chat dans la maison"),
            (None, "die katze im haus"), (7, "the cat " * 30000)]
    df = documents(spark, rows).withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(0))
    got = predict_language(df, SAMPLE).collect()
    want = {1: "en", 2: "und", 3: "und", 4: "und", 5: "fr", None: "de", 7: "en"}
    assert len(got) == 8 and all(r.lang_pred == want[r.doc_id] and 0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert {r.lang_pred for r in predict_language(df, []).collect()} == {"und"}
    empty = spark.createDataFrame([], SCHEMA)
    assert language_id.labelled_sample(empty) == [] and predict_language(empty, SAMPLE).count() == 0


def test_sample_is_bounded_and_ignores_copies(spark):
    rows = [(i, "the same text again", "en", "s") for i in range(50)] + [(100 + i, f"text number {'x' * i}", "en", "s") for i in range(30)]
    rows += [(200, "kein Label", None, "s"), (201, None, "de", "s"), (202, "123", "de", "s"), (203, "ein Text", "de", "s")]
    got = dict(language_id.labelled_sample(documents(spark, rows), chars=300, texts=20))
    assert sorted(got) == ["de", "en"] and got["de"] == "ein Text"
    assert got["en"].count("same text") <= 1 and len(got["en"].replace("\n", "")) <= 300


def test_language_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = op4_language_id(spark, SF01).collect()
    assert len(got) == len(truth) and all(r.held_out == (crc(r.doc_id, 4) == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


# ---- quality

def test_buckets_brute_force():
    """As many buckets as words, n-grams, repetitions and the end; the same
    word gives the same ones wherever it stands."""
    for text in ["a", "  ab  ab\n\tab cde ", "éé x éé", "", " \n "]:
        words = text.split()
        grams = sum(max(len(w) + 3 - n, 0) for w in words for n in quality.GRAMS)
        twice = sum(a == b for a, b in zip(words, words[1:], strict=False)) * len(quality.GRAMS)
        assert len(buckets(text)) == len(words) + grams + twice + 1
    assert sorted(buckets("one two")) == sorted(buckets("  two\none"))
    assert set(buckets("one")) < set(buckets("two one"))


def test_long_texts_in_pieces(monkeypatch):
    text = "some words and more words " * 400
    whole = np.sort(buckets(text))
    monkeypatch.setattr(quality, "PIECE", 1000)
    parts = [text[a:b] for a, b in quality.pieces(text, 1000)]
    assert "".join(parts) == text and max(map(len, parts)) <= 1000
    assert (np.sort(np.concatenate([*map(quality._piece, parts), [quality.END]])) == whole).all()


def test_quality_operator(spark):
    good, bad = ["plain words in a line number " + "x" * i for i in range(40)], [f"junk*** of### {i}$$$ signs&&&" for i in range(40)]
    odds = train(good + bad, [1] * 40 + [0] * 40, epochs=20)
    rows = [(1, "more plain words in here"), (2, "even### more*** junk$$$"), (3, None), (4, ""), (5, "plain words " * 50000)]
    df = documents(spark, rows).withColumn("predicted", F.lit("x"))
    got = {r.doc_id: r for r in score_quality(df, odds).collect()}
    assert got[1].predicted == 1 and got[2].predicted == 0 and got[5].predicted == 1
    assert got[3].score == got[4].score and all(0 <= r.score <= 1 for r in got.values())
    assert train([], []).shape == (quality.BUCKETS + 2,)
    assert score_quality(spark.createDataFrame([], SCHEMA), odds).count() == 0


def test_quality_held_out(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    got = op3_quality(spark, SF01).collect()
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.3) for r in got)
    held = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([[a > b for b in bad] for a in good]) >= 0.95


def test_quality_needs_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.labelled_sample(documents(spark, [(1, "a")]), labels) == ([], [])
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    texts, ys = quality.labelled_sample(documents(spark, [(1, "a"), (2, "b"), (3, None), (None, "c")]), labels)
    assert (texts, ys) == (["b"], [1])


@pytest.mark.parametrize("text", ["", "a", "ééé", "word " * 10])
def test_scores_are_probabilities(text):
    assert 0 <= quality.probability(train(["a", "b"], [0, 1]), text) <= 1


def test_quality_sample_with_huge_texts(spark):
    """A text longer than the whole bound costs no other its place."""
    small = [(i, f"text number {i}") for i in range(40)]
    huge = [(100 + i, f"huge {i} " * 2000) for i in range(8)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in small + huge], "doc_id long, quality int")
    texts, ys = quality.labelled_sample(documents(spark, small + huge), labels, chars=4800)
    assert len(texts) == len(ys) == 48 and {t for _, t in small} <= set(texts)
    assert sum(map(len, texts)) <= 4800 and sum(len(t) == 100 for t in texts) == 8


def test_no_long_text_is_a_languages_whole_sample(spark):
    from pyspark.sql import functions as F

    from souk.llm.language_id import labelled_sample as sample
    texts = [(i, f"ein kurzer deutscher Satz Nummer {i} mit einigen Worten darin " * 8, "de", "s") for i in range(300)]
    texts += [(1000 + i, "zqx" * 40_000 + str(i), "de", "s") for i in range(5)]
    df = documents(spark, [(i, t, la, s) for i, t, la, s in texts])
    [(lang, text)] = sample(df)
    assert lang == "de" and len(text) <= 61_000 and len(set(text.split("\n"))) >= 50
    assert text.count("zqx") * 3 < 0.2 * len(text) and "deutscher" in text
    [(_, few)] = sample(df.where(F.col("doc_id") >= 1002))   # three texts only: larger shares
    assert len(few) > 59_000


def test_labels_without_documents_take_no_place(spark):
    from souk.llm.quality import labelled_sample as sample
    docs = documents(spark, [(i, f"text {i}") for i in range(200)])
    labels = spark.range(20_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    texts, marks = sample(docs, labels, rows=100)
    assert len(texts) == len(marks) == 100


def test_a_worker_holds_one_model_at_a_time():
    parser = language_id._parser(SAMPLE)
    assert language_id._parser(list(SAMPLE)) is parser
    other = language_id._parser(SAMPLE[:1])
    assert list(common._HELD.values()) == [other]
    common.release()
    assert not common._HELD
