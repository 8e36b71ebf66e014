"""Quality classifier: hashed word and character n-gram vectors, averaged per
document, with a softmax output trained by stochastic gradient descent."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.llm.common import map_texts, query, table, text_or_empty
from souk.llm.language_id import fold

#: bound of the labelled sample: rows, and characters of all its texts
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 16_000_000
#: vectors, their length, n-gram sizes, passes and first step size
BUCKETS, DIM, GRAMS, EPOCHS, RATE = 1 << 16, 8, (2, 3, 4), 4, 0.6
#: vectors of their own: the end of a text, and a word said twice running
#: (a relation that no n-gram of words unseen in training carries: see README)
END, TWICE = BUCKETS, BUCKETS + 1
#: characters that are hashed at once; fixed odd multipliers of an n-gram's places
PIECE = 1_000_000
STRIDES = [np.uint32(x) for x in (0xCC9E2D51, 0x1B873593, 0xE6546B64 | 1, 0x85EBCA6B)]
#: scores from here on count as label 1
CUT = 0.3


def _spread(h: np.ndarray) -> np.ndarray:
    """32-bit sums -> buckets."""
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h ^ (h >> np.uint32(13))) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def buckets(text: str) -> np.ndarray:
    """Buckets of a text: of every word, of every n-gram of a word's
    characters with a mark at both ends, TWICE for a word that follows itself
    (as often as a word has n-gram sizes), and END."""
    parts = [_piece(text[a:b]) for a, b in pieces(text)]
    return np.concatenate([*parts, [END]]).astype(np.int64)


def pieces(text: str, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of about ``size`` characters, cut at white space if
    there is any in the second half, so that memory stays bounded."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            cut = max(text.rfind(" ", at + size // 2, end), text.rfind("\n", at + size // 2, end))
            end = cut if cut > 0 else end
        yield at, end
        at = end


def _piece(text: str) -> np.ndarray:
    c = np.frombuffer((" " + text + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    white = (c == 32) | ((c >= 9) & (c <= 13))
    first = np.concatenate(([True], ~(white[1:] & white[:-1])))
    c, white = c[first], white[first]
    if len(c) < 3:
        return np.empty(0, np.uint32)
    with np.errstate(over="ignore"):
        x = np.where(white, np.uint32(32), c) * np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(16)
        found, inside = [], np.ones(len(x) - 1, bool)
        total = x[:-1] * STRIDES[0] + x[1:] * STRIDES[1]
        for n in range(2, max(GRAMS) + 1):
            if n > 2:
                inside = inside[:-1] & ~white[n - 2:len(x) - 1]
                total = total[:-1] + x[n - 1:] * STRIDES[n - 1]
            if n in GRAMS:
                found.append(_spread(total[inside] + np.uint32(n)))
        starts = np.flatnonzero(white[:-1]) + 1
        # (the stream begins with a mark, so the words' starts begin at 1)
        sizes = np.diff(np.append(starts, len(x)))
        place = np.arange(1, len(x), dtype=np.uint32) - np.repeat(starts, sizes).astype(np.uint32)
        whole = np.add.reduceat((x * ~white)[1:] * (place * np.uint32(0x85EBCA77) + np.uint32(0x165667B1)), starts - 1, dtype=np.uint32)
        twice = int((whole[1:] == whole[:-1]).sum()) * len(GRAMS)
        return np.concatenate([_spread(whole), *found, np.full(twice, TWICE, np.uint32)])


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Different buckets of a text and their shares; the shares add up to 1."""
    at, n = np.unique(buckets(text), return_counts=True)
    return at, (n / n.sum()).astype(np.float32)


def train(texts: Sequence[str], labels: Sequence[int], epochs: int = EPOCHS, rate: float = RATE,
          dim: int = DIM, seed: int = 1) -> np.ndarray:
    """Log odds of label 1 per bucket (BUCKETS + 2 floats).

    A document is the average of its buckets' vectors; softmax over the
    labels; one gradient step per document in random order, step sizes
    falling to 0. Both layers are learned; as the document is linear in its
    buckets, what a scorer needs of them is one number per bucket.
    """
    rng = np.random.RandomState(seed)
    vectors = (rng.rand(BUCKETS + 2, dim).astype(np.float32) - 0.5) / dim
    out = np.zeros((2, dim), np.float32)
    docs = [document_features(t) for t in texts]
    steps, done = epochs * max(len(docs), 1), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            at, share = docs[i]
            step = rate * (1 - done / steps)
            hidden = share @ vectors[at]
            z = out @ hidden
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(labels[i])] -= 1
            back = p @ out
            out -= step * np.outer(p, hidden)
            # a share is small; the vectors learn at the document's full step
            vectors[at] -= (step * len(at) ** 0.5) * np.outer(share, back)
            done += 1
    return vectors @ (out[1] - out[0])


def probability(odds: np.ndarray, text: str) -> float:
    """Probability of label 1 for a whole text."""
    total, n = float(odds[END]), 1
    for a, b in pieces(text):
        found = _piece(text[a:b])
        total, n = total + float(odds[found].sum(dtype=np.float64)), n + len(found)
    return float(1 / (1 + np.exp(-total / n)))


def labelled_sample(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple[list[str], list[int]]:
    """At most ``rows`` different labelled texts of at most ``chars``
    characters together, for the driver: those whose ids have the smallest
    hashes, so every run learns from the same ones. Texts are taken whole if
    all together fit; otherwise each has an equal share of ``chars``, and one
    longer than that gives a piece of this length from a hashed place, so a
    long text takes no other's place. Rows without id, text or label are no examples; labels count
    as 1 if they are not 0; of repeated labels the greatest counts."""
    marks = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
                   .groupBy(F.col(id_col).alias("_id")).agg(F.max((F.col(label_col) != 0).cast("int")).alias("_label")))
    d = df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")).where("_text <> ''")
    # ids first: a label without a text takes no place in the sample
    few = (d.select("_id").join(marks, "_id").distinct().orderBy(F.xxhash64("_id"), "_id").limit(rows))
    d = (d.join(F.broadcast(few), "_id").groupBy(F.xxhash64("_text").alias("_h")).agg(F.min(F.struct("_text", "_label")).alias("_x")))
    # (over at most ``rows`` rows)
    every, n = Window.partitionBy(), F.length("_x._text")
    d = d.withColumn("_sum", F.sum(n).over(every)).withColumn("_share", F.floor(F.lit(chars) / F.count(F.lit(1)).over(every)).cast("int"))
    place = (F.pmod("_h", F.greatest(n - F.col("_share"), F.lit(0)).cast("long") + 1) + 1).cast("int")
    text = F.when(F.col("_sum") <= chars, F.col("_x._text")).otherwise(F.col("_x._text").substr(place, F.col("_share")))
    got = d.select(text.alias("_text"), "_x._label", "_h").orderBy("_h").collect()
    return [r[0] for r in got], [r[1] for r in got]


def score_quality(df: DataFrame, odds: np.ndarray, text_col: str = "text", cut: float = CUT,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``
    (1 from ``cut`` on) to every row of the columns ``keep`` (default: all).

    Only the text is looked at, the whole of it. NULL and empty texts are
    scored by what was learned of texts' ends alone; equal texts get equal
    scores. ``odds`` has a fixed size and is broadcast. Input columns named
    like the results are replaced; an empty table gives an empty result.
    """
    model = df.sparkSession.sparkContext.broadcast(odds)

    def make():
        odds = model.value

        def run(texts):
            scores = np.array([probability(odds, t) for t in texts], np.float64)
            return [pa.array(scores), pa.array((scores >= cut).astype(np.int32))]
        return run

    return map_texts(df, text_col, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], make, keep)


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned outside fold 0 of 5."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    odds = train(*labelled_sample(docs, labels))
    return score_quality(docs.withColumn("held_out", fold("doc_id", 5) == 0), odds, keep=["doc_id", "held_out"])
