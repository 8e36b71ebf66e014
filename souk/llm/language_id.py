"""Language ID by cross-parsing against a suffix automaton per language."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.llm.common import held, map_texts, materialise, query, table, text_or_empty

#: bound of the labelled sample: characters and texts per language
SAMPLE_CHARS, SAMPLE_TEXTS = 60_000, 200
#: texts that a language's sample is made of at least, if it has so many
SAMPLE_SPREAD = 50
#: letters that get a class of their own, by frequency in the sample
ALPHABET = 120
#: characters that are parsed on their own; longer texts are parsed in blocks
BLOCK = 1024
UNKNOWN = "und"
#: a text is in a learned language if it needs at most so many times the
#: phrases per symbol that the worst part of the sample needs, and SOME more
MARGIN, SOME = 1.25, 8


def labelled_sample(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
                    chars: int = SAMPLE_CHARS, texts: int = SAMPLE_TEXTS) -> list[tuple[str, str]]:
    """``(language, text)`` with at most ``chars`` characters per language, of
    at most ``texts`` different texts, for the driver to broadcast. A text
    gives at most an equal share, a SAMPLE_SPREAD-th of ``chars`` (more only
    where a language has fewer texts), from a hashed place: no long text is a
    language's whole sample.

    The texts are those with the smallest hashes, so the sample is the same
    on every run, and copies of a text count once: texts are first reduced
    to hashes (combined before the shuffle) and counted by language, those
    hashes that are surely too great go, the window keeps ``texts`` of the
    rest, and only their rows are read again. Rows without label, text or
    letters are no examples. The result is bounded by
    ``chars`` times the number of languages, not by the corpus.
    """
    d = (df.select(F.col(lang_col).cast("string").alias("lang"), text_or_empty(text_col).alias("text"))
           .where(F.col("lang").isNotNull() & has_letter("text")).withColumn("h", F.xxhash64("text")))
    w = Window.partitionBy("lang").orderBy("h")
    hashes = materialise(d.select("lang", "h").distinct(), "language-hashes")
    sizes = materialise(hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "language-sizes")
    # hashes are spread evenly: twice the share that is wanted, and some more,
    # holds the smallest of a language, in rows that do not grow with it
    share = (F.col("h").cast("double") / F.lit(2.0 ** 64) + 0.5) * F.col("size")
    few = (hashes.join(sizes, "lang").where(share <= 2 * texts + 50).withColumn("n", F.row_number().over(w))
                 .where(F.col("n") <= texts).select("lang", "h"))
    few = materialise(few, "language-sample")
    spread = few.groupBy("lang").agg(F.floor(F.lit(chars) / F.least(F.count(F.lit(1)), F.lit(SAMPLE_SPREAD))).cast("int").alias("share"))
    few = few.join(spread, "lang")
    place = (F.pmod("h", F.greatest(F.length("text") - F.col("share"), F.lit(0)).cast("long") + 1) + 1).cast("int")
    rows = d.join(F.broadcast(few), ["lang", "h"]).select("lang", "h", F.col("text").substr(place, F.col("share")).alias("text"))
    rows = rows.groupBy("lang", "h").agg(F.min("text").alias("text"))
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("before", F.coalesce(F.sum(F.length("text")).over(upto), F.lit(0)))
                .where(F.col("before") < chars)
                .select("lang", "h", F.expr(f"substring(text, 1, cast({chars} - before as int))").alias("text")))
    parts: dict[str, list[str]] = {}
    for r in rows.orderBy("lang", "h").collect():
        parts.setdefault(r["lang"], []).append(r["text"])
    return [(lang, "\n".join(t)) for lang, t in sorted(parts.items())]


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).rlike(r"\p{L}")


class Alphabet:
    """Characters -> classes: 0 for what is rare, 1 for a word boundary
    (anything but letters and digits), 2 for digits, then letters."""

    def __init__(self, samples: list[str], size: int = ALPHABET):
        seen: dict[str, int] = {}
        for s in samples:
            for c in s.lower():
                if c.isalpha():
                    seen[c] = seen.get(c, 0) + 1
        letters = sorted(seen, key=lambda c: (-seen[c], c))[:size]
        self.size = 3 + len(letters)
        self.of = np.array([0 if chr(c).isalpha() else 2 if chr(c).isdigit() else 1 for c in range(0x110000)], np.uint8)
        for k, c in enumerate(letters):
            self.of[ord(c)] = 3 + k

    def classes(self, text: str) -> np.ndarray:
        """The text between two boundaries, runs of boundaries as one."""
        c = self.of[np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)]
        return c[np.concatenate(([True], (c[1:] != 1) | (c[:-1] != 1)))]


class Suffixes:
    """The suffix automaton of one language's sample as a parsing machine.

    ``step[state, class]`` follows the text as long as the phrase read so far
    occurs in the sample; where it does not, a new phrase begins at this
    class (``new`` is set). So a text's longest matches are read off in one
    pass without going back.
    """

    def __init__(self, classes: np.ndarray, size: int):
        nexts, link, length = [{}], [-1], [0]
        last = 0
        for c in classes.tolist():
            cur = len(nexts)
            nexts.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p != -1 and c not in nexts[p]:
                nexts[p][c] = cur
                p = link[p]
            if p != -1:
                q = nexts[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    twin = len(nexts)
                    nexts.append(dict(nexts[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p != -1 and nexts[p].get(c) == q:
                        nexts[p][c] = twin
                        p = link[p]
                    link[q] = link[cur] = twin
            last = cur
        step = np.full((len(nexts), size), -1, np.int32)
        for s, to in enumerate(nexts):
            step[s, list(to.keys())] = list(to.values())
        new = step < 0
        new[0] = True  # at the beginning, and after a class unseen in the sample
        root = np.maximum(step[0], 0)  # a class unseen in the sample is a phrase of its own
        step = np.where(step < 0, root[None, :], step)
        # one number per edge: target state, and in the lowest bit whether a phrase begins
        self.edges = (step * size << 1 | new).astype(np.int32).ravel()
        self.letters = len(classes)


class Parser:
    """Phrases per language for many texts at once."""

    def __init__(self, sample: list[tuple[str, str]], alphabet: int = ALPHABET, block: int = BLOCK):
        self.langs = [lang for lang, _ in sample]
        self.alphabet = Alphabet([t for _, t in sample], alphabet)
        coded = [self.alphabet.classes(t) for _, t in sample]
        self.machines = [Suffixes(c, self.alphabet.size) for c in coded]
        # a phrase found in a longer sample says less: it costs log(sample) symbols
        self.cost = np.array([math.log(max(m.letters, 2)) for m in self.machines])
        self.block = block

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Number of phrases of each text (rows) in each language (columns).

        Texts longer than a block are parsed block by block, each from a
        fresh phrase, and the counts added, so long texts cost no more per
        character and all blocks advance together, one class at a time.
        """
        out = np.zeros((len(texts), len(self.machines)), np.int64)
        blocks, owner = [], []
        for i, t in enumerate(texts):
            c = self.alphabet.classes(t)
            for k in range(0, len(c), self.block):
                blocks.append(c[k:k + self.block])
                owner.append(i)
        if not blocks or not self.machines:
            return out
        sizes = np.array([len(b) for b in blocks])
        order = np.argsort(-sizes, kind="stable")
        sizes, owner = sizes[order], np.array(owner)[order]
        grid = np.zeros((int(sizes[0]), len(order)), np.uint8)
        for col, k in enumerate(order.tolist()):
            grid[:sizes[col], col] = blocks[k]
        active = np.searchsorted(-sizes, -np.arange(1, len(grid) + 1), side="right")
        for m, machine in enumerate(self.machines):
            at, count = np.zeros(len(order), np.int32), np.zeros(len(order), np.int32)
            for row, n in enumerate(active.tolist()):
                edge = machine.edges.take(at[:n] + grid[row, :n])
                count[:n] += edge & 1
                np.right_shift(edge, 1, out=at[:n])
            np.add.at(out[:, m], owner, count)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text: the language that needs the
        fewest phrases, weighed by the log of its sample's length; of equal
        ones the first by name. The score is the share by which it beats the
        second, scaled to 0 ... 1 (1 if only one language is known)."""
        costs = self.phrases(texts) * self.cost
        langs, scores = [], []
        for t, c in zip(texts, costs, strict=True):
            if not any(map(str.isalpha, t)) or not self.langs:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            order = np.argsort(c, kind="stable")
            langs.append(self.langs[order[0]])
            scores.append(float(1 - c[order[0]] / c[order[1]]) if len(c) > 1 else 1.0)
        return langs, scores


    def rates(self, texts: list[str]) -> np.ndarray:
        """Phrases and symbols of each text, in the language that needs the
        fewest phrases."""
        least = self.phrases(texts).min(axis=1, initial=np.iinfo(np.int64).max)
        return np.column_stack([least, [len(self.alphabet.classes(t)) for t in texts]])


def phrase_bound(sample: list[tuple[str, str]], part: int = BLOCK) -> float:
    """Phrases per symbol up to which a text counts as one of a learned
    language: MARGIN times what the worst part of ``part`` characters of the
    sample's second halves needs of machines that know the first halves only
    (the whole sample's machines need fewer). Infinite without a sample."""
    halves = [(lang, t[:len(t) // 2], t[len(t) // 2:]) for lang, t in sample]
    parts = [b[k:k + part] for _, _, b in halves for k in range(0, len(b), part)]
    if not parts:
        return math.inf
    got = Parser([(lang, a) for lang, a, _ in halves]).rates(parts)
    return MARGIN * float((got[:, 0] / got[:, 1]).max())


def with_language(df: DataFrame, sample: list[tuple[str, str]], text_col: str = "text",
                  keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``told`` to every row (of the columns ``keep``): whether the
    text has a letter and needs at most :func:`phrase_bound` phrases per
    symbol, and SOME more, which a short text may need, in its best language.
    Without a sample a letter is enough."""
    model = df.sparkSession.sparkContext.broadcast((sample, phrase_bound(sample)))

    def make():
        sample, bound = model.value
        parser = _parser(sample)

        def run(texts):
            letter = np.array([any(map(str.isalpha, t)) for t in texts], bool)
            if parser.langs:
                phrases, symbols = parser.rates(texts).T
                letter &= phrases <= bound * symbols + SOME
            return [pa.array(letter)]
        return run

    return map_texts(df, text_col, [T.StructField("told", T.BooleanType())], make, keep)


def _parser(sample: list[tuple[str, str]]) -> Parser:
    """Built once per Python worker, not once per task, and kept until another operator runs there."""
    return held(("parser", hash(tuple(sample))), lambda: Parser(sample))


def predict_language(df: DataFrame, sample: list[tuple[str, str]], text_col: str = "text",
                     keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``lang_pred`` and ``score`` (0 to 1) to every row (of the
    columns ``keep``; default: all).

    ``sample`` comes from :func:`labelled_sample` and is broadcast (its bound
    holds whatever the input); each worker builds the automata once. Texts
    are parsed whole. NULL texts, and texts without a letter, are ``und``
    with score 0, as is every text when nothing was learned; equal texts get
    equal results. Input columns named like the results are replaced.
    """
    model = df.sparkSession.sparkContext.broadcast(sample)

    def make():
        parser = _parser(model.value)

        def run(texts):
            langs, scores = parser.predict(texts)
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
        return run

    return map_texts(df, text_col, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())],
                     make, keep)


def fold(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; 0 for a NULL id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(of)), F.lit(0))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 4) == 2
    sample = labelled_sample(docs.where(~held_out))
    out = predict_language(docs.withColumn("held_out", held_out), sample, keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score")
