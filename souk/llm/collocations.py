"""Phrase collocation mining over sorted count streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from souk.llm.common import importable, materialise, query, table, text_or_empty

#: marks that end a piece of text
PIECE_MARKS = r"[.,;:!?\x0A-\x0D]"
#: longest phrase, least occurrences of a candidate, percent of a candidate's
#: occurrences that one longer candidate has to cover to replace it, report
WORDS, LEAST, COVERED, TOP = 4, 30, 80, 2000
SCALE = 2_000_000
#: bytes of text counted at once in a task
BLOCK = 4 << 20
#: sub-groups that pick their own best before a group's are picked
SALTS = 64

_FOLD = bytes(10 if chr(i) in ".,;:!?\n\x0b\x0c\r" else 32 if i == 9 else i + 32 if 65 <= i <= 90 else i for i in range(256))

NOTHING, SPACE = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
COUNT_SCHEMA = "lang string, phrase string, n long"


def blocks(texts: list[str]) -> Iterator[bytes]:
    """Folded text (A-Z in lower case, piece marks as line feeds, tabs as
    spaces) of about BLOCK bytes, cut only between pieces."""
    held, size = [], 0
    for t in texts:
        b = t.encode().translate(_FOLD)
        while len(b) > BLOCK and (cut := b.find(b"\n", BLOCK)) >= 0:
            yield b[:cut]
            b = b[cut:]
        if held and size + len(b) > BLOCK:
            yield b"\n".join(held)
            held, size = [], 0
        held.append(b)
        size += len(b)
    if held:
        yield b"\n".join(held)


def count_windows(block: bytes, words: int) -> tuple[pa.Array, np.ndarray]:
    """The distinct windows of a block in order, and how often each occurs.

    A window starts at every word and takes up to ``words`` words of its
    piece; a space follows each word, so windows that share their first
    words share that prefix and nothing else does.
    """
    tokens = pc.split_pattern(pa.array([block.replace(b"\n", b" \n ")], pa.large_binary()).cast(pa.large_string()), " ").flatten().dictionary_encode()
    names = tokens.dictionary
    order = pc.sort_indices(names).to_numpy()
    sorted_names = names.take(pa.array(order))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    at = tokens.indices.to_numpy()
    none, stop = pc.index(names, "").as_py(), pc.index(names, "\n").as_py()
    ids = rank[at[at != none]]
    if stop >= 0:
        ids[ids == rank[stop]] = 0
    padded = np.concatenate([ids, np.zeros(words, dtype=np.int64)])
    width, column = len(order) + 1, [ids]
    for k in range(1, words):
        column.append(np.where(column[-1] > 0, padded[k:k + len(ids)], 0))
    begins = np.flatnonzero(ids)
    column = [c[begins] for c in column]
    key = column[0]
    for c in column[1:]:
        if len(key) and int(key.max()) > (1 << 62) // width:
            key = np.unique(key, return_inverse=True)[1]
        key = key * width + c
    _, where, n = np.unique(key, return_index=True, return_counts=True)
    spelled = pa.concat_arrays([pa.array([""], pa.large_string()), pc.binary_join_element_wise(sorted_names, NOTHING, SPACE)])
    parts = [spelled.take(pa.array(c[where])) for c in column]
    return pc.binary_join_element_wise(*parts, NOTHING), n


def window_counts(df: DataFrame, text_col: str, group_col: str, words: int = WORDS) -> DataFrame:
    """``lang, phrase, n``: partial counts of the windows of whole texts, one
    row per window, block of text and group; NULL text has none."""
    importable(df.sparkSession)
    d = df.select(F.coalesce(F.col(group_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                texts = batch.column(1).filter(pa.array(langs == lang)).to_pylist()
                for block in blocks(texts):
                    phrases, n = count_windows(block, words)
                    for i in range(0, len(n), 65536):
                        part = phrases[i:i + 65536].cast(pa.string())
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), part, pa.array(n[i:i + 65536], pa.int64())], names=["lang", "phrase", "n"])

    return d.mapInArrow(run, COUNT_SCHEMA)


class PrefixScan:
    """Counts of all prefixes in one walk over a stream of windows in prefix
    order. Equal prefixes lie side by side, so per length only the running
    count of the open prefix is held.

    A prefix that is over before the stream's end and began after its start
    is counted whole: it is given out only if it has ``least`` occurrences.
    The others may go on in a neighbouring stream and are given out as parts.
    """

    def __init__(self, words: int, least: int):
        self.least, self.open, self.fresh = least, [None] * (words + 1), True

    def feed(self, lang: pa.Array, phrase: pa.Array, n: np.ndarray) -> list[tuple]:
        rows = len(n)
        out = []
        if not rows:
            return out
        parts = pc.split_pattern(phrase, " ")
        words, at = parts.flatten(), parts.offsets.to_numpy()
        length = np.diff(at) - 1
        spell = [np.array([""] * rows, dtype=object)]
        changed = self._differs(lang)
        for d in range(len(self.open)):
            if d:
                word = words.take(pa.array(at[:-1] + np.minimum(d - 1, length)))
                changed = changed | self._differs(word)
                spell.append(word)
            has = np.flatnonzero(length >= d)
            if not len(has):
                continue
            begin = changed[has].copy()
            begin[0] = True
            starts = np.flatnonzero(begin)
            sums, first = np.add.reduceat(n[has], starts), has[starts]
            self._close(d, first, sums, lang, spell, out)
        self.fresh = False
        return out

    @staticmethod
    def _differs(column: pa.Array) -> np.ndarray:
        d = np.ones(len(column), dtype=bool)
        if len(column) > 1:
            d[1:] = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        return d

    def _close(self, d, first, sums, lang, spell, out):
        def name(i):
            i = int(first[i])
            return lang[i].as_py(), "".join(f"{w[i].as_py()} " for w in spell[1:d + 1])

        head = name(0)
        partial = self.fresh and int(first[0]) == 0
        held = self.open[d]
        if held and held[0] == head:
            sums[0] += held[1]
            partial = held[2]
        elif held and (held[2] or held[1] >= self.least):
            out.append((*held[0], d, held[1]))
        for i in np.flatnonzero(sums[:-1] >= self.least) if len(sums) > 1 else ():
            if i or not partial:
                out.append((*name(i), d, int(sums[i])))
        if len(sums) > 1 and partial:
            out.append((*head, d, int(sums[0])))
        self.open[d] = (name(-1), int(sums[-1]), partial and len(sums) == 1)

    def end(self) -> list[tuple]:
        return [(*x[0], d, x[1]) for d, x in enumerate(self.open) if x]


def phrase_counts(df: DataFrame, text_col: str = "text", group_col: str = "lang",
                  words: int = WORDS, least: int = LEAST) -> DataFrame:
    """``lang, phrase, words, f`` of all phrases of up to ``words`` words with
    at least ``least`` occurrences, and per group a row of 0 words whose ``f``
    counts all word occurrences.

    The windows are dealt out by ranges of equal size in prefix order and
    sorted, so no phrase or group, however frequent, has to be in one task,
    and each range is walked once with a state of one prefix per length. Only
    frequent phrases and the few that lie across a range's ends leave it.
    """
    counted = window_counts(df, text_col, group_col, words)
    stream = counted.repartitionByRange("lang", "phrase").sortWithinPartitions("lang", "phrase")

    def run(batches):
        scan = PrefixScan(words, least)

        def out(rows):
            return pa.RecordBatch.from_pylist(
                [dict(zip(("lang", "phrase", "words", "f"), r, strict=True)) for r in rows],
                schema=pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())]))

        for b in batches:
            yield out(scan.feed(b.column(0), b.column(1), b.column(2).to_numpy()))
        yield out(scan.end())

    parts = stream.mapInArrow(run, "lang string, phrase string, words int, f long")
    return (parts.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
                 .where((F.col("words") == 0) | (F.col("f") >= least))
                 .withColumn("phrase", F.rtrim("phrase")))


def cuts(counts: DataFrame) -> DataFrame:
    """``lang, phrase, a, k, first, rest``: every candidate cut after each of
    its first k words."""
    w = F.split("phrase", " ")
    d = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), w.alias("w"))
    d = d.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    return d.select("lang", "phrase", "a", "words", "k", F.concat_ws(" ", F.slice("w", 1, F.col("k"))).alias("first"),
                    F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("words") - F.col("k"))).alias("rest"))


def collocations(df: DataFrame, text_col: str = "text", group_col: str = "lang", words: int = WORDS,
                 least: int = LEAST, covered: int = COVERED, top: int | None = None) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the phrases that no longer
    phrase stands for; with ``top`` only the first ones of each group, with
    their ``rank``.

    The counts are kept as streams and merged in lockstep by sort-merge
    joins: candidates by what stands before each cut (prefix order) with the
    counts, then by what stands behind it (suffix order). Both parts of a
    frequent phrase are frequent, so the streams hold every count that is
    asked for, and a hot word is on many rows of the candidates' side only,
    which adaptive execution splits. A phrase inside a longer candidate lies
    inside one that is a word longer and at least as frequent, so the largest
    count among the phrases with one word more in front or behind decides.

    Ties of cuts go to the smallest k after flooring; the arithmetic is
    exact. NULL or empty texts and texts without words add nothing, a NULL
    group is 'und', repeated rows count again, an empty table gives no rows;
    other columns are not looked at.
    """
    # not cleaned of the tables' own names: all columns are made here
    counts = materialise(phrase_counts(df, text_col, group_col, words, least), "phrase-counts")
    total = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    known = counts.where("words > 0").select("lang", "phrase", "f")
    cut = cuts(counts)
    prefix, suffix = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cut.join(prefix.hint("merge"), ["lang", "first"]).join(suffix.hint("merge"), ["lang", "rest"])
    both = both.withColumn("score", F.expr(f"cast(a as decimal(20, 0)) * {SCALE} div (cast(l as decimal(20, 0)) + r)"))
    rank = F.col("score") * words + F.col("k")  # the lowest score, then the smallest k
    best = both.groupBy("lang", "phrase", "a").agg(F.min_by("l", rank).alias("l"), F.min_by("r", rank).alias("r"), F.min("score").alias("score"))
    front = cut.where("k = 1 and words > 2").select("lang", F.col("rest").alias("phrase"), "a")
    behind = cut.where("k = words - 1 and words > 2").select("lang", F.col("first").alias("phrase"), "a")
    longer = front.unionByName(behind).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = (best.join(longer.hint("merge"), ["lang", "phrase"], "left")
                .where(F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(20, 0)") < covered * F.col("a").cast("decimal(20, 0)"))))
    cols = ["lang", "phrase", "a", "l", "r", "n", "score"]
    # the groups' totals come last: a join by group alone is kept to the rows asked for
    return left.join(total, "lang").select(*cols) if top is None else best_of_groups(left, top).join(total, "lang").select(*cols, "rank")


def best_of_groups(df: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` rows of each ``lang`` by score and count, largest
    first, and phrase, with their rank. Sub-groups pick theirs first, so no
    task sorts a whole group."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    d = df.withColumn("salt", salt)
    d = d.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    d = d.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return d.drop("salt")


OP12_SQL = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
p AS (SELECT lang, unnest(string_split_regex(body, '{PIECE_MARKS}')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, ws[i:i + 3] AS ws FROM i),
h AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS k FROM g),
f AS (SELECT lang, array_to_string(ws[1:k], ' ') AS phrase, k, count(*) AS f FROM h GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, string_split(phrase, ' ') AS ws, k, f AS a FROM f WHERE k > 1 AND f >= {LEAST}),
j AS (SELECT *, unnest(range(1, k)) AS j FROM c),
cut AS (SELECT lang, phrase, a, j, array_to_string(ws[1:j], ' ') AS head, array_to_string(ws[j + 1:k], ' ') AS rest FROM j),
scored AS (SELECT cut.*, l.f AS l, r.f AS r, ({SCALE}::HUGEINT * a) // (l.f + r.f) AS score
           FROM cut JOIN f AS l ON l.lang = cut.lang AND l.phrase = head JOIN f AS r ON r.lang = cut.lang AND r.phrase = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ends AS (SELECT lang, ws, k, a, unnest(range(1, k)) AS s FROM c),
parts AS (SELECT lang, ws, k, a, s, unnest(range(2, k)) AS m FROM ends),
sub AS (SELECT lang, array_to_string(ws[s:s + m - 1], ' ') AS phrase, max(a) AS longer FROM parts WHERE s + m - 1 <= k GROUP BY 1, 2),
kept AS (SELECT best.* FROM best LEFT JOIN sub ON best.lang = sub.lang AND best.phrase = sub.phrase
         WHERE sub.longer IS NULL OR 100 * sub.longer < {COVERED} * best.a),
ranked AS (SELECT kept.lang, phrase, a, l, r, n, score,
             row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank
           FROM kept JOIN n ON kept.lang = n.lang)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {TOP}
"""


@query("op12_collocations", OP12_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language."""
    out = collocations(table(spark, sf_dir, "documents"), top=TOP)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
