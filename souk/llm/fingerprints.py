"""Document fingerprints by consistent weighted sampling (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk.llm.common import WHITE, materialise, query, table, text_or_empty

#: samples of a fingerprint, a multiple of GROUP; words are hashed to TERMS terms
SAMPLES, GROUP, TERMS = 32, 8, 65536
#: bits of a sample: the term and, above it, the low bits of its weight step
STEP_BITS = 4
#: ids that one task orders together, and blocks whose order one task finds
BLOCK, SPAN = 64, 65536


def _packed(k: int, log_weight: Column, terms: int) -> Column:
    """Sample k's value and (term, step) as one long that orders by value."""
    step = F.floor(log_weight / F.col(f"_r{k}") + F.col(f"_b{k}"))
    value = F.col(f"_c{k}") - F.col(f"_r{k}") * (step - F.col(f"_b{k}") + F.lit(1.0))
    rank = ((value + F.lit(1024.0)) * F.lit(2.0 ** 31)).cast("long")
    return rank * F.lit(terms << STEP_BITS) + step.bitwiseAND(F.lit((1 << STEP_BITS) - 1)) * F.lit(terms) + F.col("_term")


def term_samples(spark: SparkSession, samples: int = SAMPLES, terms: int = TERMS) -> DataFrame:
    """``_term, _group`` and, for each of the group's samples k, the random
    numbers that belong to (term, sample): ``_r`` and ``_c`` of Gamma(2, 1)
    (``_c`` as its logarithm), ``_b`` uniform in (0, 1), and ``_one``, the
    packed sample of a word that occurs once. A fixed table,
    whatever the corpus, made by hashing, the same on every run."""
    def uniform(k: int, j: int) -> Column:
        return (F.pmod(F.xxhash64(F.col("id"), F.lit(k), F.lit(j)), F.lit(2 ** 31)) + F.lit(0.5)) / F.lit(2.0 ** 31)

    cols = []
    for k in range(GROUP):
        gamma = lambda j, k=k: -F.log(uniform(k, j) * uniform(k, j + 1))
        cols += [gamma(0).cast("float").alias(f"_r{k}"), F.log(gamma(2)).cast("float").alias(f"_c{k}"),
                 uniform(k, 4).cast("float").alias(f"_b{k}")]
    groups = samples // GROUP
    d = spark.range(terms * groups).select(
        F.floor(F.col("id") / F.lit(groups)).cast("int").alias("_term"), F.pmod("id", F.lit(groups)).cast("int").alias("_group"), *cols)
    return d.select("*", *[_packed(k, F.lit(0.0), terms).alias(f"_one{k}") for k in range(GROUP)])


def sample_words(words: DataFrame, keys: list[str], samples: int = SAMPLES, terms: int = TERMS) -> DataFrame:
    """``keys..., _word`` (a row per word) -> ``keys..., _sample`` (array<int>).

    A term's weight w is its count. For sample k it gets the step ``t =
    floor(ln w / r + b)`` and the value ``ln a = ln c - r (t - b + 1)``; the
    sample is the (term, t) of the least value. Two weighted sets have equal
    samples with the probability of their generalised Jaccard similarity.
    Value and (term, t) are packed into one long, so a sample is a ``min``:
    nothing of a document but its samples is collected, and the aggregate is
    combined before any shuffle. The samples go through in groups of GROUP,
    a row each, which keeps the generated code small enough to be compiled.
    Most words of a text occur once; their samples are looked up.
    """
    counts = (words.groupBy(*keys, F.pmod(F.xxhash64("_word"), F.lit(terms)).cast("int").alias("_term"))
                   .agg(F.log(F.count(F.lit(1)).cast("double")).alias("_lw")))
    d = counts.join(F.broadcast(term_samples(words.sparkSession, samples, terms)), "_term")
    low = terms << STEP_BITS

    least = d.groupBy(*keys, "_group").agg(*[
        F.min(F.when(F.col("_lw") == 0, F.col(f"_one{k}")).otherwise(_packed(k, F.col("_lw"), terms))).alias(f"_m{k}") for k in range(GROUP)])
    part = F.array(*[F.pmod(F.col(f"_m{k}"), F.lit(low)).cast("int") for k in range(GROUP)])
    parts = least.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_group", part.alias("part")))).alias("_parts"))
    return parts.select(*keys, F.flatten(F.transform("_parts", lambda x: x["part"])).alias("_sample"))


def words_of(df: DataFrame, keys: list[str], text: Column) -> DataFrame:
    return df.select(*keys, F.explode(F.split(text, WHITE)).alias("_word")).where("_word <> ''")


def no_words(samples: int) -> Column:
    """The samples of a text without words: equal to each other only."""
    return F.array_repeat(F.lit(-1), samples)


def as_text(sample: Column) -> Column:
    """Five hex digits per sample; empty for a text without words."""
    return F.when(sample[0] < 0, F.lit("")).otherwise(
        F.lower(F.array_join(F.transform(sample, lambda x: F.lpad(F.hex(x), 5, "0")), "")))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples: the estimate of the generalised Jaccard similarity."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.size(a).cast("double")


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                samples: int = SAMPLES, terms: int = TERMS) -> DataFrame:
    """``id_col, fingerprint`` of every document, one row per id.

    Words are what stands between ASCII white space, weighed by their count
    and hashed to ``terms`` terms. NULL and empty texts have the empty
    fingerprint; equal texts have equal ones; rows that share an id (or have
    none) are one document whose words are counted together; an empty table
    gives an empty result; other columns are not read.
    """
    d = df.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    got = sample_words(words_of(d, [id_col], F.col("_text")), [id_col], samples, terms)
    got = got.select(F.col(id_col).alias("_id"), "_sample")
    out = d.select(id_col).distinct().join(got, F.col(id_col).eqNullSafe(F.col("_id")), "left")
    return out.select(id_col, as_text(F.coalesce("_sample", no_words(samples))).alias("fingerprint"))


def in_blocks(df: DataFrame, id_col: str, text_col: str, block: int = BLOCK) -> DataFrame:
    """``_block, _extra, _id, _text``: the rows by blocks of ids, each block
    with the row that follows its last one in descending order of ids as an
    extra row; the row after the smallest id is the one of the greatest.

    Only the greatest id of each block is needed elsewhere. Their order is
    found in spans of blocks, so no task orders all of them, and the texts of
    a few in ``block`` documents are read again. A NULL id counts as the
    smallest long.
    """
    d = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-2 ** 63)).alias("_id"), text_or_empty(text_col).alias("_text"))
    d = d.withColumn("_block", F.floor(F.col("_id") / F.lit(block)))
    tops = materialise(d.groupBy("_block").agg(F.max("_id").alias("_id")), "block-tops")
    tops = tops.withColumn("_span", F.floor(F.col("_block") / F.lit(SPAN)))
    spans = tops.groupBy("_span").agg(F.min("_block").alias("_first"))
    over = Window.orderBy("_span")
    spans = spans.select("_span", F.coalesce(F.lead("_first").over(over),
                                             F.min("_first").over(Window.partitionBy())).alias("_next"))
    above = F.lead("_block").over(Window.partitionBy("_span").orderBy("_block"))
    goes_to = (tops.withColumn("_above", above).join(spans, "_span")
                   .select("_id", F.coalesce("_above", "_next").alias("_to")))
    goes_to = materialise(goes_to, "block-neighbours")
    extra = d.join(goes_to, "_id").select(F.col("_to").alias("_block"), F.lit(True).alias("_extra"), "_id", "_text")
    return d.select("_block", F.lit(False).alias("_extra"), "_id", "_text").unionByName(extra)


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like
    the document's fingerprint is to the edited and to the next one's."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        samples: int = SAMPLES, terms: int = TERMS, block: int = BLOCK) -> DataFrame:
    """Each row with the fingerprints of its text and of its edited text: the
    last third replaced by the beginning of the next row's text, in
    descending order of ids.

    The texts are shuffled once, by block of ids; neighbours, words, samples
    and likenesses are then found inside the blocks. NULL ids count as the
    smallest and are returned as NULL; rows that share an id follow each
    other in the order of their texts; a table of one row is its own next;
    NULL text is empty.
    """
    rows = in_blocks(df, id_col, text_col, block)
    order = Window.partitionBy("_block").orderBy("_extra", F.col("_id").desc(), "_text")
    n, third = F.length("_text"), F.floor(F.length("_text") / F.lit(3)).cast("int")
    edited = F.concat(F.col("_text").substr(F.lit(1), n - third),
                      F.coalesce(F.col("_next"), F.lit("")).substr(F.lit(1), third))
    rows = (rows.withColumn("_pos", F.row_number().over(order)).withColumn("_next", F.lead("_text").over(order))
                .withColumn("_edited", F.when(~F.col("_extra"), edited)))
    keys = ["_block", "_pos", "_kind"]
    kinds = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("_text").alias("text")),
                             F.struct(F.lit(1).alias("kind"), F.col("_edited").alias("text")))).alias("_v")
    texts = rows.select("_block", "_pos", kinds).select("_block", "_pos", F.col("_v.kind").alias("_kind"), F.col("_v.text").alias("_t"))
    got = sample_words(words_of(texts, keys, F.col("_t")), keys, samples, terms)
    # rows of samples and rows of facts, united and not joined: a join would
    # filter one branch, and only equal branches share the shuffled texts
    facts = rows.select("_block", "_pos", "_extra", "_id", n.cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"))
    d = facts.unionByName(got, allowMissingColumns=True).repartition("_block").groupBy("_block", "_pos").agg(
        *[F.max(c).alias(c) for c in ("_extra", "_id", "n_chars", "edited_sha256")],
        *[F.max(F.when(F.col("_kind") == k, F.col("_sample"))).alias(name) for k, name in ((0, "_own"), (1, "_changed"))])
    d = (d.withColumn("_own", F.coalesce("_own", no_words(samples))).withColumn("_changed", F.coalesce("_changed", no_words(samples)))
          .withColumn("_after", F.lead("_own").over(Window.partitionBy("_block").orderBy("_pos"))))
    return d.where("NOT _extra").select(
        F.when(F.col("_id") != F.lit(-2 ** 63), F.col("_id")).alias(id_col), "n_chars", "edited_sha256",
        as_text(F.col("_own")).alias("fingerprint"), as_text(F.col("_changed")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_changed")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_after")).alias("near_next"))
