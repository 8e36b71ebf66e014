"""MinHash near-dedup with odd sketches."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.llm.common import map_texts, materialise, query, release, row_struct, table, text_or_empty
from souk.llm.graph import components

#: MinHash samples: BANDS bands of ROWS; at a similarity of 0.85 a pair
#: misses every band with probability (1 - 0.85^5)^32 < 1e-8, at 0.8 < 1e-5
BANDS, ROWS = 32, 5
#: bits of the odd sketch, and how far below the threshold its estimate may
#: lie before a pair is dropped unseen (over five standard deviations)
BITS, MARGIN = 256, 0.2
WORDS = 5
#: members that one tile of a bucket has, and shingles that a task remembers
TILE, HELD = 512, 4_000_000
#: rows of samples hashed at once; words remembered per worker at most
PIECE, KNOWN_WORDS = 8192, 1 << 17

_U64, _U32 = np.uint64, np.uint32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, xor, multiply by odd constants)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


class Words(dict):
    """Word -> 64-bit hash, with bounded memory."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


WORD_HASH = Words()


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles: A-Z in lower case, words
    between ASCII white space; a text of fewer words is one shingle."""
    found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only in both
    n = len(found)
    if not n:
        return np.empty(0, _U64)
    h = np.fromiter(map(WORD_HASH.__getitem__, found), _U64, n)
    k = min(n, words)
    acc = np.full(n - k + 1, k, _U64)
    with np.errstate(over="ignore"):
        for i in range(k):
            acc = (acc + h[i:n - k + 1 + i]) * _U64(0x9E3779B97F4A7C15)
            acc ^= acc >> _U64(32)
    return np.unique(mix(acc))


def _odd_numbers(n: int, seed: int, kind) -> np.ndarray:
    return np.random.RandomState(seed).randint(0, 2 ** 31, n).astype(kind) * kind(2) + kind(1)


MULTIPLY, ADD = _odd_numbers(BANDS * ROWS, 1, _U32), _odd_numbers(BANDS * ROWS, 2, _U32)


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """Samples of each (non-empty) set: the least value of each of the hash
    functions ``x * a + b`` (mod 2^32); pieces of a large set are combined."""
    out = np.full((BANDS * ROWS, len(sets)), 0xFFFFFFFF, _U32)
    x = (np.concatenate(sets) >> _U64(32)).astype(_U32)
    starts = np.cumsum([0, *map(len, sets)])
    with np.errstate(over="ignore"):
        for at in range(0, len(x), PIECE):
            piece = x[at:at + PIECE]
            first, last = np.searchsorted(starts, [at, at + len(piece) - 1], side="right") - 1
            cuts = np.maximum(starts[first:last + 1] - at, 0)
            part = out[:, first:last + 1]
            for i in range(len(out)):
                np.minimum(part[i], np.minimum.reduceat(piece * MULTIPLY[i] + ADD[i], cuts), out=part[i])
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per band and set; the band's number is part of it."""
    acc = np.repeat(np.arange(1, BANDS + 1, dtype=_U64)[:, None], samples.shape[1], 1)
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            acc = mix(acc * _U64(0x9E3779B97F4A7C15) + samples[r::ROWS])
    return acc


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples: every (function, value) flips one bit."""
    k, n = samples.shape
    with np.errstate(over="ignore"):
        bit = mix(samples.astype(_U64) + (np.arange(1, k + 1, dtype=_U64) << _U64(32))[:, None]) & _U64(BITS - 1)
    flat = (bit.astype(np.int64) + np.arange(n)[None, :] * BITS).ravel()
    odd = (np.bincount(flat, minlength=n * BITS) & 1).astype(np.uint8).reshape(n, BITS)
    return np.packbits(odd, axis=1).view(_U64)


def most_bits(similarity: float) -> int:
    """XOR bits that two odd sketches of this similarity have on average:
    ``2 k (1 - J)`` samples differ, each flips one of BITS bits."""
    flips = 2 * BANDS * ROWS * (1 - similarity)
    return math.ceil(BITS / 2 * (1 - (1 - 2 / BITS) ** flips))


def _longs(name: str, n: int) -> list[T.StructField]:
    return [T.StructField(f"{name}{i}", T.LongType()) for i in range(n)]


ODD = [f"odd{i}" for i in range(BITS // 64)]


def _int64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def signatures(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, n_shingles, set0, set1`` (a 128-bit digest of the set), ``bands``
    (array<long>) and the odd sketch's longs, one row per row of ``df``."""
    def make():
        release()

        def run(texts):
            sets = [shingles(t) for t in texts]
            n = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            keys, odd = np.zeros((len(sets), BANDS), _U64), np.zeros((len(sets), len(ODD)), _U64)
            digest = np.zeros((len(sets), 2), _U64)
            if len(full):
                samples = minhash([sets[i] for i in full])
                keys[full], odd[full] = band_keys(samples).T, odd_sketch(samples)
                for i in full:
                    with np.errstate(over="ignore"):
                        digest[i] = mix(sets[i] + _U64(1)).sum(), mix(sets[i] * _U64(3)).sum()
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), _int64(keys.ravel()))
            return [pa.array(n), _int64(digest[:, 0]), _int64(digest[:, 1]), bands, *[_int64(odd[:, i]) for i in range(len(ODD))]]
        return run

    fields = [T.StructField("n_shingles", T.LongType()), *_longs("set", 2),
              T.StructField("bands", T.ArrayType(T.LongType())), *_longs("odd", len(ODD))]
    return map_texts(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", fields, make, ["id"])


def verify(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets are similar enough:
    ``100 * intersection >= percent * union``. ``texts``: ``id, text``."""
    d = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
              .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"))

    def run(batches):
        text, held = None, None  # rows come sorted by b: its set is made once
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256).to_pydict()
                keep_a, keep_b = [], []
                for a, b, ta, tb in zip(part["a"], part["b"], part["text_a"], part["text_b"], strict=True):
                    if tb != text:
                        text, held = tb, shingles(tb)
                    mine = shingles(ta)
                    both = len(np.intersect1d(mine, held, assume_unique=True))
                    if 100 * both >= percent * (len(mine) + len(held) - both):
                        keep_a.append(a)
                        keep_b.append(b)
                yield pa.RecordBatch.from_arrays([pa.array(keep_a, pa.int64()), pa.array(keep_b, pa.int64())], names=["a", "b"])

    return d.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def _near(odd_a: str, odd_b: str, bits: int):
    xor = [F.bit_count(F.col(f"{odd_a}.{o}").bitwiseXOR(F.col(f"{odd_b}.{o}"))) for o in ODD]
    return sum(xor[1:], xor[0]) <= bits


def _tiles(members: DataFrame, tile: int) -> DataFrame:
    """The members of each bucket, cut into tiles of about ``tile`` members;
    each pair of tiles ``lo <= hi`` is a group of its own."""
    tiles = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    d = (members.withColumn("t", F.pmod(F.xxhash64("id"), tiles).cast("int"))
                .withColumn("o", F.explode(F.sequence(F.lit(0), tiles - 1))))
    return d.select("bucket", F.least("t", "o").alias("lo"), F.greatest("t", "o").alias("hi"), "t", "id", "comp", "bands", *ODD)


def _by_group(batches):
    """Rows that come sorted by (bucket, lo, hi) -> one table per group; only
    the group that a batch breaks off is kept over."""
    held = None
    for batch in batches:
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        key = [held.column(c).to_numpy() for c in ("bucket", "lo", "hi")]
        cuts = [0, *(np.flatnonzero(sum(np.diff(k) != 0 for k in key)) + 1).tolist()]
        for s, e in zip(cuts, cuts[1:], strict=False):
            yield held.slice(s, e - s)
        held = held.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held


def tile_candidates(g: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers ``(a, b)`` and differing bits of the pairs of a group that
    are of different components, whose odd sketches differ in at most ``bits``
    bits, and of whose common buckets this is the first (so every pair of
    documents is looked at once, not once per band)."""
    col = {c: g.column(c).to_numpy() for c in ("t", "comp", *ODD)}
    left, right = np.flatnonzero(col["t"] == g.column("lo")[0].as_py()), np.flatnonzero(col["t"] == g.column("hi")[0].as_py())
    same = g.column("lo")[0].as_py() == g.column("hi")[0].as_py()
    odd = np.stack([col[o] for o in ODD], 1).view(_U64)
    bands = g.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    bucket, found = g.column("bucket")[0].as_py(), []
    for at in range(0, len(left), 256):
        rows = left[at:at + 256]
        apart = sum(np.bitwise_count(odd[rows, None, k] ^ odd[None, right, k]).astype(np.int32) for k in range(len(ODD)))
        near = (apart <= bits) & (col["comp"][rows][:, None] != col["comp"][right][None, :])
        if same:
            near &= rows[:, None] < right[None, :]
        a, b = np.nonzero(near)
        apart, a, b = apart[a, b], rows[a], right[b]
        for cut in range(0, len(a), 100_000):
            x, y, z = a[cut:cut + 100_000], b[cut:cut + 100_000], apart[cut:cut + 100_000]
            here = bands[x, (bands[x] == bands[y]).argmax(1)] == bucket
            found.append((x[here], y[here], z[here]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def tile_links(members: DataFrame, texts: DataFrame, bits: int, percent: int, tile: int = TILE) -> DataFrame:
    """Links ``(a, b)`` that join the components of documents sharing a bucket.

    ``members``: ``bucket, n`` (its size), ``id, comp, bands``, sketch. First
    the tiles are compared by sketches alone, and only the rows that are part
    of some candidate pair go on, so what leaves a tile grows with its rows,
    not with its pairs. Those rows then get their texts, and the candidates of
    a tile, the likeliest first, are confirmed on full sets; a pair whose
    components the tile has already joined needs no look. No task holds more
    than two tiles of a bucket.
    """
    schema = _tiles(members, tile).schema

    def candidates(batches):
        for g in _by_group(batches):
            a, b, _ = tile_candidates(g, bits)
            if len(a):
                yield from g.take(pa.array(np.unique(np.concatenate([a, b])))).to_batches()

    def confirm(batches):
        for g in _by_group(batches):
            a, b, apart = tile_candidates(g, bits)
            up, known, out = {}, {}, []
            comp, ids, text = g.column("comp").to_pylist(), g.column("id").to_pylist(), g.column("text")

            def find(x, up=up):
                while up.get(x, x) != x:
                    x = up[x]
                return x

            def full(i, known=known, text=text):
                if i not in known:
                    if sum(map(len, known.values())) > HELD:
                        known.clear()
                    known[i] = shingles(text[i].as_py())
                return known[i]

            for k in np.argsort(apart, kind="stable").tolist():
                x, y = int(a[k]), int(b[k])
                if (p := find(comp[x])) == (q := find(comp[y])):
                    continue
                mine, other = full(x), full(y)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                if 100 * both >= percent * (len(mine) + len(other) - both):
                    up[max(p, q)] = min(p, q)
                    out.append((ids[x], ids[y]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out, strict=True)], names=["a", "b"])

    order = ["bucket", "lo", "hi"]
    some = _tiles(members, tile).repartition(*order).sortWithinPartitions(*order).mapInArrow(candidates, schema)
    some = materialise(some, "tile-members").join(texts, "id").select(*schema.names, "text")
    return some.repartition(*order).sortWithinPartitions(*order).mapInArrow(confirm, "a long, b long").distinct()


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """Near-duplicate components of documents with integer ids.

    Documents are linked when ``100 * intersection >= percent * union`` of
    their sets of five-word shingles (see :func:`shingles`).

    1. One pass over the texts makes each document's MinHash samples, their
       band keys and the odd sketch: every sample flips one bit of a bitmap,
       so the XOR of two bitmaps counts the samples in which they differ.
    2. Documents with equal sets form a class; its smallest id stands for
       it. Copies meet again only at the end, whatever their number.
    3. Members of a band's bucket are compared with one pivot, the member
       that shares the most buckets (the original of edited copies shares
       all of theirs). Odd sketches drop the dissimilar, the rest is
       confirmed on full sets, and the confirmed links make components.
    4. Buckets whose members now all lie in one component can add nothing.
       In the others all members of different components are compared by
       their odd sketches, tile by tile (:func:`tile_links`), and confirmed
       as before. So apart from the (tiny) chance that a pair shares no band
       no link between different texts is lost, yet a large group of copies
       is never expanded into its pairs.

    Returns one row per row: ``id_col``, ``n_shingles`` (long),
    ``component_id`` (smallest id reachable), ``kept`` (is it its own).
    NULL, empty and white texts have no shingle and no link. Rows with a NULL
    id cannot be named: ``component_id`` is NULL and they are kept. Rows
    sharing an id are one document with several texts: it has the links of
    all of them. An empty table gives an empty result; other columns are not
    read.
    """
    bits = most_bits(percent / 100 - MARGIN)
    source = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    sig = materialise(signatures(source, "id", "text"), "signatures")
    able = sig.where("n_shingles > 0 AND id IS NOT NULL")
    classes = materialise(able.groupBy("set0", "set1").agg(F.min("id").alias("rep")), "classes")
    reps = able.join(classes, ["set0", "set1"]).where("id = rep")
    reps = materialise(reps.select("id", "bands", *ODD), "representatives")

    # buckets with at least two classes
    all_buckets = reps.select("id", F.explode("bands").alias("bucket"))
    sizes = (all_buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))
                        .where("lo < hi").select("bucket", "n"))
    # tables of their own: the joins below are then plain joins of two
    # exchanges, whose hot buckets adaptive execution can split
    sizes = materialise(sizes, "bucket-sizes")
    shared = materialise(all_buckets.join(sizes, "bucket"), "buckets")
    shares = shared.groupBy("id").agg(F.sum("n").alias("shares"))
    shares = materialise(shares, "shares")
    texts = materialise(source.join(shares.select("id"), "id", "left_semi"), "candidate-texts")
    odd = reps.join(shares.select("id"), "id", "left_semi")
    odd = materialise(odd.select("id", "bands", *ODD), "sketches")

    # the pivot of each bucket against its members
    pivots = shared.join(shares, "id").groupBy("bucket").agg(F.max_by("id", "shares").alias("b"))
    pivots = materialise(pivots, "pivots")
    pairs = shared.join(pivots, "bucket").where("id <> b").select(F.col("id").alias("a"), "b").distinct()
    sketch = lambda name: odd.select(F.col("id").alias(name), F.struct(*ODD).alias(f"odd_{name}"))
    pairs = pairs.join(sketch("a"), "a").join(sketch("b"), "b").where(_near("odd_a", "odd_b", bits)).select("a", "b")
    first = components(verify(pairs, texts, percent))

    # the buckets that this has not settled
    joined = shared.join(first.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("label", "id"))
    joined = materialise(joined.select("bucket", "n", "id", "comp"), "members")
    open_ = joined.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("bucket")
    open_ = materialise(open_, "open-buckets")
    rest = joined.join(open_, "bucket").join(odd, "id")
    links = tile_links(rest, texts, bits, percent)
    comp = lambda name: first.select(F.col("node").alias(name), F.col("label").alias(f"comp_{name}"))
    links = (links.join(comp("a"), "a", "left").join(comp("b"), "b", "left")
                  .select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b")))
    second = components(links)

    # back to all documents
    named = materialise(classes.join(first.withColumnRenamed("node", "rep").withColumnRenamed("label", "c1"), "rep", "left")
                    .withColumn("c1", F.coalesce("c1", "rep"))
                    .join(second.withColumnRenamed("node", "c1").withColumnRenamed("label", "c2"), "c1", "left")
                    .select("set0", "set1", F.coalesce("c2", "c1").alias("component")), "named")
    # documents without shingles have digests of 0: spread them, they have no class
    out = sig.select("id", "n_shingles", "set0", F.when(F.col("n_shingles") > 0, F.col("set1")).otherwise(F.col("id")).alias("set1"))
    out = out.join(named, ["set0", "set1"], "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("id").isNotNull(), F.col("component"))).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """``df`` with one document of each component, all its columns as they
    are, whatever their names. Rows without id, text or words stay; of rows
    that share an id either all stay or none; the smallest id of a component
    stays; an empty table gives an empty result."""
    gone = near_dedup(df, id_col, text_col, percent).where("NOT kept").select(F.col(id_col).alias("_gone")).distinct()
    d = df.select(row_struct(df), F.col(id_col).cast("long").alias("_i"))
    return d.join(gone, F.col("_i") == F.col("_gone"), "left_anti").select("_row.*")


@query("op10_near_dedup")
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at 85 of 100."""
    return near_dedup(table(spark, sf_dir, "documents"), percent=85)
