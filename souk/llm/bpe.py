"""BPE encoding and decoding as streaming transducers with bounded memory."""

from __future__ import annotations

import codecs
import heapq
import json
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.llm.common import map_texts, query, table

#: fixed values: the byte-level pre-tokeniser's pattern and the alternatives
#: of it that a run without end belongs to
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
RUNS = {"letters": r"\p{L}+", "digits": r"\p{N}+", "space": r"\p{White_Space}+", "other": r"[^\p{White_Space}\p{L}\p{N}]+"}
#: characters fed at once; a longer run of one kind is encoded while it arrives
CHUNK = 65536
#: pieces up to so many characters are remembered, so many at most
CACHED_CHARS, CACHE = 64, 200_000


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary:
    itself if it is printable and not a space, else the next free one from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    names = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return names | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """A merge list: token bytes, pair -> (rank, merged token), lookahead."""

    def __init__(self, spec: str):
        names, d = byte_names(), json.loads(spec)
        vocab = d["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.bytes_of = {i: bytes(names[c] for c in t) for t, i in vocab.items() if t not in self.special}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.spelled = pa.array([self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)], pa.binary())
        self.byte_ids = [vocab[c] for c, _ in sorted(names.items(), key=lambda x: x[1])]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(d["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.pairs[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.lookahead = self._lookahead()
        self.longest = max(map(len, self.bytes_of.values()))

    def _lookahead(self) -> int:
        """Bytes of right context after which a token boundary is final.

        Apply the merges in rank order to a text and to the same text with
        more behind it. Both agree up to some frontier, at first the end of
        the shorter one. A merge (u, v) moves the frontier left over u, if v
        starts at the frontier in one of them only. If an earlier merge (u',
        v') had moved it there, the token now at the frontier has grown out
        of u', so u' lies on v's chain of left halves. The sum of such steps
        along the worst chain of rising ranks is the sufficient lookahead.
        """
        made: dict[int, tuple[int, int]] = {}  # token -> (rank, left half)
        moved: dict[int, int] = {}             # u -> furthest move ending with u
        worst = 0
        for (u, v), (rank, t) in sorted(self.pairs.items(), key=lambda x: x[1][0]):
            if t in made or any(len(self.bytes_of[x]) > 1 and x not in made for x in (u, v)):
                raise ValueError("a merge list must make each token once and before its use")
            made[t] = (rank, u)
            at, before = v, 0
            while True:
                before = max(before, moved.get(at, 0))
                if at not in made:
                    break
                at = made[at][1]
            move = len(self.bytes_of[u]) + before
            moved[u] = max(moved.get(u, 0), move)
            worst = max(worst, move)
        return worst

    def merge(self, data: bytes) -> list[int]:
        """Tokens of one whole piece: the lowest rank first, leftmost first."""
        ids: list = [self.byte_ids[b] for b in data]
        n, pairs = len(ids), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(p[0], i, p[1], ids[i], ids[i + 1]) for i in range(n - 1) if (p := pairs.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, t, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = t, None, after[j]
            if after[i] < n:
                before[after[i]] = i
                if p := pairs.get((t, ids[after[i]])):
                    heapq.heappush(heap, (p[0], i, p[1], t, ids[after[i]]))
            if (h := before[i]) >= 0 and (p := pairs.get((ids[h], t))):
                heapq.heappush(heap, (p[0], h, p[1], ids[h], t))
        return [t for t in ids if t is not None]


class Piece:
    """The transducer for one pre-token of any length: tokens that end at
    least ``lookahead`` bytes before what has arrived are final. They are
    emitted, and merging starts again behind them, since no later merge can
    cross a final boundary. Holds at most one window of bytes."""

    def __init__(self, merges: Merges):
        self.m, self.held = merges, b""
        self.window = 4 * merges.lookahead + 2 * merges.longest

    def feed(self, data: bytes) -> Iterator[int]:
        at = 0
        while at < len(data):
            step = self.window - len(self.held)
            self.held += data[at:at + step]
            at += step
            if len(self.held) >= self.window:
                yield from self._stable()

    def _stable(self) -> Iterator[int]:
        end = 0
        for t in self.m.merge(self.held):
            if end + len(self.m.bytes_of[t]) > len(self.held) - self.m.lookahead:
                break
            end += len(self.m.bytes_of[t])
            yield t
        self.held = self.held[end:]

    def finish(self) -> list[int]:
        rest, self.held = self.m.merge(self.held), b""
        return rest


class Remembered(dict):
    """Piece of text -> its tokens, with bounded memory."""

    def __init__(self, merges: Merges):
        self.m = merges

    def __missing__(self, piece: str):
        if len(piece) > CACHED_CHARS:
            p = Piece(self.m)
            return [*p.feed(piece.encode()), *p.finish()]
        if len(self) >= CACHE:
            self.clear()
        self[piece] = ids = tuple(self.m.merge(piece.encode()))
        return ids


class Encoder:
    """Text in chunks -> token ids as soon as they are final."""

    find = regex.compile(PATTERN).findall
    runs = {k: regex.compile(p) for k, p in RUNS.items()}

    def __init__(self, merges: Merges, remembered: Remembered | None = None):
        self.m, self.known = merges, remembered if remembered is not None else Remembered(merges)
        self.tail, self.open, self.piece = "", None, Piece(merges)
        self.marks = regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True))) or r"(?!)")

    def feed(self, text: str) -> Iterator[Iterable[int]]:
        text, at = self.tail + text, 0
        for mark in self.marks.finditer(text):
            yield from self._segment(text[at:mark.start()], True)
            yield (self.m.special[mark.group()],)
            at = mark.end()
        # a special token may have begun at the end
        hold = next((k for s in self.m.special for k in range(min(len(s) - 1, len(text) - at), 0, -1)
                     if text.endswith(s[:k])), 0)
        self.tail = ""
        yield from self._segment(text[at:len(text) - hold], False)
        self.tail += text[len(text) - hold:]

    def finish(self) -> Iterator[Iterable[int]]:
        text, self.tail = self.tail, ""
        yield from self._segment(text, True)

    def _segment(self, text: str, last: bool) -> Iterator[Iterable[int]]:
        if self.open:
            run = self.runs[self.open].match(text)
            end = run.end() if run else 0
            goes_on = end == len(text) and not last
            if self.open == "space" and (goes_on or end < len(text)):
                end = max(0, end - 1)  # the last space may belong to what follows
            yield self.piece.feed(text[:end].encode())
            text = text[end:]
            if goes_on:
                self.tail = text
                return
            yield self.piece.finish()
            self.open = None
        pieces = self.find(text)
        unsure: list[str] = []
        while pieces and not last and sum(map(len, unsure)) < 3:
            unsure.append(pieces.pop())
        yield chain.from_iterable(map(self.known.__getitem__, pieces))
        if len(unsure) == 1 and len(unsure[0]) >= CHUNK // 2:  # one run fills the chunk
            run = unsure.pop()
            self.open = next(k for k, p in self.runs.items() if p.fullmatch(run[-1]))
            end = len(run) - (self.open == "space")
            yield self.piece.feed(run[:end].encode())
            unsure = [run[end:]]
        self.tail = "".join(reversed(unsure))


class Decoder:
    """Token ids in chunks -> text, by an incremental UTF-8 state machine;
    bytes that are not UTF-8 become U+FFFD."""

    def __init__(self, merges: Merges):
        self.spelled = merges.spelled
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        # the tokens' bytes, taken from the vocabulary's one blob, lie end to end
        _, ends, blob = self.spelled.take(pa.array(ids, pa.int32())).buffers()
        return self.machine.decode(blob[:int(np.frombuffer(ends, np.int32)[len(ids)])] if len(ids) else b"")

    def finish(self) -> str:
        return self.machine.decode(b"", True)


def encode_ids(merges: Merges, text: str, known: Remembered | None = None, chunk: int = CHUNK) -> np.ndarray:
    e = Encoder(merges, known)
    parts = (p for i in range(0, len(text), chunk) for p in e.feed(text[i:i + chunk]))
    return np.fromiter(chain.from_iterable(chain(parts, *[e.finish()])), np.int32)


def decode_ids(merges: Merges, ids: np.ndarray, chunk: int = CHUNK) -> str:
    d = Decoder(merges)
    return "".join([*(d.feed(ids[i:i + chunk]) for i in range(0, len(ids), chunk)), d.finish()])


_LOADED: dict[int, tuple[Merges, Remembered]] = {}


def _loaded(spec: str) -> tuple[Merges, Remembered]:
    """Built once per Python worker, not once per task."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        merges = Merges(spec)
        _LOADED[key] = merges, Remembered(merges)
    return _LOADED[key]


def bpe_encode(df: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "token_ids",
               keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``ids_col`` (array<int>): the byte-level BPE tokens of the text.

    ``vocabulary`` is the path of a tokenizer JSON file on the driver; its
    text (a few MB, whatever the input) is broadcast. Special tokens written
    in a text get their id. NULL and empty texts have no tokens. Texts are
    never cut: a text of any length streams through :class:`Encoder`. A
    column of the input named ``ids_col`` is replaced; ``keep`` names the
    columns to keep (default: all).
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())

    def make():
        merges, known = _loaded(spec.value)

        def run(texts):
            ids = [encode_ids(merges, t, known) for t in texts]
            ends = np.cumsum([0, *map(len, ids)])
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                             pa.array(np.concatenate(ids) if ids else [], pa.int32()))]
        return run

    return map_texts(df, text_col, [T.StructField(ids_col, T.ArrayType(T.IntegerType(), True))], make, keep)


def bpe_decode(df: DataFrame, vocabulary: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """Append ``text_col``: the text of the tokens; NULL ids give the empty
    text. A column of the input named ``text_col`` is replaced."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    kept = [c for c in df.columns if c.lower() != text_col.lower()]
    at = kept.index(ids_col)

    def run(batches):
        merges, _ = _loaded(spec.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                b = batch.slice(i, 512)
                ids, texts = b.column(at), []
                for k in range(b.num_rows):
                    v = ids[k].values
                    texts.append("" if v is None else decode_ids(merges, v.to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*kept, text_col])

    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField(text_col, T.StringType())])
    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, for whole texts."""
    docs = table(spark, sf_dir, "documents")
    ids = bpe_encode(docs, vocabulary_path(), keep=["doc_id"])
    back = bpe_decode(ids, vocabulary_path())
    return back.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
