import random
from itertools import combinations

from llm_helpers import SCHEMA, Groups, documents
from pyspark.sql import functions as F

from souk.llm import line_dedup
from souk.llm.line_dedup import block_keys, document_lines, drop_lines, line_groups, simhashes
from souk.llm.quotes import _own, depth_of, link_quotes, op7_quotes


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def say(line):
    return " ".join(line.lower().split())


def test_line_groups_brute_force(spark):
    rng = random.Random(8)
    base = [[f"w{rng.randrange(80)}" for _ in range(40)] for _ in range(6)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rng.randint(0, 5)):
            words = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                words[rng.randrange(40)] = f"x{rng.randrange(1000)}"
            lines.append(("  " if rng.random() < 0.2 else "") + " ".join(words))
        lines.insert(0, rng.choice(["", "Short line", "short  LINE"]))
        rows.append((d * 3, "\n".join(lines)))
    df = documents(spark, rows).withColumn("line", F.lit("clash"))
    sims = {(r.k1, r.k2): r.sim for r in simhashes(document_lines(df, "doc_id", "text")).collect()}
    keyed = {r.said: sims[r.k1, r.k2] for r in document_lines(df, "doc_id", "text").collect()}
    g = Groups()
    for a, b in combinations(sorted(keyed), 2):
        g.find(a), g.find(b)
        near = bin((keyed[a] ^ keyed[b]) & 2 ** 64 - 1).count("1") <= 3
        x, y = a.split(), b.split()
        if near and edit_distance(x, y) <= 0.2 * max(len(x), len(y)):
            g.link(a, b)
    places = {}
    for d, t in rows:
        for n, line in enumerate(t.split("\n")):
            if say(line):
                places.setdefault(g.find(say(line)), []).append((d, n))
    want = {(d, n): (*min(p), len(p), (d, n) == min(p)) for p in places.values() for d, n in p}
    got = line_groups(df).collect()
    assert {(r.doc_id, r.line): (r.keep_id, r.keep_line, r.group_lines, r.kept) for r in got} == want
    assert len({v[:2] for v in want.values()}) < len(keyed)  # some different lines are one group
    left = {r.doc_id: r.text for r in drop_lines(df).collect()}
    assert left == {d: "\n".join(x for n, x in enumerate(t.split("\n")) if not say(x) or want[d, n][3]) for d, t in rows}


def test_line_recall_over_edit_similarity(spark):
    """Against brute force over edit similarity alone, down to 0.8."""
    rng = random.Random(5)
    rows, pairs = [], set()
    for n in (4, 5, 8, 10, 20, 27, 58, 100):
        for k in range(25):
            a = [f"w{int(2000 * rng.random() ** 3)}" for _ in range(n)]
            b = list(a)
            for _ in range((n + (n == 4)) // 5):  # (one word more makes four words similar to five)
                kind = 1 if n == 4 else rng.randrange(2)
                i = rng.randrange(len(b))
                b[i:i + 1] = [f"x{rng.randrange(10 ** 6)}"] + ([b[i]] if kind and len(b) < n + 1 else [])
            rows += [(len(rows), " ".join(a)), (len(rows) + 1, " ".join(b))]
    words = [t.split() for _, t in rows]
    for i, j in combinations(range(len(rows)), 2):
        x, y = words[i], words[j]
        if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and edit_distance(x, y) <= 0.2 * max(len(x), len(y)):
            pairs.add((i, j))
    g = Groups()
    for i, j in pairs:
        g.link(i, j)
    group = {r.doc_id: r.keep_id for r in line_groups(documents(spark, rows), distance=None).collect()}
    assert all(g.find(i) == g.find(group[i]) for i in group)  # none too many
    assert len(pairs) >= 180 and sum(group[i] == group[j] for i, j in pairs) >= 0.98 * len(pairs)


def test_lines_meet_their_pivot_where_the_buckets_are_made(spark, monkeypatch):
    """Rows of the buckets are not shuffled again for the pivots, and do not
    carry what a line is compared by."""
    rng = random.Random(9)
    rows = [(n, " ".join(f"w{rng.randrange(12)}" for _ in range(10))) for n in range(60)]
    written, write = [], line_dedup.materialise
    monkeypatch.setattr(line_dedup, "materialise", lambda df, name, *a, **k: written.append((name, out := write(df, name, *a, **k))) or out)
    monkeypatch.setattr(line_dedup, "discard", lambda *tables: None)
    line_groups(documents(spark, rows), distance=None)
    tables = [t for name, t in written if name == "line-buckets"]
    assert len(tables) == line_dedup.PARTS and all(t.columns == ["bucket", "k1", "b"] for t in tables)
    got = [r for t in tables for r in t.collect()]
    known = next(t for name, t in written if name == "different-lines").select("k1", "keys").collect()
    in_bucket = {}
    for r in known:
        for b in r["keys"]:
            in_bucket.setdefault(b, []).append(r["k1"])
    shared = {b: k for b, k in in_bucket.items() if len(k) > 1}
    assert shared and sorted((r["bucket"], r["k1"]) for r in got) == sorted((b, x) for b, k in shared.items() for x in k)
    assert all(r["b"] is None or (r["b"] == min(shared[r["bucket"]]) and r["b"] != r["k1"]) for r in got)


def test_pigeonhole(spark):
    """Up to three bits apart, some key is equal."""
    rng = random.Random(1)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        pairs.append((a - (a >> 63 << 64), b - (b >> 63 << 64)))
    df = spark.createDataFrame(pairs, "a long, b long")
    assert df.where(F.arrays_overlap(block_keys(F.col("a")), block_keys(F.col("b")))).count() == 300


def test_lines_of_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert line_groups(empty).count() == 0 and drop_lines(empty).count() == 0
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "one\none\n\nONE"), (4, "one\none\n\nONE"), (None, "one"), (5, "word " * 30000), (6, "word " * 30000 + "x")]
    df = documents(spark, rows)
    left = {(r.doc_id, r.text) for r in drop_lines(df).select("doc_id", F.substring("text", 1, 9).alias("text")).collect()}
    assert left == {(1, None), (2, ""), (3, "\n\n"), (4, "one\n"), (None, ""), (5, "word word"), (6, "")}
    got = {(r.doc_id, r.line): r for r in line_groups(df).collect()}
    assert got[4, 0].kept and not got[4, 1].kept and not got[4, 3].kept and not got[None, 0].kept
    assert got[4, 0].group_lines == 7 and got[6, 0].keep_id == 5


# ---- quotations

def chat(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")


def test_levels(spark):
    df = spark.createDataFrame([("a", 0), ("> a", 1), (">> a", 2), (" > > >a", 3), ("a > b", 0), ("", 0)], "line string, depth int")
    assert df.where(depth_of(F.col("line")) != F.col("depth")).count() == 0
    assert _own("> q\n>\n\nown\n> more\nlines\n", [0]) == "own\n> more\nlines"
    assert _own(">\n> never\nx", None) == ">\n> never\nx"


def test_quotes_of_nothing_in_the_conversation_stay(spark):
    rows = [(1, 0, "u", "How?"), (1, 1, "a", "> How?\nType\n>>> import os\nas the manual says:\n> call it twice"),
            (1, 2, "u", "> >>> import os\nfails"), (1, 1, "b", "second with the same turn\n> How?\n> kept")]
    got = {(r.turn, r.role): r.text for r in link_quotes(chat(spark, rows)).collect()}
    assert got[1, "a"] == "Type\n>>> import os\nas the manual says:\n> call it twice"
    assert got[1, "b"] == "second with the same turn\n> kept" and got[0, "u"] == "How?"
    assert got[2, "u"] == "> >>> import os\nfails"  # said nowhere without marks


def test_threads(spark):
    rows = [(1, 0, "u", "How do I sort a list?\nAnd a tuple?"), (1, 1, "a", "> how  do I sort a LIST?\nUse sorted()."),
            (1, 2, "u", "A new question"), (1, 3, "u", "> Use sorted().\n> > And a tuple?\nThanks"),
            (1, 4, "a", "> A new question\nAn answer"), (1, 5, "a", "> never said\nfree"), (1, 6, "u", "> A new question\n> free\n> Thanks\n"),
            (2, 0, "u", "A new question"), (2, 1, "a", "> Use sorted().\nother conversation"), (2, 2, "a", "> How do I sort a list?"),
            (3, 0, "u", None), (3, None, "u", "no turn"), (None, 0, "u", "said"), (None, 1, "u", "> said\nok"), (None, 1, "u", "> said\nok")]
    df = chat(spark, rows).withColumn("position", F.lit("clash"))
    out = link_quotes(df)
    got = {}
    for r in out.collect():
        got.setdefault((r.conv_id, r.turn), r)
    assert out.count() == len(rows)
    parent = {k: r.parent_turn for k, r in got.items()}
    assert parent == {(1, 0): None, (1, 1): 0, (1, 2): None, (1, 3): 1, (1, 4): 2, (1, 5): None, (1, 6): 5, (2, 0): None, (2, 1): None,
                      (2, 2): None, (3, 0): None, (3, None): None, (None, 0): None, (None, 1): 0}
    assert [k[1] for k, r in sorted(got.items(), key=lambda x: x[1].position) if k[0] == 1] == [0, 1, 3, 2, 4, 5, 6]
    assert got[1, 3].text == "Thanks" and got[1, 3].quoted == 2 and got[1, 6].text == "" and got[3, 0].text == ""
    assert got[1, 6].root_turn == 5 and got[1, 3].root_turn == 0
    assert link_quotes(chat(spark, [])).count() == 0


def test_long_reply_chain(spark):
    rows = [(1, k, "u", f"message number {k}" + (f"\n> message number {k - 1}" if k else "")) for k in range(70)]
    got = link_quotes(chat(spark, rows)).collect()
    assert all(r.root_turn == 0 and r.position == r.turn and r.text == f"message number {r.turn}" for r in got)


def test_query_gives_the_conversations_back(spark):
    from conftest import SF001
    want = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{SF001}/conversations.parquet").collect()}
    got = op7_quotes(spark, SF001).collect()
    assert {(r.conv_id, r.turn): r.text for r in got} == {k: v.strip() for k, v in want.items()}
    for r in got:
        answers = r.turn - (2 if r.turn % 3 == 2 else 1)
        assert r.parent_turn == (answers if r.turn else None) and r.root_turn == 0 and r.position == r.turn


def test_pairs_are_verified_in_parts(spark, monkeypatch):
    rng = random.Random(5)
    said = [" ".join(f"w{rng.randrange(400)}" for _ in range(20)) for _ in range(30)]
    near = [" ".join("new" if k == i % 20 else w for k, w in enumerate(s.split())) for i, s in enumerate(said)]
    df = documents(spark, [(i, t) for i, t in enumerate(said + near + said[:5])])
    names, put = [], line_dedup.materialise
    monkeypatch.setattr(line_dedup, "materialise", lambda df, name, *a, **k: (names.append(name), put(df, name, *a, **k))[1])
    found = {}
    for parts in (1, 4):
        names.clear()
        monkeypatch.setattr(line_dedup, "PARTS", parts)
        found[parts] = sorted(map(tuple, line_groups(df, distance=None).drop("_mark").collect()))
        assert names.count("line-links") == 2 * parts and names.count("line-pairs") == 2
    assert found[1] == found[4]
    assert sum(not r[-1] for r in found[4]) == 35


def test_the_table_of_word_classes_is_once_in_the_plan(spark):
    table = bytes(range(1, 65)) * (line_dedup.SLOTS // 64)
    lines = document_lines(documents(spark, [(0, "a b c d e f g"), (1, "one"), (2, "x y")]), "doc_id", "text")
    known = simhashes(lines, F.lit(table), 1000)
    assert sorted((r["size"], len(r["keys"])) for r in known.collect()) == [(1, 0), (2, 0), (7, 6)]
    assert known._jdf.queryExecution().optimizedPlan().toString().count(table[:64].hex().upper() * 8) == table.hex().upper().count(table[:64].hex().upper() * 8)


def test_pairs_of_unlike_lines_are_not_written(spark, monkeypatch):
    """Lines that share a bucket, and by chance some bits of their SimHashes."""
    rng = random.Random(3)
    start = "all of these lines begin with the same few words".split()
    said = [start + [f"w{rng.randrange(10 ** 6)}" for _ in range(20)] for _ in range(500)]
    said += [[*s[:12], "new", *s[13:]] for s in said[:5]]
    written, put = [], line_dedup.materialise

    def counted(df, name, *a, **k):
        out = put(df, name, *a, **k)
        if name == "line-pairs":
            written.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "materialise", counted)
    got = line_groups(documents(spark, [(i, " ".join(s)) for i, s in enumerate(said)]), distance=None).collect()
    assert {r.doc_id: r.keep_id for r in got if not r.kept} == {500 + i: i for i in range(5)}
    assert sum(written) <= 20


def test_the_filter_of_odd_words_loses_no_similar_pair(spark):
    rng = random.Random(7)
    rows = []
    for n in (5, 9, 20, 40, 90, 300, 509, 510, 700):
        for k in range(12):
            a = [f"w{rng.randrange(300)}" for _ in range(n)]
            b = list(a)
            for _ in range(n // 5):
                i, kind = rng.randrange(len(b)), k % 3
                b[i:i + 1] = [f"x{rng.randrange(10 ** 6)}", b[i]][:kind] if kind != 2 or len(b) < n * 1.2 else [b[i]]
            rows += [(len(rows), " ".join(a)), (len(rows) + 1, " ".join(b))]
    lines = document_lines(documents(spark, rows), "doc_id", "text")
    known = simhashes(lines).select("size", "odd0", "odd1", F.col("first.id").alias("id"))
    other = known.select(F.col("id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in ("size", "odd0", "odd1")])
    tells = line_dedup.may_be_similar(0.8)
    told = {(r.id, r.b): r.t for r in known.join(other, F.col("id") < F.col("b")).select("id", "b", tells.alias("t")).collect()}
    words = [t.split() for _, t in rows]
    similar = [(i, i + 1) for i in range(0, len(rows), 2) if words[i] != words[i + 1]
               and edit_distance(words[i], words[i + 1]) <= 0.2 * max(len(words[i]), len(words[i + 1]))]
    assert len(similar) > 60 and all(told[p] for p in similar)
    unlike = [told[i, j] for i, j in told if len(words[i]) == len(words[j]) == 20 and j > i + 1]
    assert sum(unlike) < 0.02 * len(unlike)


def test_what_a_line_says(spark):
    said = [" a  B ", "a b", "A\tb", "a\x0b\x0c\rb", "\t", "   ", "", "é x  Y\r", " a", "ÀB c"]
    df = documents(spark, list(enumerate(said)))
    got = {r.id: r.said for r in document_lines(df, "doc_id", "text").collect()}
    assert got == {0: "a b", 1: "a b", 2: "a b", 3: "a b", 7: "é x y", 8: "a", 9: "àb c"}
