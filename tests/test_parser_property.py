"""The rule-based Spark parser on random sessions whose events and warnings
are known beforehand: a session is put together from pieces, and every piece
brings its lines and what they mean."""

import random

from souk.operators import sessions as SL

DOCS = ["LAW_1", "ACC_45616", "x1LAW_5", "RLAW080_115230", "AB_12"]


class Session:
    """Lines so far, and what has to be found in them."""

    def __init__(self, rnd):
        self.rnd, self.lines, self.events, self.warnings = rnd, [], [], []
        self.in_card = False  # the last search card has neither result nor been left

    # ---- lines

    def add(self, line):
        """One physical line with some space around; its number."""
        pad = self.rnd.choice(["", " ", "\t", "  "])
        self.lines.append(pad + line + self.rnd.choice(["", " ", "\r"]))
        return len(self.lines)

    def blank(self):
        if self.rnd.random() < 0.15:
            self.lines.append(self.rnd.choice(["", "   "]))

    def head(self, line):
        """A line that begins something new, so it ends an open card."""
        n = self.add(line)
        if self.in_card:
            self.warnings.append((n, SL.W_IN_CARD))
            self.in_card = False
        self.blank()
        return n

    def stamp(self):
        r = self.rnd
        d, m, y = r.randrange(1, 29), r.randrange(1, 13), r.randrange(2010, 2030)
        return f"{d:02d}.{m:02d}.{y}_10:{r.randrange(60):02d}:00", f"{y}-{m:02d}-{d:02d}"

    def result(self):
        """A result line with its search id and documents."""
        sid = self.rnd.choice(["100", "-7", "42", "0"])
        docs = [self.rnd.choice(DOCS) for _ in range(self.rnd.randrange(4))]
        words = [*docs, *["bad"] * (self.rnd.random() < 0.2), *["A_1"] * (self.rnd.random() < 0.2)]
        return sid + (self.rnd.choice([" ", "\t"]) + " ".join(words) if words else ""), sid, tuple(docs)

    # ---- pieces

    def quick_search(self):
        dated = self.rnd.random() < 0.8
        stamp, day = self.stamp()
        n = self.head(f"QS {stamp} {{tax {self.rnd.randrange(9)}}}" if dated else "QS {no date}")
        line, sid, docs = self.result()
        self.add(line)
        self.blank()
        self.events.append((n, "QS", day if dated else "", sid, docs, (), None))

    def quick_search_without_result(self):
        """Whatever follows is not a result; it is reported at that line."""
        stamp, day = self.stamp()
        n = self.head(f"QS {stamp} {{q}}")
        self.events.append((n, "QS", day, None, (), (), None))
        kind = self.rnd.choice([self.junk, self.open, self.mark])
        at = len(self.lines)
        kind()
        self.warnings.append((at + 1, SL.W_QS))

    def card(self):
        dated, closed = self.rnd.random() < 0.8, self.rnd.random() < 0.7
        stamp, day = self.stamp()
        n = self.head("CARD_SEARCH_START" + (f" {stamp}" if dated else ""))
        params = {}
        for _ in range(self.rnd.randrange(4)):
            name, value = self.rnd.choice([("0", "ACC_45616"), ("134", "some text"), ("5", "")])
            if self.rnd.random() < 0.2:
                self.warnings.append((self.add(self.rnd.choice(["$ bad", "$"])), SL.W_BAD_PARAM))
            self.add(f"${name} {value}  " if value else f"${name}")
            params[name] = value
            self.blank()
        if self.rnd.random() < 0.8:
            self.add("CARD_SEARCH_END")
            self.blank()
        sid, docs = None, ()
        if closed:
            line, sid, docs = self.result()
            self.add(line)
            self.blank()
        self.in_card = not closed
        self.events.append((n, "CARD", day if dated else "", sid, docs, tuple(sorted(params.items())), None))

    def open(self):
        stamp, day = self.stamp()
        sid, doc = self.rnd.choice(["1", "-5"]), self.rnd.choice(DOCS)
        dated = self.rnd.random() < 0.7
        n = self.head(f"DOC_OPEN {stamp} {sid} {doc}" if dated else f"DOC_OPEN  {sid} {doc}")
        self.events.append((n, "OPEN", day if dated else "", sid, (), (), doc))

    def bad_open(self):
        self.warnings.append((self.head(f"DOC_OPEN {self.rnd.choice(['x', f'{self.stamp()[0]} abc LAW_1', f'{self.stamp()[0]} 7 bad'])}"), SL.W_BAD_OPEN))

    def junk(self):
        self.warnings.append((self.head(self.rnd.choice(["?? junk", "QWERTY 01.02.2020_x", "QS", "12abc LAW_1", "DOC_OPEN"])), SL.W_UNKNOWN))

    def mark(self):
        self.head(self.rnd.choice(["SESSION_START 01.01.2020_00:00:00", "SESSION_END"]))

    def stray(self):
        """Parts of a search outside any: after a session mark."""
        self.mark()
        line = self.rnd.choice(["$0 ACC_1", "CARD_SEARCH_END", "$"])
        self.warnings.append((self.add(line), SL.W_UNKNOWN))
        self.mark()
        self.warnings.append((self.add(self.result()[0]), SL.W_UNATTACHED))


PIECES = [Session.quick_search, Session.quick_search_without_result, Session.card, Session.open, Session.bad_open,
          Session.junk, Session.mark, Session.stray]


def random_session(rnd):
    s = Session(rnd)
    for _ in range(rnd.randrange(1, 10)):
        rnd.choice(PIECES)(s)
    return s


def test_parser_finds_what_was_put_in(spark):
    rnd = random.Random(20241204)
    made = {f"s{i}": random_session(rnd) for i in range(400)}
    rows = [(k, "\n".join(s.lines)) for k, s in made.items()]
    lines = SL.session_lines(spark.createDataFrame(rows, "session string, content string"))
    got_ev, got_w = {}, {}
    for r in SL.parse_sessions(lines, 4).collect():
        got_ev.setdefault(r.session, []).append(
            (r.lineno, r.kind, r.day, r.search_id, tuple(r.docs), tuple(sorted(r.params.items())), r.doc))
    for r in SL.parse_warnings(lines, 4).collect():
        got_w.setdefault(r.session, []).append((r.line, r.reason))
    for k, s in made.items():
        assert sorted(got_ev.get(k, [])) == sorted(s.events), s.lines
        assert sorted(got_w.get(k, [])) == sorted(s.warnings), s.lines


def test_split_reader_numbers_lines_like_whole_file_reader(spark, tmp_path):
    """Random sessions written as files (small splits forced), read both
    ways: identical (session, lineno, line) rows."""
    rnd = random.Random(99)
    d = tmp_path / "logs"
    d.mkdir()
    for i in range(40):
        text = "\n".join("\n".join(random_session(rnd).lines) for _ in range(rnd.randrange(1, 30)))
        (d / f"s{i}").write_bytes(text.encode("utf-8"))
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")     # many splits per file
    try:
        split = SL.read_session_lines(spark, str(d)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
    whole = SL.session_lines(SL.read_session_files(spark, str(d), "utf-8")).collect()
    norm = lambda rows: sorted((r.session.rsplit("/", 1)[-1], r.lineno, r.line) for r in rows)
    assert norm(split) == norm(whole)
