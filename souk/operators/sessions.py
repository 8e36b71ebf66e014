"""Search-session log job, as DataFrame rules - no UDF.

Input is one text per session (a file); every non-blank line becomes a row
``(session, lineno, line)``. The sequential parser of a session is
re-expressed as per-line rules over two window values computed per session
in line order:

* ``prev`` - kind of the previous non-blank line;
* ``head`` - the last earlier line whose kind is not a card parameter or a
  card end (``P``, ``p``, ``E``); it tells which search a line belongs to.

Line kinds, tested in this order on the trimmed line:
``S`` session start/end, ``Q`` quick search, ``C`` card start, ``O`` document
open, ``P`` card parameter (``$id value``), ``p`` malformed parameter, ``E``
card end, ``R`` result line (``<id> <docs...>``), ``X`` anything else.

Rules (equivalent to the loop of the original job):
* ``R`` attaches to ``head`` if head is ``C``, or head is ``Q`` and
  ``prev`` is that ``Q``; otherwise it is an unattached result (warning).
* ``P`` belongs to the card at ``head`` (last value per id wins); outside a
  card it is an unknown line. ``p`` warns (bad parameter / unknown line);
  ``E`` outside a card is an unknown line.
* Any non-``R`` line right after a ``Q`` warns "QS without result".
* A line of kind ``S Q C O X`` whose head is ``C`` warns "unexpected line in
  card" and is then processed normally.
* ``O``: tokens by whitespace; 4+ tokens -> (3rd, 4th), 3 -> (2nd, 3rd); valid
  if the id is an integer and the document id matches fully; the day is
  empty in the late (undated) format.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk.operators.windows import prefix_scan, time_block
from souk.session import written

# Line grammar of the session logs.
DAY_RE = r"(\d{2})\.(\d{2})\.(\d{4})_"
DOC_RE = r"[A-Za-z][A-Za-z0-9]{1,19}_\d+"
RESULT_PREFIX_RE = r"^-?\d+(\s|$)"
PARAM_RE = r"^\$(\S+)\s*(.*)$"
INT_RE = r"^-?\d+$"
TARGET_DOC = "ACC_45616"
TARGET_PARAM = "0"

# warning reasons
W_QS = "qs_without_result"
W_BAD_PARAM = "bad_card_param"
W_IN_CARD = "unexpected_in_card"
W_BAD_OPEN = "bad_doc_open"
W_UNATTACHED = "unattached_result"
W_UNKNOWN = "unknown_line"


# ------------------------------------------------------------------ input

def read_session_files(spark: SparkSession, path: str, charset: str = "windows-1251") -> DataFrame:
    """One row per file: ``(session = file path, content)``.

    ``binaryFile`` + ``decode`` so the cp1251 text is decoded properly
    (non-standard charsets need ``spark.sql.legacy.javaCharsets``, which is
    switched on here). Every file is read by one task; files spread over
    tasks.
    """
    standard = {"iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8"}
    if charset.lower() not in standard:
        # Spark 4 only accepts the standard charsets unless this is enabled
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    with few_listing_tasks(spark):
        raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return raw.select(F.col("path").alias("session"), F.decode("content", charset).alias("content"))


def read_session_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(session, lineno, line)`` straight from the files, split-parallel.

    ``read.text`` splits large files across tasks; inside one split rows
    keep file order, so ``(file_block_start, monotonically_increasing_id)``
    orders a file's lines, and the 1-based line number is a blocked prefix
    count with the split as the block. A single huge session file is thus
    read, numbered and parsed by many tasks. Lines end at ``\n`` only
    (a ``\r`` before it is trimmed like any control character). Text is
    decoded as UTF-8; use :func:`read_session_files` for cp1251 values
    (the structure and the metrics are ASCII either way).
    """
    with few_listing_tasks(spark):
        raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    # the scan reads its rows twice; the files, which may be many, are read once
    raw = written(raw.select(F.col("_metadata.file_path").alias("session"),
                             F.col("_metadata.file_block_start").alias("_split"),
                             F.monotonically_increasing_id().alias("_pos"), F.col("value").alias("raw")), "raw-lines")
    numbered = prefix_scan(raw, ["session"], F.col("_split"), ["_split", "_pos"],
                           sums={"lineno": F.lit(1)}, inclusive=True)
    line = F.regexp_replace("raw", r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    return (numbered.select("session", F.col("lineno").cast("int").alias("lineno"), line.alias("line"))
                    .where(F.length("line") > 0))


def write_session_files(lines: DataFrame, path: str) -> None:
    """Write ``(session, lineno, line)`` as one text file per session
    (``path/session=<id>/part-*``), lines in order: rows are clustered by
    session and sorted by line number inside each task before the write.

    What costs is the number of files, not their bytes, so the sessions are
    dealt to all shuffle partitions (adaptive execution would join them by
    bytes), and every task commits its own files: the driver, which moves all
    sessions' folders one by one otherwise, has none to move."""
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (lines.repartition(parts, "session").sortWithinPartitions("session", "lineno")
          .select("session", "line").write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
          .partitionBy("session").text(path))


#: folders are listed in so many tasks per core (Spark's own limit is a task
#: per folder, up to 10,000)
LISTING_TASKS = 4


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """Reads begun inside list many small folders in few tasks."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def session_lines(files: DataFrame, session: str = "session", content: str = "content") -> DataFrame:
    """Split texts on ``\\r?\\n`` into ``(session, lineno, line)``.

    ``lineno`` is 1-based over all physical lines; ``line`` is trimmed of
    control characters and spaces at both ends; blank lines are dropped.
    """
    parts = files.select(F.col(session).alias("session"),
                         F.posexplode(F.split(F.col(content), r"\r?\n")).alias("pos", "raw"))
    line = F.regexp_replace("raw", r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    return (parts.select("session", (F.col("pos") + 1).alias("lineno"), line.alias("line"))
                 .where(F.length("line") > 0))


# ----------------------------------------------------------- classification

def line_kind(line: Column) -> Column:
    return (F.when(line.startswith("SESSION_START") | line.startswith("SESSION_END"), "S")
             .when(line.startswith("QS "), "Q")
             .when(line.startswith("CARD_SEARCH_START"), "C")
             .when(line.startswith("DOC_OPEN "), "O")
             .when(line.startswith("$") & line.rlike(r"^\$\S"), "P")
             .when(line.startswith("$"), "p")
             .when(line.startswith("CARD_SEARCH_END"), "E")
             .when(line.rlike(RESULT_PREFIX_RE), "R")
             .otherwise("X"))


def day_of(line: Column) -> Column:
    """First ``dd.MM.yyyy_`` anywhere in the line as ``yyyy-MM-dd``; '' if none."""
    return F.when(line.rlike(DAY_RE),
                  F.concat_ws("-", F.regexp_extract(line, DAY_RE, 3),
                              F.regexp_extract(line, DAY_RE, 2),
                              F.regexp_extract(line, DAY_RE, 1))).otherwise(F.lit(""))


# Lines per block of the blocked scan in :func:`classify` (bounds the size
# of every window group, however long a session is).
LINES_PER_BLOCK = 50_000


def classify(lines: DataFrame, lines_per_block: int = LINES_PER_BLOCK) -> DataFrame:
    """Add ``kind``, ``prev`` and ``head_kind``/``head_lineno`` per line.

    ``prev`` and ``head`` are "last earlier value" scans per session in line
    order, computed as a blocked prefix scan (blocks of ``lines_per_block``
    lines), so even a session holding a large share of all lines is spread
    over many tasks.
    """
    k = lines.withColumn("kind", line_kind(F.col("line")))
    is_head = ~F.col("kind").isin("P", "p", "E")
    head = F.when(is_head, F.struct(F.col("kind").alias("k"), F.col("lineno").alias("n")))
    block = F.floor(F.col("lineno") / lines_per_block).cast("bigint")
    scanned = prefix_scan(k, ["session"], block, ["lineno"],
                          lasts={"prev": F.col("kind"), "_head": head})
    return scanned.select("session", "lineno", "line", "kind", "prev",
                          F.col("_head.k").alias("head_kind"), F.col("_head.n").alias("head_lineno"))


def _attached() -> Column:
    """A result line that belongs to the search at its head (NULL-safe: a
    line without head or previous line is never attached)."""
    head, prev = F.coalesce(F.col("head_kind"), F.lit("")), F.coalesce(F.col("prev"), F.lit(""))
    return (F.col("kind") == "R") & ((head == "C") | ((head == "Q") & (prev == "Q")))


def _open_parts() -> tuple[Column, Column, Column]:
    """(search id, doc, valid) of a DOC_OPEN line: tokens by whitespace; 4+
    tokens -> (3rd, 4th), 3 tokens -> (2nd, 3rd)."""
    tok = F.split(F.col("line"), r"\s+")
    n = F.size(tok)
    sid = F.when(n >= 4, tok[2]).when(n >= 3, tok[1]).otherwise(F.lit(""))
    doc = F.when(n >= 4, tok[3]).when(n >= 3, tok[2]).otherwise(F.lit(""))
    valid = (F.col("kind") == "O") & sid.rlike(INT_RE) & doc.rlike(f"^{DOC_RE}$")
    return sid, doc, valid


def _warning_items() -> Column:
    """All warnings of a classified line as ``array<struct<reason, text>>``."""
    k, head = F.col("kind"), F.col("head_kind")
    cut80, cut120 = F.substring("line", 1, 80), F.substring("line", 1, 120)
    _, _, o_valid = _open_parts()
    none = F.lit(None).cast("string")
    rules = [
        ((F.col("prev") == "Q") & (k != "R"), W_QS, none),
        (k.isin("S", "Q", "C", "O", "X") & (head == "C"), W_IN_CARD, cut80),
        ((k == "p") & (head == "C"), W_BAD_PARAM, F.col("line")),
        ((k == "R") & ~_attached(), W_UNATTACHED, cut80),
        ((k == "X") | (k.isin("P", "p", "E") & (F.coalesce(head, F.lit("")) != "C")), W_UNKNOWN, cut80),
        ((k == "O") & ~o_valid, W_BAD_OPEN, cut120),
    ]
    found = F.array(*[F.when(cond, F.struct(F.lit(r).alias("reason"), txt.alias("text")))
                      for cond, r, txt in rules])
    return F.filter(found, lambda x: x.isNotNull())


# ------------------------------------------------------------------ events

def parse_sessions(lines: DataFrame, lines_per_block: int = LINES_PER_BLOCK) -> DataFrame:
    """Events ``(session, lineno, kind, day, search_id, docs, params, doc)``.

    kind is ``QS``, ``CARD`` or ``OPEN``. Every line that contributes to an
    event gets the line number of the event's head line (its own for
    QS/CARD/OPEN, ``head_lineno`` for an attached result or a card
    parameter); one aggregation by ``(session, event line)`` then builds
    the events in a single pass over the classified lines. A group holds
    the lines of one event only (partial aggregation applies).
    """
    c = classify(lines, lines_per_block)
    k = F.col("kind")
    att = _attached()
    is_param = (k == "P") & (F.col("head_kind") == "C")
    o_sid, o_doc, o_valid = _open_parts()
    event_line = (F.when(k.isin("Q", "C") | o_valid, F.col("lineno"))
                   .when(att | is_param, F.col("head_lineno")))
    rows = c.select(
        "session", event_line.alias("ev"), "lineno",
        F.when(k == "Q", "QS").when(k == "C", "CARD").when(o_valid, "OPEN").alias("ekind"),
        F.when(k.isin("Q", "C", "O"), day_of(F.col("line"))).alias("eday"),
        F.when(att, F.regexp_extract("line", r"^(-?\d+)", 1)).when(o_valid, o_sid).alias("sid"),
        F.when(att, F.regexp_extract_all(F.regexp_extract("line", r"^-?\d+(.*)$", 1), F.lit(DOC_RE), 0)).alias("rdocs"),
        F.when(is_param, F.struct(F.regexp_extract("line", PARAM_RE, 1).alias("pid"), F.col("lineno").alias("pline"),
                                  F.trim(F.regexp_extract("line", PARAM_RE, 2)).alias("pval"))).alias("param"),
        F.when(o_valid, o_doc).alias("odoc")).where(F.col("ev").isNotNull())
    g = rows.groupBy("session", "ev").agg(
        F.max("ekind").alias("kind"), F.max("eday").alias("day"), F.max("sid").alias("search_id"),
        F.first("rdocs", ignorenulls=True).alias("docs"),
        F.array_sort(F.collect_list("param")).alias("_params"), F.max("odoc").alias("doc"))
    ps = F.col("_params")
    # last value per parameter id: sorted by (pid, line), keep the last entry of each pid
    last_per_id = F.filter(ps, lambda x, i: (i + 1 == F.size(ps)) | (F.element_at(ps, i + 2)["pid"] != x["pid"]))
    params = F.map_from_entries(F.transform(last_per_id, lambda x: F.struct(x["pid"], x["pval"])))
    return g.select("session", F.col("ev").alias("lineno"), "kind", "day", "search_id",
                    F.coalesce("docs", F.array().cast("array<string>")).alias("docs"),
                    params.alias("params"), "doc")


def parse_warnings(lines: DataFrame, lines_per_block: int = LINES_PER_BLOCK) -> DataFrame:
    """Warnings ``(session, line, reason, text)``; texts cut at 80 characters
    (120 for DOC_OPEN lines). A line can carry two warnings; all rules are
    evaluated in one projection and exploded (one pass over the lines)."""
    c = classify(lines, lines_per_block)
    return (c.select("session", F.col("lineno").alias("line"), F.explode(_warning_items()).alias("w"))
             .select("session", "line", "w.reason", "w.text"))


# ----------------------------------------------------------------- metrics

def card_search_count(events: DataFrame, doc: str = TARGET_DOC, param: str = TARGET_PARAM) -> DataFrame:
    """Metric 1: card searches whose parameter ``param`` equals ``doc``."""
    return (events.where((F.col("kind") == "CARD") & (F.try_element_at("params", F.lit(param)) == doc))
                  .agg(F.count("*").alias("card_searches")))


def quick_search_opens(events: DataFrame) -> DataFrame:
    """Metric 2: dated opens of documents found by the quick search they
    reference, counted per (day, doc).

    Hits are deduplicated ``(session, search_id, doc)``; opens are not. The
    key includes the session because search ids are only unique inside a
    session. One scan of the events, no join: hits and opens become items
    of one frame, counted per ``(session, search_id, doc, day)`` (a hit is
    the row with day NULL), then per ``(session, search_id, doc)`` the open
    counts per day are kept when a hit exists. Every group is bounded by the
    number of distinct days, whatever the number of opens.
    """
    k = F.col("kind")
    hit_items = F.transform("docs", lambda d: F.struct(F.coalesce(F.col("search_id"), F.lit("")).alias("sid"),
                                                       d.alias("doc"), F.lit(None).cast("string").alias("day")))
    open_item = F.array(F.struct(F.col("search_id").alias("sid"), F.col("doc").alias("doc"),
                                 F.col("day").alias("day")))
    is_open = ((k == "OPEN") & (F.col("day") != "") & F.col("search_id").isNotNull()
               & F.col("doc").isNotNull())
    items = F.when(k == "QS", hit_items).when(is_open, open_item)
    x = events.select("session", F.explode(items).alias("i")).select("session", "i.sid", "i.doc", "i.day")
    per_day = x.groupBy("session", "sid", "doc", "day").agg(F.count("*").alias("n"))
    per_key = per_day.groupBy("session", "sid", "doc").agg(
        F.max(F.col("day").isNull()).alias("hit"),
        F.collect_list(F.when(F.col("day").isNotNull(), F.struct("day", "n"))).alias("opens"))
    return (per_key.where("hit").select("doc", F.explode("opens").alias("o"))
                   .groupBy(F.col("o.day").alias("day"), "doc").agg(F.sum("o.n").alias("count"))
                   .orderBy("day", "doc"))


def session_diagnostics(lines: DataFrame, lines_per_block: int = LINES_PER_BLOCK) -> DataFrame:
    """One row: sessions, events and warnings of the run, from a single
    aggregate over the classified lines (same rules as the parser)."""
    c = classify(lines, lines_per_block)
    _, _, o_valid = _open_parts()
    is_event = F.col("kind").isin("Q", "C") | o_valid
    return c.agg(F.count_distinct("session").alias("sessions"),
                 F.count(F.when(is_event, 1)).alias("events"),
                 F.sum(F.size(_warning_items())).cast("bigint").alias("warnings"))


def warning_sample(warnings: DataFrame, per_session: int = 3, total: int = 10) -> DataFrame:
    """At most ``per_session`` warnings per session, ``total`` overall, by
    (session, line) - a bounded report, the limit is the feature."""
    w = Window.partitionBy("session").orderBy("line", "reason")
    return (warnings.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= per_session)
                    .drop("_rn").orderBy("session", "line", "reason").limit(total))


def session_job(spark: SparkSession, input_path: str, out: str, doc: str = TARGET_DOC,
                charset: str = "windows-1251", split_files: bool = False, single_file: bool = False) -> dict:
    """read -> parse -> metrics -> write ``metric1`` (one text line),
    ``metric2`` (CSV with header), ``diagnostics`` (one JSON line: sessions,
    events, warnings) and ``warnings`` (all of them, JSON lines).

    ``split_files`` reads lines split-parallel (:func:`read_session_lines`,
    for very large session files) instead of one decoded text per file.
    Metric 2 is written as Spark partitions it, ``single_file`` asks for one
    file. The lines and the parsed events, which several results read, are
    written once below the checkpoint folder.
    """
    lines = written(read_session_lines(spark, input_path) if split_files
                    else session_lines(read_session_files(spark, input_path, charset)), "session-lines")
    events = written(parse_sessions(lines), "session-events")
    m1 = card_search_count(events, doc)
    m1.select(F.concat(F.lit(f"card searches for {doc}: "), F.col("card_searches").cast("string"))
              .alias("value")).coalesce(1).write.mode("overwrite").text(f"{out}/metric1")
    m2 = quick_search_opens(events)
    (m2.coalesce(1) if single_file else m2).write.mode("overwrite").option("header", "true").csv(f"{out}/metric2")
    session_diagnostics(lines).write.mode("overwrite").json(f"{out}/diagnostics")
    parse_warnings(lines).write.mode("overwrite").json(f"{out}/warnings")
    return {name: f"{out}/{name}" for name in ("metric1", "metric2", "diagnostics", "warnings")}


# ------------------------------------------------- logs derived from events

def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").try_cast("int")


def synthetic_session_lines(events: DataFrame, block_seconds: int = 86400) -> DataFrame:
    """Session logs derived from the ``events`` table (FIXTURES recipe):
    session = user, events in ``(ts, event_id)`` order, each event emits
    lines by its type. Returns ``(session, lineno, line)`` with contiguous
    line numbers per session.

    The two sequential values (the last view's search id before an event,
    and the running line count) are blocked prefix scans over day blocks,
    so a very active user does not end up sorted in one task.
    """
    k = _k(F.col("props"))
    sid = F.col("event_id") % 50
    t = F.col("event_type")
    stamp = F.date_format("ts", "dd.MM.yyyy_HH:mm:ss")
    s = F.col("sid").cast("string")
    law = lambda x: F.concat(F.lit("LAW_"), x.cast("string"))
    acc = lambda x: F.concat(F.lit("ACC_"), x.cast("string"))
    order = ["ts", "event_id"]
    ev = events.select("user_id", "event_id", "ts", "event_type", k.alias("k"), sid.alias("sid"),
                       stamp.alias("stamp"))
    kk = F.col("k")
    n_lines = (F.when(t == "view", F.when(kk % 10 != 0, 2).otherwise(1))
                .when(t == "signup", 5)
                .when(t == "error", F.when(kk % 2 == 1, 2).otherwise(1))
                .otherwise(1))
    # one scan: search id of the last earlier view, and lines before this event
    ev = prefix_scan(ev.withColumn("n_lines", n_lines), ["user_id"], time_block("ts", block_seconds), order,
                     sums={"_before": F.col("n_lines")},
                     lasts={"_last_view": F.when(t == "view", F.col("sid"))})
    ev = ev.withColumn("view_sid", F.coalesce("_last_view", F.lit(0))).drop("_last_view")
    text = (F.when(t == "view", F.concat_ws("\n", F.concat(F.lit("QS "), F.col("stamp"), F.lit(" {q"), kk.cast("string"), F.lit("}")),
                                           F.when(kk % 10 != 0, F.concat_ws(" ", s, law(kk % 7), acc(kk % 5), law((kk + 1) % 7)))))
             .when(t == "click", F.concat_ws(" ", F.lit("DOC_OPEN"), F.col("stamp"), F.col("view_sid").cast("string"), law(kk % 7)))
             .when(t == "purchase", F.concat(F.lit("DOC_OPEN  "), F.col("view_sid").cast("string"), F.lit(" "), law(kk % 7)))
             .when(t == "signup", F.concat_ws("\n", F.concat(F.lit("CARD_SEARCH_START "), F.col("stamp")),
                                             F.lit("$134 text"), F.concat(F.lit("$0 "), acc(kk % 5)),
                                             F.lit("CARD_SEARCH_END"), F.concat_ws(" ", s, acc(kk % 5))))
             .otherwise(F.concat_ws("\n", F.lit("?? junk"), F.when(kk % 2 == 1, F.concat_ws(" ", s, law(F.lit(1)))))))
    numbered = ev.select(F.col("user_id").cast("string").alias("session"),
                         (F.col("_before") + 1).alias("first"), F.split(text, "\n").alias("lines"))
    return (numbered.select("session", "first", F.posexplode("lines").alias("pos", "line"))
                    .select("session", (F.col("first") + F.col("pos")).cast("int").alias("lineno"), "line"))
