"""Operator 10: quality rules with cross-document line frequency, DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated 8-word windows per
text.  The method then looks across documents: every line is normalised (letters
lower-cased, white space collapsed) and hashed, and the distinct documents of a
host that hold it are counted.  A line is boilerplate if at least ``least_docs`` of the
host's documents hold it and either more than ``line_share`` of them or more than
``most_docs`` at all: on a huge host the count alone decides.  Boilerplate is removed
from all documents of the host but the first that holds it (the smallest id), so
no line vanishes altogether; a document whose remaining words are fewer than
``least_words``, or less than ``least_kept`` of what it had, is rejected.  Documents
are distinct by their text: a thousand exact copies count once, and copies of
a line's first holder keep it like the holder.  Of a large group of near copies the
first holders stay whole.

Windows and lines are compared by 64-bit hashes.  Per-document work stays in
its row; only (host, line hash, text hash) triples are shuffled, so a hot host
or line is spread over many tasks before its count meets.  What each document
loses is written to a scratch table first, so the planner knows its size when it
joins whole rows with it: they move only if the losses are large.

Cases: a null or empty text has no words and fails the base rule; null hosts
are one host; repeated rows get the same verdict each; a null id is kept as a
row; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import WORD_SPACE, stored, text_of

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"  # fixed by the rule
LEAST_WORDS = 20
REPEAT_PERCENT = 30
LINE_SHARE = 0.05
LEAST_DOCS = 20
MOST_DOCS = 10_000
LEAST_KEPT = 0.3

_HAS_WORD = r"[^\x20\x09-\x0D]"


def _normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), WORD_SPACE, " "))


def _lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(_HAS_WORD))


def _keyed(docs: DataFrame) -> DataFrame:
    """The whole row as ``row`` beside what identifies it: id, host and hash of the text."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("host"),
                       text_of().alias("text")).withColumn("text_key", F.xxhash64("text"))


def measure(docs: DataFrame) -> DataFrame:
    """row, doc_id, host, text_key, the base measures, and hash and words of every line with a word."""
    held = ["row", "doc_id", "host", "text_key"]
    # what later expressions use often is computed in a step of its own
    step = _keyed(docs).select(
        *held, F.size(F.split("text", SYMBOLS)).alias("symbols_1"),
        F.filter(F.split("text", WORD_SPACE), lambda w: w != F.lit("")).alias("words"),
        _lines_with_words(F.col("text")).alias("lines"))
    step = step.select(
        *held, (F.col("symbols_1") - 1).cast("long").alias("n_symbols"),
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("lines", lambda x: _normalised(x)).alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    held += ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    hashes = F.col("hashes")
    step = step.select(
        *held, F.transform("lines", lambda x: F.xxhash64(x)).alias("line_keys"),
        F.transform("lines", lambda x: F.size(F.split(x, " "))).alias("line_words"),
        F.when(F.size(hashes) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))).alias("windows"))
    held += ["line_keys", "line_words"]
    # most texts repeat no window and stop here; the others sort theirs, so equal ones are neighbours
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    step = step.select(*held, F.when(repeats, F.array_sort(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("ranked"))
    ranked = F.col("ranked")

    def equal(j, x):
        return F.coalesce(F.get(ranked, j)["h"] == x["h"], F.lit(False))

    step = step.select(*held, F.array_sort(F.transform(
        F.filter(ranked, lambda x, j: equal(j - 1, x) | equal(j + 1, x)), lambda x: x["i"])).alias("starts"))
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"])
    return step.select(*held, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _host_lines(docs: DataFrame) -> DataFrame:
    """host, line_key, text_key and the smallest doc_id of every line of each distinct text."""
    rows = _keyed(docs)
    return rows.select("host", "text_key", "doc_id", F.explode(F.array_distinct(F.transform(
        _lines_with_words(F.col("text")), lambda x: F.xxhash64(_normalised(x))))).alias("line_key")).groupBy(
        "host", "line_key", "text_key").agg(F.min("doc_id").alias("doc_id"))


def frequent_lines(docs: DataFrame, *, line_share: float = LINE_SHARE, least_docs: int = LEAST_DOCS,
                   most_docs: int = MOST_DOCS) -> DataFrame:
    """host, line_key, n_docs, holder (hash of the text that keeps it) of the lines above the limits."""
    hosts = (_keyed(docs).select("host", "text_key").distinct().groupBy("host").agg(F.count("*").alias("host_docs")))
    counts = (_host_lines(docs).groupBy("host", "line_key")
              .agg(F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "text_key"))["text_key"].alias("holder"))
              .where(F.col("n_docs") >= least_docs))
    return (counts.join(hosts, counts["host"].eqNullSafe(hosts["host"]))
            .where((F.col("n_docs") > F.col("host_docs") * line_share) | (F.col("n_docs") > most_docs))
            .select(counts["host"], "line_key", "n_docs", "holder"))


def judge(docs: DataFrame, *, line_share: float = LINE_SHARE, least_docs: int = LEAST_DOCS, most_docs: int = MOST_DOCS,
          least_words: int = LEAST_WORDS, least_kept: float = LEAST_KEPT) -> DataFrame:
    """Every row with its measures, the lines it loses, and both verdicts."""
    often = stored(frequent_lines(docs, line_share=line_share, least_docs=least_docs, most_docs=most_docs), "often")
    lines = _keyed(docs).select("host", "text_key", F.explode(F.array_distinct(F.transform(
        _lines_with_words(F.col("text")), lambda x: F.xxhash64(_normalised(x))))).alias("line_key"))
    # few lines are frequent: the planner broadcasts them when their size allows and splits hot keys otherwise
    lost = stored(lines.join(often, lines["host"].eqNullSafe(often["host"]) & (lines["line_key"] == often["line_key"])
                             & (lines["text_key"] != often["holder"]))
                  .groupBy(lines["host"].alias("host"), "text_key")
                  .agg(F.collect_set(lines["line_key"]).alias("lost_lines")), "lost")
    m = measure(docs)
    same = m["host"].eqNullSafe(lost["host"]) & (m["text_key"] == lost["text_key"])
    out = m.join(lost, same, "left").select(*[m[c] for c in m.columns], "lost_lines")
    gone = F.aggregate(
        F.zip_with("line_keys", "line_words", lambda k, n: F.when(F.array_contains("lost_lines", k), n).otherwise(0)),
        F.lit(0).cast("long"), lambda a, n: a + n)
    out = out.withColumn("n_lost_words", F.coalesce(gone, F.lit(0).cast("long")))
    left = F.col("n_words") - F.col("n_lost_words")
    out = out.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                         | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (left >= least_words)
                          & (left >= F.col("n_words") * least_kept))


def apply_rules(docs: DataFrame, **limits) -> DataFrame:
    """The kept documents with all their columns; removed lines are gone from ``text`` (and from ``n_chars``)."""
    # a column that isn't deterministic, and is used, keeps the planner from copying the whole verdict into the scan's filter
    judged = judge(docs, **limits).withColumn("at", F.monotonically_increasing_id())
    kept = judged.where(F.col("kept") & (F.col("at") >= 0)).select("row", "lost_lines")
    line_gone = lambda x: x.rlike(_HAS_WORD) & F.array_contains("lost_lines", F.xxhash64(_normalised(x)))
    text = F.col("row")["text"]
    cleaned = F.when(F.col("lost_lines").isNull(), text).otherwise(
        F.array_join(F.filter(F.split(text, "\n"), lambda x: ~line_gone(x)), "\n"))
    kept = kept.select("row", "lost_lines", cleaned.alias("text"))

    def column(c):
        if c == "text":
            return F.col("text")
        if c == "n_chars":
            changed = F.char_length("text").cast(docs.schema[c].dataType)
            return F.when(F.col("lost_lines").isNull(), F.col("row")[c]).otherwise(changed).alias(c)
        return F.col("row")[c].alias(c)

    return kept.select(*[column(c) for c in docs.columns])
