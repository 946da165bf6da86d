r"""Quality rules with cross-document line frequency, in DataFrame functions only.

Words are ``[^\x20\x09-\x0D]+``. Each document gets base counts; each of its lines is
normalised (A-Z in lower case, digits as 0, white space folded) and hashed. A line that
more than ``limit`` different texts of one host have is boilerplate of that host and is
removed; a document that keeps too few of its words is rejected. Equal texts count once,
so copies of one document do not turn its lines into boilerplate. The table has no page
address, so ``source`` is the host.

Scale: a document sends each of its distinct lines once, as two hashes; lines are
counted by (host, line) with map-side sums. The frequent ones are joined back over a salt
of the document, so a line that a third of all documents share is spread over ``SALTS``
keys.

Defined results: null text counts as empty (no words: base_failed); a null source is a
host of its own; repeated rows and rows that share a doc_id are judged on their own
texts; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddlens.llm.common import written

#: A line of more than so many different texts of a host is removed.
LIMIT = 20
#: A document that keeps less than this share of its words, or fewer words, is rejected.
LEAST_SHARE, LEAST_WORDS = 0.5, 50
SALTS = 32

_SPACE = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def base_counts(texts: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words to ``t``."""
    full = F.filter(F.split("t", "\n"), lambda x: F.translate(x, _BLANKS, "") != "")
    rows = texts.withColumn("words", F.transform(_words(F.col("t")), lambda w: F.xxhash64(w))).withColumn("lines", full)
    rows = rows.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("t", _BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    ).drop("lines", "t")
    # Windows of three words, sorted: equal ones are neighbours.
    window = F.transform(
        F.sequence(F.lit(0), F.col("n_words").cast("int") - 3),
        lambda i: F.struct(F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("p")),
    )
    rows = rows.withColumn("ws", F.when(F.col("n_words") >= 3, F.array_sort(window))).drop("words")
    again = F.filter("ws", lambda w, i: (F.get("ws", i - 1)["h"] == w["h"]) | (F.get("ws", i + 1)["h"] == w["h"]))
    rows = rows.withColumn("ps", F.array_sort(F.transform(again, lambda w: w["p"]))).drop("ws")
    # A window covers three words; overlaps count once.
    covered = F.aggregate(
        F.transform("ps", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("ps", i + 1) - p, F.lit(3)))), F.lit(0), lambda s, x: s + x
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("ps")


def line_rows(texts: DataFrame) -> DataFrame:
    """One row per line with a word: source, text_hash, pos, line (hash of the normalised line), n_line."""
    upper = "".join(map(chr, range(65, 91)))
    plain = F.translate("t", upper + "0123456789\t\x0b\x0c\r", upper.lower() + "0" * 10 + "    ")
    folded = F.transform(F.split(plain, "\n"), lambda x: F.filter(F.split(x, " "), lambda w: w != ""))
    hashed = F.transform(folded, lambda ws: F.struct(F.xxhash64(F.array_join(ws, " ")).alias("line"), F.size(ws).alias("n_line")))
    rows = texts.select("source", "text_hash", F.posexplode(hashed).alias("pos", "x"))
    return rows.select("source", "text_hash", "pos", "x.line", "x.n_line").where("n_line > 0")


def frequent_lines(lines: DataFrame, limit: int) -> DataFrame:
    """(source, line) of the lines that more than ``limit`` different texts of a source have."""
    return lines.select("source", "line", "text_hash").distinct().groupBy("source", "line").agg(F.count("*").alias("n_texts")).where(F.col("n_texts") > limit)


def removed_words(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """Words that each (source, text) loses with the frequent lines."""
    salted = lines.withColumn("salt", F.pmod("text_hash", F.lit(SALTS)))
    spread = frequent.select(F.col("source").alias("s"), F.col("line").alias("l"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("x"))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("line") == F.col("l")) & (F.col("salt") == F.col("x"))
    once = salted.join(spread, same).groupBy("source", "text_hash", "pos").agg(F.max("n_line").alias("n"))
    return once.groupBy(F.col("source").alias("s"), F.col("text_hash").alias("h")).agg(F.sum("n").alias("lost"))


def judged(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, the base counts, base_failed, removed_words and kept of every document."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t")
    ).withColumn("text_hash", F.xxhash64("t"))
    lines = written(line_rows(texts), "lines")
    frequent = written(frequent_lines(lines, limit), "frequent-lines")
    lost = removed_words(lines, frequent)
    base = base_counts(texts)
    joined = base.join(lost, F.col("source").eqNullSafe(F.col("s")) & (F.col("text_hash") == F.col("h")), "left")
    n, removed = F.col("n_words"), F.coalesce("lost", F.lit(0)).cast("long")
    failed = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * n)
    kept = ~failed & (n - removed >= LEAST_WORDS) & (n - removed >= LEAST_SHARE * n)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return joined.select("doc_id", *counts, failed.alias("base_failed"), removed.alias("removed_words"), kept.alias("kept"))
