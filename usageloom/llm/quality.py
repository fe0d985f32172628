"""Quality rules: a log-likelihood ratio of hashed n-grams between trusted and raw text.

Words and word pairs are hashed into ``BUCKETS`` buckets. Two multinomials over
the buckets are counted: one over all documents, one over the trusted ones
among them (labelled of good quality; at most ``TRUSTED`` of them, those whose
identifiers hash lowest, so the list of their identifiers is bounded). A document's score is the sum of
log(trusted / raw) over its n-grams divided by their number, so long and short
texts compare. Every document is judged by fixed rules first and then by
``score >= THRESHOLD``; nothing is random.

DataFrame functions only. Counting is one pass whose map side keeps one row per
bucket; the counts are ``BUCKETS`` rows, a parameter, and the log ratios reach
the tasks as the one value of a scalar subquery.

Defined cases: a null text has no words; a text without words scores 0 and
fails the rules; without trusted documents the ratio is 0 everywhere, so only
the rules decide; repeated rows are judged each; an empty table gives an empty
result. Other columns, whatever their names, pass through ``kept_documents``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageloom.llm.common import SPACE, text_or_empty, written

BUCKETS = 16384
#: below this mean log ratio a text is unlike the trusted ones
THRESHOLD = -0.06
#: pseudo-counts a bucket, so that a bucket the trusted texts lack costs a bounded amount
PRIOR = 1.0

#: trusted documents counted at most
TRUSTED = 20_000

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"


#: the characters of the word contract's white space
BLANKS = " \t\n\x0b\f\r"


def word_hashes(text: Column) -> Column:
    """The hash of each word, in order."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def grams_of(hashes: Column) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    rest = F.greatest(F.size(hashes) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(hashes, 1, rest), F.slice(hashes, 2, rest), lambda a, b: F.xxhash64(a, b))
    return F.transform(F.concat(hashes, pairs), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> DataFrame:
    """Identifiers of documents labelled good, at most ``most``: the bounded sample of labelled rows."""
    return (labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))


def count_grams(docs: DataFrame, trusted: DataFrame) -> list[tuple[int, int, int]]:
    """(bucket, count over all documents, count over trusted ones); at most ``BUCKETS`` rows."""
    good = F.broadcast(trusted.withColumn("trusted", F.lit(1)))  # at most TRUSTED rows
    grams = (
        docs.select("doc_id", word_hashes(text_or_empty()).alias("hashes"))
        .join(good, "doc_id", "left")
        .select(F.coalesce("trusted", F.lit(0)).alias("trusted"), F.explode(grams_of(F.col("hashes"))).alias("bucket"))
    )
    return [tuple(r) for r in grams.groupBy("bucket").agg(F.count(F.lit(1)), F.sum("trusted")).collect()]


def log_ratios(counts: list[tuple[int, int, int]]) -> list[float]:
    """log(trusted share / corpus share) per bucket; all 0 where nothing is trusted."""
    raw, good = [0] * BUCKETS, [0] * BUCKETS
    for bucket, n, g in counts:
        raw[bucket], good[bucket] = n, g
    if not sum(good):
        return [0.0] * BUCKETS
    raw_total, good_total = sum(raw) + PRIOR * BUCKETS, sum(good) + PRIOR * BUCKETS
    return [math.log((g + PRIOR) / good_total) - math.log((n + PRIOR) / raw_total)
            for n, g in zip(raw, good, strict=True)]


def base_columns(docs: DataFrame, *carried: Column) -> DataFrame:
    """The counts of the fixed rules, and ``hashes`` for the score.

    Windows of words are compared by hash. Most texts repeat none; only those
    that do sort their windows to find which words they cover.
    """
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    first = docs.select(*carried, text_or_empty().alias("_text"))
    hashed = first.select(
        *[c for c in first.columns if c != "_text"],
        word_hashes(text).alias("_hashes"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("_word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("_n_symbols"),
        lines.alias("_lines"),
    )
    windows = F.transform(
        F.sequence(F.lit(1), F.size("_hashes") - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW)))
    windowed = hashed.withColumns({
        "_n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": F.when(F.size("_hashes") > WINDOW, windows),
    }).drop("_lines")
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    ordered = windowed.withColumn("_sorted", F.when(repeats, placed)).drop("_windows")
    twice = F.filter(
        F.transform("_sorted", lambda x, i: F.when(
            (x["w"] == F.get("_sorted", i - 1)["w"]) | (x["w"] == F.get("_sorted", i + 1)["w"]), x["i"])),
        lambda i: i.isNotNull())
    starts = ordered.withColumn("_starts", F.sort_array(twice)).drop("_sorted")
    steps = F.zip_with(F.slice("_starts", 1, F.size("_starts") - 1), F.slice("_starts", 2, F.size("_starts") - 1),
                       lambda a, b: F.least(F.lit(WINDOW), b - a))
    covered = F.aggregate(steps, F.lit(WINDOW), lambda n, step: n + step)
    return starts.withColumn("_n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_starts")


def judged(docs: DataFrame, labels: DataFrame, *carried: Column, threshold: float = THRESHOLD) -> DataFrame:
    """``carried`` and, for each document, ``_n_words`` to ``_n_repeat_words``, ``_base_failed``, ``_score``, ``_kept``."""
    spark = docs.sparkSession
    counts = count_grams(docs.select("doc_id", "text"), trusted_ids(labels))
    model = spark.createDataFrame([(log_ratios(counts),)], "ratios array<double>")
    based = base_columns(docs, *carried).withColumn("_grams", grams_of(F.col("_hashes")))
    n_words = F.size("_hashes").cast("long")
    failed = (n_words < MIN_WORDS) | (100 * F.col("_n_repeat_words") > REPEAT_PERCENT * n_words)
    scored = based.withColumn("_ratios", model.scalar()).withColumns({
        "_n_words": n_words,
        "_base_failed": failed,
        "_score": F.aggregate("_grams", F.lit(0.0), lambda s, b: s + F.get("_ratios", b))
        / F.greatest(F.size("_grams"), F.lit(1)),
    }).drop("_ratios", "_grams", "_hashes")
    return scored.withColumn("_kept", ~F.col("_base_failed") & (F.col("_score") >= threshold))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One narrow row per document, stored: a reader's filter would otherwise be copied into every step."""
    return written(judged(docs, labels, F.col("doc_id")).select(
        "doc_id", *[F.col(f"_{c}").alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")]),
        "quality-report")


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, whole, in their own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    # a filter that needs a row number stays above it, so the long steps below are not copied into the filter
    kept = judged(docs, labels, row).withColumn("_number", F.monotonically_increasing_id()).filter("_kept AND _number >= 0")
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
