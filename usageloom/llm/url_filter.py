"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
in ASCII lower case; the path follows up to ``?``, ``#`` or the end. A rule names
a host and a path prefix; it fits that host and all its subdomains, and the
longest rule that fits decides. Other URLs are judged by the model: hashed
3- to 5-grams of the host (marked ``h``) and the path (marked ``p``), trained
on a small labelled table, a parameter.

DataFrame and pyspark.ml code only. Rules are a few literals in one expression;
a URL is read once and nothing is shuffled.

Defined cases: a null URL or one without ``://`` has an empty host and path, no
rule, and the verdict the model gives to no n-grams at all; repeated rows are
judged each; an empty table gives an empty result. Without labelled rows of
both kinds the model allows everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usageloom.llm.url_labels import ALLOWED, BLOCKED

BUCKETS = 1 << 14
SIZES = (3, 4, 5)
CUT = 0.5

#: (verdict, host, path) of the query; longest is by the length of host and path
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule that fits, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, name, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        text = F.when(fits, f"{name}{prefix}").otherwise(text)
        verdict = F.when(fits, said).otherwise(verdict)
    return text, verdict


def grams_of(host: Column, path: Column) -> Column:
    """Character n-grams with their part's mark; ``^`` and ``$`` stand at the ends of a part."""
    parts = [marked_grams(mark, part, n) for mark, part in (("h", host), ("p", path)) for n in SIZES]
    return F.concat(*parts)


def marked_grams(mark: str, part: Column, n: int) -> Column:
    closed = F.concat(F.lit("^"), part, F.lit("$"))
    count = F.greatest(F.length(closed) - (n - 1), F.lit(0))
    # arrays shifted against each other: a substring would be looked for from the text's beginning each time
    shifted = [F.slice(F.split(closed, ""), k + 1, count) for k in range(n)]
    grams = F.transform(shifted[0], lambda c: F.concat(F.lit(mark), c))
    for more in shifted[1:]:
        grams = F.zip_with(grams, more, lambda a, b: F.concat(a, b))
    return F.when(F.length(part) > 0, grams).otherwise(F.array().cast("array<string>"))


def with_parts(urls: DataFrame, *carried: Column) -> DataFrame:
    cut = urls.select(*carried, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return cut.withColumn("grams", grams_of(F.col("host"), F.col("path")))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table that comes with this module; label 1 is to be blocked."""
    rows = [(url, 1.0) for url in BLOCKED] + [(url, 0.0) for url in ALLOWED]
    return spark.createDataFrame(rows, "url string, label double")


def hashing() -> HashingTF:
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=BUCKETS, binary=True)


def train(labelled: DataFrame, penalty: float = 0.01):
    """A model, or None where the labels are not of both kinds."""
    known = labelled.select("url", "label").filter("url IS NOT NULL AND label IN (0, 1)")
    if known.select("label").distinct().limit(2).count() < 2:
        return None
    rows = hashing().transform(with_parts(known, F.col("label")))
    return LogisticRegression(regParam=penalty, maxIter=500, tol=1e-9, standardization=False).fit(rows)


def url_verdicts(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's probability of ``block``."""
    model = train(labelled)
    rows = with_parts(pages, F.col("page_id"))
    if model is None:
        scored = rows.withColumn("block_probability", F.lit(0.0))
    else:
        scored = (model.transform(hashing().transform(rows))
                  .withColumn("block_probability", vector_to_array("probability")[1]))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("block_probability") >= CUT, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, learned).alias("verdict"), "block_probability")
