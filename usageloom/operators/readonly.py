"""A gate that lets only reading SQL texts through: in bulk over a column, or in front of ``spark.sql``.

A text passes when, trimmed and freed of trailing semicolons, it starts with
SELECT or WITH and holds none of the forbidden words, not even inside a string
literal. It judges words, not meaning: ``SELECT ... INTO`` and several
statements in one text pass here and are refused by Spark's parser. What a text
reads is judged by ``run_readonly`` from its analysed plan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: whole words that must not occur, in order of report
FORBIDDEN_WORDS = (
    "INSERT",
    "UPDATE",
    "DELETE",
    "DROP",
    "ALTER",
    "TRUNCATE",
    "GRANT",
    "REVOKE",
    "CREATE",
    "EXECUTE",
    "CALL",
    "COPY",
)
NOT_A_QUERY = "not_select_or_with"
# White space as a set of characters (Unicode's, and the four separators below
# U+0020 that Java's own class leaves out), and the characters words are made of.
SPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"[\p{L}\p{N}_]"
# Ways a Spark query text can reach outside the data: refused by run_readonly only.
OUTSIDE_CALLS = re.compile(
    r"\b(?:REFLECT|TRY_REFLECT|JAVA_METHOD)\b|\bTRANSFORM\b.*\bUSING\b", re.IGNORECASE | re.DOTALL
)


class NotReadOnly(ValueError):
    """The text is not a read-only query."""


def _has_word(text: Column, word: str) -> Column:
    # most texts do not hold the letters at all, which a byte search settles
    return text.contains(word) & text.rlike(f"(?<!{WORD}){word}(?!{WORD})")


def cleaned(sql: Column) -> Column:
    return F.rtrim(F.btrim(sql, F.lit(SPACE)), F.lit(";"))


def refusal(text: Column, upper: Column) -> Column:
    """Why a cleaned text, also given in upper case, is refused; NULL when it passes."""
    reason = F.when(
        ~F.coalesce(text.rlike(rf"(?iu)\A(?:SELECT|WITH)[{SPACE}]"), F.lit(False)), F.lit(NOT_A_QUERY)
    )
    for word in FORBIDDEN_WORDS:
        reason = reason.when(_has_word(upper, word), F.lit(f"forbidden:{word}"))
    return reason


def audit_queries(queries: DataFrame, sql_column: str = "sql") -> DataFrame:
    """Each text with its cleaned form, verdict and reason."""
    # the upper-case text is a column of its own, so that it is made once per row
    return (
        queries.withColumn("cleaned_sql", cleaned(F.col(sql_column)))
        .withColumn("_upper", F.upper("cleaned_sql"))
        .withColumn("reason", refusal(F.col("cleaned_sql"), F.col("_upper")))
        .withColumn("is_readonly", F.col("reason").isNull())
        .drop(sql_column, "_upper")
    )


def require_readonly(spark: SparkSession, sql: str) -> str:
    """The cleaned text, or ``NotReadOnly``. The verdict is the one of the bulk audit."""
    verdict = audit_queries(spark.range(1).select(F.lit(sql).alias("sql"))).first()
    if verdict["reason"] is not None:
        raise NotReadOnly(verdict["reason"])
    return verdict["cleaned_sql"]


def registered_views(spark: SparkSession) -> set[str]:
    """The session's temporary views: what ``register_views`` has named."""
    return {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}


def _each(scala_seq):
    return (scala_seq.apply(i) for i in range(scala_seq.size()))


def _first_outside(plan, views: set[str]) -> str | None:
    """The name of the first leaf of an analysed plan that is neither one of ``views`` nor made by the text itself.

    A view's own plan is not looked into: whoever registered it vouches for it. Subqueries are plans of
    their own that hang on expressions.
    """
    kind = plan.getClass().getSimpleName()
    if kind == "View":
        name = plan.desc().identifier().table().lower()
        if name in views:
            return None
    children = [*_each(plan.children()), *_each(plan.subqueries())]
    if not children and kind not in ("OneRowRelation", "LocalRelation", "CTERelationRef"):
        return kind
    return next((found for c in children if (found := _first_outside(c, views)) is not None), None)


def run_readonly(spark: SparkSession, sql: str, views: Iterable[str] | None = None) -> DataFrame:
    """Run a gated text over registered views, and over nothing else.

    ``views`` names them; by default they are the session's temporary views. Files, tables of a
    catalog, table functions and views that are not named are refused after analysis, before any row is read.
    """
    text = require_readonly(spark, sql)
    if OUTSIDE_CALLS.search(text):
        raise NotReadOnly("calls_outside_code")
    known = registered_views(spark) if views is None else {v.lower() for v in views}
    result = spark.sql(text)
    outside = _first_outside(result._jdf.queryExecution().analyzed(), known)
    if outside is not None:
        raise NotReadOnly(f"outside_views:{outside}")
    return result
