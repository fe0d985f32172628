"""Every query with a DuckDB twin against that twin, column by column and value by value."""

import math

import duckdb
import pytest

from conftest import MEDIUM, SMALL
from usageloom.plans.registry import QUERIES
from usageloom.plans.twins import TWINS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}
# these pass the data through files and state, so the small folder is enough
SLOW = {n for n in QUERIES if n.endswith("_stream")} | {"upsert_metrics", "scaled_features"}


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def in_duckdb(folder, sql):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    order = sorted(columns)
    rows = [tuple(plain(r[columns.index(c)]) for c in order) for r in cursor.fetchall()]
    return order, types, sorted(rows)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_matches_twin(spark, name):
    folder = SMALL if name in SLOW else MEDIUM
    result = QUERIES[name](spark, folder)
    columns = sorted(result.columns)
    rows = sorted(tuple(map(plain, r)) for r in result.select(*columns).collect())
    expected_columns, expected_types, expected = in_duckdb(folder, TWINS[name])
    assert columns == expected_columns
    assert {c: TYPES[t] for c, t in result.dtypes} == expected_types
    assert rows == expected
    assert rows, "a query over the given tables finds something"


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)
    assert set(QUERIES) - set(TWINS) == {
        "forest_report", "forest_balanced_report", "feature_importances",
    }


def test_stickiness_is_a_share(spark):
    row = QUERIES["stickiness"](spark, MEDIUM).first()
    assert 0 <= row["dau_mau_ratio"] <= 1
