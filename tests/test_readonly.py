import pytest
from pyspark.errors import ParseException

from usageloom.operators import readonly

ACCEPTED = {
    "SELECT * FROM raw_events": "SELECT * FROM raw_events",
    "SELECT * FROM raw_events;": "SELECT * FROM raw_events",
    "SELECT 1 ;; ": "SELECT 1 ",
    "WITH foo AS (SELECT 1) SELECT * FROM foo": "WITH foo AS (SELECT 1) SELECT * FROM foo",
    "select count(*) from raw_events": "select count(*) from raw_events",
    "   SELECT * FROM raw_events": "SELECT * FROM raw_events",
    "\n\tSeLeCt\n1": "SeLeCt\n1",
    "　SELECT 1": "SELECT 1",
    "\x1cSELECT 1\x1f": "SELECT 1",
    "SELECT * INTO new_table FROM raw_events": "SELECT * INTO new_table FROM raw_events",
    "SELECT updated_at, dropped, created FROM t": "SELECT updated_at, dropped, created FROM t",
    "SELECT éupdate, update², update_x FROM t": "SELECT éupdate, update², update_x FROM t",
    "SELECT 1; SELECT 2": "SELECT 1; SELECT 2",
}
REJECTED = {
    "INSERT INTO raw_events VALUES (1, 2, 3)": "not_select_or_with",
    "UPDATE raw_events SET event_type = 'x'": "not_select_or_with",
    "DELETE FROM raw_events": "not_select_or_with",
    "DROP TABLE raw_events": "not_select_or_with",
    "ALTER TABLE raw_events ADD COLUMN foo TEXT": "not_select_or_with",
    "TRUNCATE raw_events": "not_select_or_with",
    "EXPLAIN SELECT * FROM raw_events": "not_select_or_with",
    "CREATE TABLE evil (id INT)": "not_select_or_with",
    "SELECT(1)": "not_select_or_with",
    "SELECT": "not_select_or_with",
    "-- note\nSELECT 1": "not_select_or_with",
    "": "not_select_or_with",
    "SELECT * FROM raw_events WHERE event_type = 'UPDATE'": "forbidden:UPDATE",
    "SELECT 1; drop table t": "forbidden:DROP",
    "WITH x AS (SELECT 1) INSERT INTO t SELECT delete FROM x": "forbidden:INSERT",
    "SELECT delete, insert FROM t": "forbidden:INSERT",
    "SELECT copy": "forbidden:COPY",
    "SELECT (call)": "forbidden:CALL",
}


def test_bulk_audit(spark):
    texts = [*ACCEPTED, *REJECTED]
    frame = spark.createDataFrame(list(enumerate(texts)), "query_id int, sql string")
    got = {r["query_id"]: r for r in readonly.audit_queries(frame).collect()}
    for i, text in enumerate(texts):
        assert got[i]["is_readonly"] == (text in ACCEPTED), text
        assert got[i]["reason"] == REJECTED.get(text), text
        if text in ACCEPTED:
            assert got[i]["cleaned_sql"] == ACCEPTED[text]


def test_a_missing_text_is_not_a_query(spark):
    frame = spark.createDataFrame([(1, None)], "query_id int, sql string")
    assert readonly.audit_queries(frame).first()["is_readonly"] is False


def test_single_text_gets_the_same_verdict(spark):
    assert readonly.require_readonly(spark, "SELECT 1;") == "SELECT 1"
    with pytest.raises(readonly.NotReadOnly, match="forbidden:UPDATE"):
        readonly.require_readonly(spark, "SELECT 'UPDATE'")


def test_gated_run(spark, events):
    events([(1, "a", "2024-01-01 00:00:00", "login", "free", None, "US")]).createOrReplaceTempView("raw_events")
    assert readonly.run_readonly(spark, "select count(*) AS n from raw_events;").first()["n"] == 1
    with pytest.raises(readonly.NotReadOnly):
        readonly.run_readonly(spark, "DROP VIEW raw_events")


@pytest.mark.parametrize("sql", ["SELECT * INTO new_table FROM raw_events", "SELECT 1; SELECT 2"])
def test_parser_refuses_what_the_gate_lets_pass(spark, sql):
    readonly.require_readonly(spark, sql)
    with pytest.raises(ParseException):
        readonly.run_readonly(spark, sql)


def test_higher_order_functions_are_reading(spark):
    assert readonly.run_readonly(spark, "SELECT transform(array(1, 2), x -> x + 1) AS t").first()["t"] == [2, 3]


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT java_method('java.lang.System', 'getProperty', 'user.dir')",
        "SELECT TRANSFORM(1) USING 'cat'",
    ],
)
def test_outside_code_is_not_run(spark, sql):
    with pytest.raises(readonly.NotReadOnly, match="calls_outside_code"):
        readonly.run_readonly(spark, sql)


@pytest.fixture
def views(spark, events, tmp_path):
    events([(1, "a", "2024-01-01 00:00:00", "login", "free", None, "US")]).createOrReplaceTempView("raw_events")
    secret = tmp_path / "secret.txt"
    secret.write_text("not for you\n")
    spark.read.text(str(secret)).createOrReplaceTempView("over_a_path")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW nested AS SELECT * FROM over_a_path")
    yield str(secret)
    for name in ("raw_events", "over_a_path", "nested"):
        spark.catalog.dropTempView(name)


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT * FROM text.`{path}`",
        "SELECT (SELECT max(value) FROM text.`{path}`) AS v FROM raw_events",
        "SELECT * FROM raw_events WHERE user_id IN (SELECT value FROM text.`{path}`)",
        "WITH t AS (SELECT * FROM text.`{path}`) SELECT * FROM t, raw_events",
        "SELECT * FROM raw_events WHERE EXISTS (SELECT 1 FROM (SELECT value FROM text.`{path}`) x WHERE value = user_id)",
        "SELECT user_id FROM raw_events UNION ALL SELECT value FROM text.`{path}`",
        "SELECT * FROM range(10)",
        "SELECT * FROM raw_events, range(3)",
        "SELECT * FROM over_a_path",
        "SELECT * FROM nested",
    ],
)
def test_only_named_views_are_read(spark, views, sql):
    with pytest.raises(readonly.NotReadOnly, match="outside_views"):
        readonly.run_readonly(spark, sql.format(path=views), views=["raw_events"])


def test_a_registered_view_may_lie_over_a_path(spark, views):
    for name in ("over_a_path", "nested"):
        assert readonly.run_readonly(spark, f"SELECT * FROM {name}").first()["value"] == "not for you"
        assert readonly.run_readonly(spark, f"SELECT * FROM {name}", views=[name.upper()]).count() == 1


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT count(*) AS n FROM RAW_EVENTS",
        "WITH u AS (SELECT user_id FROM raw_events) SELECT count(*) AS n FROM u a JOIN u b ON a.user_id = b.user_id",
        "SELECT 1 AS n",
        "SELECT * FROM VALUES (1) AS v(n)",
        "SELECT (SELECT count(*) FROM raw_events) AS n",
        "SELECT count(*) AS n FROM raw_events LATERAL VIEW explode(array(1)) e AS x",
    ],
)
def test_texts_over_views_and_literals_run(spark, views, sql):
    assert readonly.run_readonly(spark, sql, views=["raw_events"]).first()["n"] == 1


def test_a_table_of_the_catalog_is_outside(spark, tmp_path):
    spark.sql(f"CREATE TABLE gate_table (v INT) USING parquet LOCATION '{tmp_path}/t'")
    try:
        with pytest.raises(readonly.NotReadOnly, match="outside_views"):
            readonly.run_readonly(spark, "SELECT * FROM gate_table")
    finally:
        spark.sql("DROP TABLE gate_table")
