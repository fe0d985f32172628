"""Hard negatives against SQL over all pairs, with odd rows, ties and several clusters."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from usageloom.llm import hard_negatives, queries

EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def twin(path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    return sorted(con.execute(queries.OP11_SQL).fetchall())


def mined(spark, folder):
    return sorted(map(tuple, queries.op11_hard_negatives(spark, folder).collect()))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_whole_table_equals_sql(spark, folder):
    assert mined(spark, folder) == twin(f"{folder}/embeddings.parquet")


def brute(rows, anchors, positives=5, negatives=10, low=30, high=90):
    out = []
    width = max((len(r[2]) for r in rows), default=0)
    score = lambda a, b: sum(x * y for x, y in zip(a + [0] * (width - len(a)), b + [0] * (width - len(b)), strict=True))
    for i, label, vec in rows:
        if i not in anchors:
            continue
        others = sorted((-score(vec, v), j, k) for j, k, v in rows if j != i)
        for s, p, _ in [o for o in others if o[2] == label][:positives]:
            fits = [o for o in others if o[2] != label and low * -s <= 100 * -o[0] <= high * -s][:negatives]
            out += [(i, p, n, o[1], -s, -o[0]) for n, o in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["spread", "ties", "far apart", "one vector", "zeros", "large"])
def test_lists_of_several_clusters_and_slices_equal_brute_force(spark, monkeypatch, kind):
    draw = np.random.default_rng(len(kind))
    n = 400
    vectors = {
        "spread": draw.integers(-200, 200, (n, 6)), "ties": draw.integers(-1, 2, (n, 3)),
        "far apart": draw.integers(-9, 9, (n, 4)) * 10 ** draw.integers(0, 5, (n, 1)), "one vector": np.full((n, 4), 3),
        "zeros": draw.integers(-2, 3, (n, 3)) * draw.integers(0, 2, (n, 1)), "large": draw.integers(-2**27, 2**27, (n, 3)),
    }[kind]
    rows = [(int(i), int(draw.integers(0, 4)), [int(x) for x in v]) for i, v in enumerate(vectors)]
    for name, value in (("MEMBERS", 4), ("SLICE", 50), ("BLOCK", 3), ("STEP", 16)):
        monkeypatch.setattr(hard_negatives, name, value)
    frame = spark.createDataFrame([(i, k, [float(x) for x in v]) for i, k, v in rows], "id long, label int, vector array<double>")
    got = sorted(map(tuple, hard_negatives.hard_negatives(frame, F.col("id") % 20 == 0).collect()))
    want = brute(rows, set(range(0, n, 20)))
    assert got == want and (len(want) > 100 or kind == "one vector")


def test_scores_beyond_53_bits_are_exact(spark):
    rows = [(0, 1, [2**27, 1]), (1, 1, [2**27, 3]), (2, 2, [2**26, 1]), (3, 2, [2**26, 2]), (4, 2, [2**26, 2])]
    frame = spark.createDataFrame([(i, k, [float(x) for x in v]) for i, k, v in rows], "id long, label int, vector array<double>")
    got = sorted(map(tuple, hard_negatives.hard_negatives(frame, F.col("id") == 0).collect()))
    assert got == brute(rows, {0}) and [r[3] for r in got] == [3, 4, 2]


def test_scores_beyond_the_range_count_as_its_end(spark):
    rows = [(0, 1, [1e300, 1.0]), (1, 1, [1e300, 3.0]), (2, 2, [0.0, 6.0]), (3, 2, [-1e300, 0.0])]
    frame = spark.createDataFrame(rows, "id long, label int, vector array<double>")
    assert hard_negatives.hard_negatives(frame, F.col("id") == 0).collect() == []
    assert hard_negatives.hard_negatives(frame, F.col("id") == 0, low=-100, high=100).count() == 2


def test_odd_rows(spark, tmp_path):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 0.5], 1), (1, [0.9, 0.5], 1), (2, [0.5, 0.3], 2), (3, [0.5, 0.3], 2), (7, [0.6, 0.2], 0),
        (100, None, 1), (200, [1.0, None], 1), (300, [nan, 1.0], 1), (400, [inf, 1.0], 1), (500, [0.3, 0.3], None),
        (600, [0.0, 0.0], 2), (700, [1.0, 0.2], 3), (800, [-0.4, -0.1], 1), (900, [1.0, 1.0], 9),
    ]
    wide = spark.createDataFrame(rows, EMBEDDINGS).select("*", *[F.lit(1).alias(c) for c in ("id", "norm", "score", "query", "cluster")])
    wide.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = mined(spark, str(tmp_path))
    assert got == twin(f"{tmp_path}/embeddings.parquet/*.parquet") and got
    assert not {100, 200, 300, 400, 500} & {x for r in got for x in (r[0], r[1], r[3])}


def test_repeated_identifiers_and_vectors_of_several_lengths(spark):
    rows = [(0, 1, [5.0, 1.0]), (1, 1, [4.0]), (1, 1, [4.0]), (1, 2, [1.0]), (2, 2, []), (3, 2, [2.0, 0.0, 7.0]), (None, 2, [1.0])]
    frame = spark.createDataFrame(rows, "id long, label int, vector array<double>")
    got = sorted(map(tuple, hard_negatives.hard_negatives(frame, F.col("id") == 0).collect()))
    assert got == brute([(0, 1, [5, 1]), (1, 1, [4]), (2, 2, []), (3, 2, [2, 0, 7])], {0}) and len(got) == 1


def test_empty_table_and_no_anchor(spark):
    frame = spark.createDataFrame([], "id long, label int, vector array<double>")
    assert hard_negatives.hard_negatives(frame, F.col("id") == 0).collect() == []
    frame = spark.createDataFrame([(1, 1, [1.0])], frame.schema)
    assert hard_negatives.hard_negatives(frame, F.col("id") == 0).collect() == []
    assert hard_negatives.hard_negatives(frame, F.col("id") == 1).collect() == []


def test_bounds_are_never_below_a_members_score():
    draw = np.random.default_rng(8)
    members = draw.integers(-300, 300, (80, 8))
    rows = draw.integers(-300, 300, (500, 8))
    middle = hard_negatives.centres(members, 5)
    packed = [v.astype("<i8").tobytes() for v in members]
    away = hard_negatives.angles(packed, middle)
    home = away.argmin(axis=1)
    wide = np.array([away[home == c, c].max(initial=0) for c in range(5)])
    lists = hard_negatives.Lists(middle, wide, 1.0)
    norms = np.sqrt((rows.astype(float) ** 2).sum(axis=1))
    bounds = lists.bounds([v.astype("<i8").tobytes() for v in rows], norms)
    size = np.sqrt((members.astype(float) ** 2).sum(axis=1))
    assert (rows @ members.T <= bounds[:, home] * size).all()
