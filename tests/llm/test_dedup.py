"""Exact and near deduplication against brute force."""

import collections
import re

import pytest
from odd_rows import labels, none, odd  # noqa: F401
from pyspark.sql import functions as F

from usageloom.llm import components, exact_dedup, near_dedup

MEDIUM = "/root/testdata/sf0.01"


def texts_of(spark, folder=MEDIUM):
    return spark.read.parquet(f"{folder}/documents.parquet")


def shingles(text):
    words = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
             for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        shared = len(sets[a] & sets[b])
        if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark):
    docs = texts_of(spark)
    found = {r[0]: (r[1], r[2]) for r in near_dedup.near_duplicates(docs).select(
        "doc_id", "n_shingles", "component_id").collect()}
    expected = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert found == expected
    assert any(i != c for i, (_, c) in found.items())


def family(n, words=140, edits=6):
    """Copies of one text with edits at varying places: a chain-like group whose far members are unlike."""
    import random

    draw = random.Random(5)
    base = [f"w{draw.randrange(10**6)}" for _ in range(words)]
    out, now = [], list(base)
    for i in range(n):
        if i % 7 == 0:
            now = list(base)
        now[draw.randrange(words)] = f"e{i}"
        out.append((i, " ".join(now)))
    return out + [(n + i, " ".join([f"u{i}x{j}" for j in range(60)] + base[:50])) for i in range(n)]


def test_large_group_and_a_shared_passage(spark):
    rows = family(150)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r[0]: (r[1], r[2]) for r in near_dedup.near_duplicates(frame).select(
        "doc_id", "n_shingles", "component_id").collect()}
    expected = brute_components(rows)
    missed = [i for i in found if found[i] != expected[i]]
    assert not missed


def test_blocks_find_every_near_pair_once(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rows = family(40)
    classes = near_dedup.folded(spark.createDataFrame(rows, "doc_id long, text string")).select(
        F.col("doc_id").alias("class_id"), "signature")
    members = near_dedup.keys_of(classes).withColumn("component", F.col("class_id"))
    signatures = {r[0]: np.frombuffer(bytes(r[1]), "<u2") for r in classes.collect()}
    expected = sorted((a, b) for a in signatures for b in signatures
                      if a < b and (signatures[a] != signatures[b]).sum() <= near_dedup.DISTANCE)
    assert sorted((r[0], r[1]) for r in near_dedup.block_pairs(members, classes).collect()) == expected
    nearest = {(r[0], r[1]) for r in near_dedup.block_pairs(members, classes, nearest=True).collect()}
    assert nearest and nearest < set(expected)


def test_keys_meet_for_every_pair_within_the_distance(spark):
    """Pigeonhole: signatures that differ in DISTANCE values, however these lie, share a key."""
    import numpy as np

    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**16, near_dedup.SIZE).astype("<u2")
    rows = [(0, base.tobytes())]
    for i in range(1, 60):
        other = base.copy()
        other[draw.choice(near_dedup.SIZE, near_dedup.DISTANCE, replace=False)] ^= np.uint16(1 + i)
        rows.append((i, other.tobytes()))
    keys = near_dedup.keys_of(spark.createDataFrame(
        [(i, bytearray(b)) for i, b in rows], "class_id long, signature binary"))
    mine = {r[0] for r in keys.filter("class_id = 0").collect()}
    met = {r["class_id"] for r in keys.collect() if r["key"] in mine}
    assert met == set(range(60))


def test_near_duplicates_of_odd_rows(spark, odd, none):
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[1] == [(4, 1, True)] * 2 and by[2] == [(4, 1, False)]
    assert by[3] == by[4][:0] + [(0, 3, True)] and by[5] == [(0, 5, True)]
    assert by[None] == [(1, None, True)] * 2
    assert len(by[8]) == 2 and by[7] == [(1, 7, True)]
    assert near_dedup.near_duplicates(none).count() == 0
    kept = near_dedup.without_near_copies(odd)
    assert kept.columns == odd.columns and 2 not in {r["doc_id"] for r in kept.collect()}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    found = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return {i: (min(g), len(g), i == min(g)) for g in groups.values() for i in g}


@pytest.mark.parametrize("weak", [False, True])
def test_exact_duplicates_equal_brute_force(spark, weak):
    """With a digest of two values nearly all hits differ, and the comparison of full texts has to tell them apart."""
    docs = texts_of(spark)
    digest = (lambda text: (F.crc32(text.cast("binary")) % 2).cast("string")) if weak else exact_dedup.sha256
    found = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_duplicates(docs, digest).collect()}
    assert found == brute_exact([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_exact_duplicates_of_odd_rows(spark, odd, none):
    rows = exact_dedup.exact_duplicates(odd).collect()
    assert len(rows) == odd.count()
    first = [r for r in rows if r["doc_id"] == 1]
    assert [r["group_size"] for r in first] == [2, 2] and sorted(r["kept"] for r in first) == [False, True]
    unnamed = [r for r in rows if r["doc_id"] is None]
    assert [r["keep_id"] for r in unnamed] == [None, None] and sum(r["kept"] for r in unnamed) == 1
    assert {r["doc_id"]: r["keep_id"] for r in rows if r["doc_id"] in (3, 4, 5)} == {3: 3, 4: 3, 5: 5}
    assert exact_dedup.exact_duplicates(none).count() == 0
    kept = exact_dedup.without_copies(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r["kept"] for r in rows)


def test_state_continues_over_batches(spark, tmp_path):
    """What came in an earlier run is known to a later one."""
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "stream")
    schema = "doc_id long, digest string, file string, row long"
    for rows in ([(5, "x", "f", 0), (6, "y", "f", 1)], [(2, "x", "g", 0), (9, "y", "g", 1)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
        exact_dedup.run_stream(spark, folder, spark.createDataFrame([], schema).schema, checkpoint)
    state = {r["digest"]: (r["seen"], r["keep_id"], r["keep_file"]) for r in exact_dedup.read_state(spark, checkpoint).collect()}
    assert state == {"x": (2, 2, "g"), "y": (2, 6, "f")}


def test_shortened_sets_let_no_similar_set_go():
    import numpy as np

    draw = np.random.default_rng(4)
    for size in (40, 500, 520, 3000):
        base = np.unique(draw.integers(0, 2**64, size, np.uint64))
        sets = [np.unique(np.concatenate([base[draw.random(base.size) < share], draw.integers(0, 2**64, extra, np.uint64)]))
                for share in (0.3, 0.6, 0.75, 0.8, 0.9, 1.0) for extra in (1, size // 20, size // 4)]
        # the low 20 of the leading 32 bits alone vary in the second round, so shingles fall together
        for mask in (2**64 - 1, 2**52 - 1):
            check_shortened(base & np.uint64(mask), [s & np.uint64(mask) for s in sets], exact=mask == 2**64 - 1)


def check_shortened(base, sets, exact):
    import numpy as np

    base, sets = np.unique(base), [np.unique(s) for s in sets]
    small = [np.unique((s >> np.uint64(32)).astype("<u4")) for s in [base, *sets]]
    allowed = near_dedup.may_be_alike(small[0], base.size, small[1:], np.array([s.size for s in sets]))
    shared = np.array([np.intersect1d(base, s).size for s in sets])
    union = np.array([np.union1d(base, s).size for s in sets])
    alike = 100 * shared >= near_dedup.PERCENT * union
    assert alike.any() and allowed[alike].all()
    if exact:
        assert (allowed == alike).all()


def test_large_sets_equal_brute_force(spark):
    """Texts of thousands of words around the similarity, in one component only by links between large sets."""
    import random

    draw = random.Random(6)
    base = [f"w{draw.randrange(40_000)}" for _ in range(3000)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(draw.choice([20, 60, 85, 100, 130, 200])):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(words[:draw.choice([2400, 2700, 3000])])))
    sets = [{tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for _, t in rows]
    home = list(range(60))
    for a in range(60):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                old, new = max(home[a], home[b]), min(home[a], home[b])
                home = [new if h == old else h for h in home]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(frame).collect()}
    assert found == {i: (len(sets[i]), home[i]) for i in range(60)} and 1 < len(set(home)) < 60
