"""SimHash components against brute force over all pairs, and the plan of partitions against its own promise."""

import re
from itertools import combinations

import numpy as np
from odd_rows import none, odd  # noqa: F401
from xxhash import xxh64_intdigest

from usageloom.llm import queries, simhash_links

MEDIUM = "/root/testdata/sf0.01"


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values):
    """For each distinct value the set of values it reaches in steps of 3 bits or fewer."""
    values = list(set(values))
    home = {v: {v} for v in values}
    for a, b in combinations(values, 2):
        if (a ^ b).bit_count() <= 3 and home[a] is not home[b]:
            home[a] |= home[b]
            for v in home[b]:
                home[v] = home[a]
    return home


def brute_rows(rows):
    marks = [(doc_id, brute_fingerprint(text)) for doc_id, text in rows]
    home = brute_components([m for _, m in marks])
    names = lambda m: [d for d, o in marks if o in home[m] and d is not None]
    return sorted([(d, f"{m:016x}", min(names(m), default=None)) for d, m in marks], key=str)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.op13_simhash_near_dedup(spark, MEDIUM).collect()), key=str)
    want = brute_rows(docs)
    assert got == want
    assert len({r[2] for r in want}) < len(want)


def test_odd_rows(spark, odd, none):  # noqa: F811
    got = sorted(map(tuple, simhash_links.simhash_report(odd).collect()), key=str)
    assert got == brute_rows([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert simhash_links.simhash_report(none).count() == 0


def test_a_document_without_words_is_linked_with_fingerprints_near_zero(spark, monkeypatch):
    rows = spark.createDataFrame([(5, 0), (3, 0), (4, 7), (9, 7 | 7 << 20), (1, -1)], "doc_id long, bits long")
    monkeypatch.setattr(simhash_links, "fingerprints", lambda docs: docs)
    assert sorted(map(tuple, simhash_links.simhash_components(rows).select("doc_id", "component_id").collect())) == [
        (1, 1), (3, 3), (4, 3), (5, 3), (9, 3)]


def crowd(seed, size):
    """Fingerprints some bits away from a few centres, and others anywhere."""
    draw = np.random.default_rng(seed)
    middle = draw.integers(0, 2**64, 3, np.uint64)
    out = list(draw.integers(0, 2**64, size // 4, np.uint64))
    while len(out) < size:
        bits = draw.choice(64, draw.integers(0, 9), replace=False)
        out.append(np.bitwise_xor.reduce(np.uint64(1) << bits.astype(np.uint64), initial=middle[len(out) % 3]))
    return np.unique(np.array(out, np.uint64))


def test_every_pair_within_the_distance_shares_a_key():
    marks = crowd(1, 600)
    pairs = [(a, b) for a, b in combinations(marks.tolist(), 2) if (a ^ b).bit_count() <= 3]
    assert len(pairs) > 50
    for classes in (600, 10**6, 10**8, 10**10):
        masks = simhash_links.key_masks(marks, classes)
        assert all(any(a & m == b & m for m in masks) for a, b in pairs)


def test_a_larger_corpus_gets_fewer_wider_partitions():
    marks = np.random.default_rng(3).integers(0, 2**64, 1000, np.uint64)
    sizes = [max(m.bit_count() for m in simhash_links.key_masks(marks, n)) for n in (10**5, 10**8, 10**11)]
    assert sizes == sorted(sizes) and sizes[0] < sizes[-1]


def test_thresholds_are_the_cheapest_by_enumeration():
    from itertools import product

    draw = np.random.default_rng(4)
    for groups in (1, 2, 3, 4):
        costs = draw.integers(1, 100, (groups, 4)).tolist()
        cost, chosen = simhash_links.thresholds(costs)
        all_plans = [p for p in product(range(-1, 4), repeat=groups) if sum(t + 1 for t in p) == 4]
        price = {p: sum(c[t] for c, t in zip(costs, p, strict=True) if t >= 0) for p in all_plans}
        assert cost == min(price.values()) == price[tuple(chosen)]


def test_bits_that_go_together_share_a_partition():
    draw = np.random.default_rng(5)
    marks = draw.integers(0, 2**64, 2000, np.uint64)
    bit = marks & np.uint64(1)
    for b in (17, 40, 63):
        marks = marks & ~np.uint64(1 << b) | bit << np.uint64(b)
    parts = simhash_links.bit_groups(marks, 4)
    assert sorted(sum(parts, [])) == list(range(64)) and [len(p) for p in parts] == [16] * 4
    assert any({0, 17, 40, 63} <= set(p) for p in parts)


def test_large_groups_are_split_and_stay_whole(spark):
    """Groups of some 1,000 classes with a bound of 40: quarters and blocks are both reached."""
    marks = crowd(2, 3000)
    frame = spark.createDataFrame([(int(m),) for m in marks.view(np.int64)], "bits long")
    home = brute_components(marks.tolist())
    for group in (40, 4096):
        links = simhash_links.class_links(frame, marks.size, group).collect()
        joined = {m: {m} for m in marks.tolist()}
        for a, b in links:
            a, b = a % 2**64, b % 2**64
            assert (a ^ b).bit_count() <= 3
            if joined[a] is not joined[b]:
                joined[a] |= joined[b]
                for v in joined[b]:
                    joined[v] = joined[a]
        assert joined == home


def test_a_forest_names_one_link_a_class():
    marks = np.unique(np.concatenate([crowd(6, 900)[:50], np.uint64(1) << np.arange(64, dtype=np.uint64)]))
    a, b = simhash_links.forest(marks)
    assert np.unique(b).size == b.size < marks.size
