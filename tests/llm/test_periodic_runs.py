"""Periodic runs against a brute-force scan of every lag and every place."""

import hashlib
import random
import re
import zlib

from odd_rows import none, odd  # noqa: F401

from usageloom.llm import periodic_runs, queries

SMALL = "/root/testdata/sf0.001"


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[:len(words) - q])


def brute_runs(words, least=6, times=4):
    n, out = len(words), set()
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                out.add((i, j + q - i, smallest_period(words[i:j + q])))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_equal_brute_force_on_texts_of_few_words():
    rng = random.Random(12)
    seen = 0
    for _ in range(600):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(0, 100))]
            for _ in range(rng.randint(0, 3)):
                if words:
                    a, p = rng.randrange(len(words)), rng.randint(1, 12)
                    for i in range(a + p, min(len(words), a + rng.randint(1, 60))):
                        words[i] = words[i - p]
            texts.append(words)
        want = [brute_runs(t) for t in texts]
        assert periodic_runs.text_runs(texts) == want
        seen += sum(map(len, want))
    assert seen > 500


def test_other_lengths_and_repetitions():
    words = [b"a", b"b"] * 3 + [b"c"] + [b"d"] * 5
    assert periodic_runs.text_runs([words], least=4, times=2) == [brute_runs(words, 4, 2)]
    assert periodic_runs.text_runs([words], least=4, times=3) == [brute_runs(words, 4, 3)]


def test_segments_hold_no_rare_word_and_cover_all_runs():
    words = "x a b a b a b a b y a b a b c c c c c c".split()
    numbers = periodic_runs.Numbers()
    import numpy as np
    ids = np.array([numbers[w] for w in words])
    assert periodic_runs.segments(ids, np.array([0, len(words)])) == [(1, 9), (14, 20)]


def test_a_long_text_of_one_word_and_a_long_period():
    assert periodic_runs.text_runs([[b"w"] * 200_000, [b"%d" % (i % 4000) for i in range(16_500)], [b"w"] * 5]) == [
        [(0, 200_000, 1)], [(0, 16_500, 4000)], []]


def test_whole_table_equals_brute_force(spark):
    got = sorted(map(tuple, queries.op12_periodic_runs(spark, SMALL).collect()))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    short = [r for r in docs if len(r["text"] or "") < 12_000]
    want = {r["doc_id"]: brute_row(r["doc_id"], r["text"]) for r in short}
    assert len(got) == len(docs) and len(want) > 150
    assert [r for r in got if r[0] in want] == sorted(want.values())
    assert any(r[1] for r in got)


def test_odd_rows(spark, odd, none):  # noqa: F811
    got = sorted(map(tuple, periodic_runs.run_digests(periodic_runs.periodic_runs(periodic_runs.with_planted_runs(odd))).collect()), key=str)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = sorted([brute_row(*r) if len(r[1] or "") < 10_000 else None for r in rows if r[0] != 7], key=str)
    assert [r for r in got if r[0] != 7] == want
    long = next(r for r in got if r[0] == 7)
    assert long[1] == 1 and long[4] == 1 and long[3] == 30_000
    assert periodic_runs.run_digests(periodic_runs.periodic_runs(none)).count() == 0


def test_the_operator_returns_spans_and_texts(spark):
    docs = spark.createDataFrame([(1, "go a b a b a b a b on"), (2, None)], "doc_id long, text string")
    one, two = sorted(periodic_runs.periodic_runs(docs).collect())
    assert [tuple(r) for r in one["runs"]] == [(1, 8, 2)] and one["collapsed"] == "go a b on" and one["n_words"] == 10
    assert two["runs"] == [] and two["collapsed"] == "" and two["n_words"] == 0
