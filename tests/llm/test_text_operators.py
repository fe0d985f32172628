"""Quality rules, toxicity, URL filter, tokens, packing, sharding and token shards against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from odd_rows import labels, none, odd  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from usageloom.llm import (
    byte_tokens,
    packing,
    quality,
    sharding,
    token_shards,
    toxicity,
    url_filter,
)
from usageloom.llm.encoders import word_bpe

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN


def table(spark, name, folder=MEDIUM):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# quality rules

def brute_counts(text):
    text = text or ""
    words = words_of(text)
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {p + k for at in windows.values() if len(at) > 1 for p in at for k in range(8)}
    lines = [x for x in text.split("\n") if words_of(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def spark_hash(*values):
    """xxhash64 of Spark, seed 42: each value is hashed with the hash so far as its seed."""
    from xxhash import xxh64_intdigest

    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else int(v).to_bytes(8, "little", signed=True)
        seed = xxh64_intdigest(data, seed)
    return signed(seed)


def grams(text):
    hashes = [spark_hash(w) for w in words_of(text)]
    pairs = [spark_hash(a, b) for a, b in zip(hashes, hashes[1:])]
    return [h % quality.BUCKETS for h in hashes + pairs]


def test_quality_equals_brute_force(spark):
    docs, marks = table(spark, "documents", SMALL), table(spark, "labels", SMALL)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in marks.collect() if r["quality"] == 1}
    raw, trusted = collections.Counter(), collections.Counter()
    for i, t in texts.items():
        g = grams(t)
        raw.update(g)
        if i in good:
            trusted.update(g)
    b = quality.BUCKETS
    ratio = [math.log((trusted[i] + 1) / (sum(trusted.values()) + b)) - math.log((raw[i] + 1) / (sum(raw.values()) + b))
             for i in range(b)]
    rows = quality.quality_report(docs, marks).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r["doc_id"]]
        counts = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert counts == brute_counts(t)
        g = grams(t)
        score = sum(ratio[i] for i in g) / max(1, len(g))
        assert r["score"] == pytest.approx(score, abs=1e-9)
        if abs(score - quality.THRESHOLD) > 1e-9:
            assert r["kept"] == (not r["base_failed"] and score >= quality.THRESHOLD)


def test_quality_keeps_good_documents_and_rejects_junk(spark):
    docs, marks = table(spark, "documents"), table(spark, "labels")
    rows = quality.quality_report(docs, marks).filter("NOT base_failed").join(marks, "doc_id").collect()
    kept = {q: [r["kept"] for r in rows if r["quality"] == q] for q in (0, 1)}
    assert np.mean(kept[1]) > 0.99 and np.mean(kept[0]) < 0.3


def test_repeated_windows_of_words(spark):
    text = "a b c d e f g h " * 3 + "x " + "p q r s t u v w y p q r s t u v w"
    frame = spark.createDataFrame([(1, text), (2, "z " * 9)], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, quality int")
    found = {r["doc_id"]: r["n_repeat_words"] for r in quality.quality_report(frame, marks).collect()}
    assert found == {1: brute_counts(text)[4], 2: 9}


def test_quality_of_odd_rows(spark, odd, none, labels):  # noqa: F811
    rows = quality.quality_report(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] in (3, 4, 5, None))
    kept = quality.kept_documents(odd, labels)
    assert kept.columns == odd.columns and kept.count() == sum(r["kept"] for r in rows)
    assert quality.quality_report(none, labels).count() == 0


# toxicity

def test_toxicity_on_held_out_rows(spark):
    docs, marks = table(spark, "documents", "/root/testdata/sf0.1"), table(spark, "labels", "/root/testdata/sf0.1")
    rows = toxicity.toxicity_scores(docs, marks).join(marks, "doc_id").filter("held_out").collect()
    for r in rows[:50]:
        assert zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
    right = [(r["predicted"], r["toxic"]) for r in rows]
    hits = sum(p and t for p, t in right)
    assert hits / sum(t for _, t in right) > 0.9, "recall"
    assert hits / max(1, sum(p for p, _ in right)) > 0.9, "precision"
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_toxicity_of_odd_rows(spark, odd, none, labels):  # noqa: F811
    rows = toxicity.toxicity_scores(odd, labels).collect()
    assert len(rows) == odd.count() and len({r["score"] for r in rows if r["doc_id"] in (3, 4)}) == 1
    kept = toxicity.clean_documents(odd, labels)
    assert kept.columns == odd.columns
    assert toxicity.toxicity_scores(none, labels).count() == 0
    unlabelled = labels.limit(0)
    assert {r["predicted"] for r in toxicity.toxicity_scores(odd, unlabelled).collect()} == {0}


# URL filter

URLS = [
    (1, "https://www.example.org/es/1", "example.org/es/", "block"),
    (2, "https://a.example.org/en/17", "example.org/en/1", "block"),
    (3, "http://A.Example.ORG/en/2?x=/es/", "org/", "allow"),
    (4, "http://notexample.org", None, None),
    (5, "ftp://x.com/fr/1#/de/", "com/fr/", "allow"),
    (6, "ftp://x.com/de/1", "com/de/", "block"),
    (7, None, None, None),
    (8, "no separator", None, None),
    (9, "http://h://p/q", None, None),
    (9, "http://h://p/q", None, None),
    (10, "", None, None),
    (11, "http://example.org.com/es/", None, None),
]


def test_url_rules_and_parts(spark):
    frame = spark.createDataFrame([(i, u, "mine", "mine") for i, u, _, _ in URLS],
                                  "page_id long, url string, host string, verdict string")
    rows = url_filter.url_verdicts(frame, url_filter.labelled_urls(spark)).collect()
    assert len(rows) == len(URLS)
    by = {r["page_id"]: r for r in rows}
    for i, _, rule, verdict in URLS:
        assert by[i]["rule"] == rule and by[i]["verdict"] in ("allow", "block")
        assert verdict is None or by[i]["verdict"] == verdict
    assert (by[3]["host"], by[3]["path"]) == ("a.example.org", "/en/2")
    assert (by[9]["host"], by[9]["path"]) == ("h:", "//p/q")
    assert (by[7]["host"], by[7]["path"], by[8]["host"]) == ("", "", "")
    assert url_filter.url_verdicts(frame.limit(0), url_filter.labelled_urls(spark)).count() == 0
    one_kind = url_filter.labelled_urls(spark).filter("label = 1")
    assert {r["verdict"] for r in url_filter.url_verdicts(frame.filter("page_id > 6"), one_kind).collect()} == {"allow"}


# tokens

def test_byte_tokens_equal_the_rank_library(spark):
    import tiktoken

    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_tokens.byte_bpe(RANKS, PATTERN).ranks,
                              special_tokens={})
    docs = table(spark, "documents")
    found = {r["doc_id"]: r for r in byte_tokens.token_digests(docs, RANKS, PATTERN).collect()}
    for r in docs.collect():
        ids = np.array(other.encode_ordinary(r["text"]), "<u4")
        got = found[r["doc_id"]]
        assert got["n_tokens"] == ids.size and got["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_byte_tokens_of_odd_rows(spark, odd, none):  # noqa: F811
    encoded = byte_tokens.encode_documents(odd, RANKS, PATTERN)
    decoded = byte_tokens.decode_documents(encoded, RANKS, PATTERN)
    texts = collections.Counter(r["text"] or "" for r in odd.collect())
    assert collections.Counter(r["text"] for r in decoded.collect()) == texts
    row = encoded.filter("doc_id = 6").first()
    text = "é ü 日本語 😀 \x1c x"
    table_ = byte_tokens.token_bytes(RANKS, PATTERN)
    assert row["byte_starts"][-1] + len(table_[row["ids"][-1]]) == len(text.encode())
    for i, span in zip(row["ids"], row["offsets"]):
        assert table_[i].decode("utf-8", "ignore").strip() in text[span["start"]:span["end"]]
    assert byte_tokens.token_digests(none, RANKS, PATTERN).count() == 0
    assert byte_tokens.token_digests(odd, RANKS, PATTERN).count() == odd.count()


def test_characters_split_over_ids_wait_for_their_last_byte():
    table_ = byte_tokens.token_bytes(RANKS, PATTERN)
    ids = [table_.index(bytes([b])) for b in "a😀é".encode()]
    decoder = byte_tokens.StreamDecoder(table_)
    assert [decoder.push(i) for i in ids] == ["a", "", "", "", "😀", "", "é"] and decoder.end() == ""
    half = byte_tokens.StreamDecoder(table_)
    assert half.push(ids[1]) == "" and half.end() == "\ufffd"


@pytest.mark.parametrize("text", ["İstanbul Σ Σ", "a\x1cb", "<|endoftext|> x", "it's 12a'll", "é ́", " \n", "A" * 70 + "."])
def test_word_units_equal_the_whole_encoder(text):
    encoder = word_bpe(WORDS)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


# packing

def check_packing(rows, capacity):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_of_whole_documents(spark):
    marked = "a <|endoftext|>b <|startoftext|> <|EndOfText|> end"
    docs = table(spark, "documents").withColumn("text", F.when(F.col("doc_id") % 50 == 3, F.lit(marked)).otherwise(F.col("text")))
    rows = packing.pack_documents(docs, WORDS).collect()
    plain = Tokenizer.from_file(WORDS)
    expected = {}
    for r in docs.collect():
        ids = plain.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            expected[r["doc_id"], k] = (at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected
    least = -(-sum(r["length"] for r in rows) // 4096)
    assert check_packing(rows, 4096) <= least * 1.01 + 1


def test_plan_holds_the_histogram_and_nearly_fills():
    draw = np.random.default_rng(4)
    lengths = np.minimum(4096, np.exp(draw.normal(6.2, 1.1, 60_000)).astype(int) + 2)
    histogram = dict(collections.Counter(lengths.tolist()))
    uses = packing.plan(histogram)
    held = collections.Counter()
    for use in uses:
        assert sum(use.lengths) <= 4096
        for x in use.lengths:
            held[x] += use.times
    assert held == histogram
    assert sum(u.times for u in uses) <= math.ceil(lengths.sum() / 4096) * 1.003
    assert packing.plan({}) == []


def test_dearest_configuration_equals_brute_force():
    lengths, prices = np.array([3, 5, 7]), np.array([2.9, 5.2, 7.1])
    best = max((sum(n * p for n, p in zip(c, prices)) for c in np.ndindex(8, 5, 4) if np.dot(c, lengths) <= 22))
    found = packing.dearest(prices, lengths, 22)
    assert sum(prices[lengths.tolist().index(x)] for x in found) == pytest.approx(best) and sum(found) <= 22


def test_packing_of_odd_rows(spark, odd, none):  # noqa: F811
    rows = packing.pack_documents(odd, WORDS, 64).collect()
    check_packing(rows, 64)
    assert sum(r["doc_id"] == 1 for r in rows) == 2 and [r["length"] for r in rows if r["doc_id"] in (3, 4, 5)] == [1] * 3
    assert packing.pack_documents(none, WORDS).count() == 0
    whole = packing.packed_sequences(odd, WORDS, 64).collect()
    assert sum(len(r["ids"]) // 4 for r in whole) == sum(r["length"] for r in rows)


# sharding

def check_places(rows, shards):
    for s in range(shards):
        places = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert places == list(range(len(places)))


def test_shards_are_near_equal_in_bytes(spark, tmp_path):
    docs = table(spark, "documents", "/root/testdata/sf0.1")
    rows = sharding.shard_documents(docs, str(tmp_path / "map")).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 8, zlib.crc32(texts[r["doc_id"]]))
    check_places(rows, 24)
    sizes = collections.Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert set(sizes) == set(range(24)) and max(sizes.values()) / min(sizes.values()) < 1.01
    one, two = (sharding.read_map(spark, str(tmp_path / "map"), v).collect() for v in (1, 2))
    moved = sum(dict((r["slot"], r["shard"]) for r in one)[r["slot"]] != r["shard"] for r in two)
    assert len(one) == len(two) == sharding.SLOTS and moved < sharding.SLOTS / 4
    placed = {r["slot"]: r["shard"] for r in two}
    assert all(placed[r["virtual_slot"]] == r["shard"] for r in rows)


def test_growth_moves_slots_only_into_the_new_shard():
    draw = np.random.default_rng(9)
    sizes = {s: (1, int(x)) for s, x in enumerate(draw.integers(1, 5000, 2000))}
    now = sharding.rebalanced(sharding.first_map(sizes, 2000, 8), 8)
    more = sharding.grown(now)
    assert all(b[2] in (a[2], 8) for a, b in zip(now, more)) and more[0][0] == 3
    totals = np.bincount([r[2] for r in more], [r[4] for r in more])
    assert totals.max() / totals.min() < 1.1


def test_sharding_of_odd_rows(spark, odd, none, tmp_path):  # noqa: F811
    rows = sharding.shard_documents(odd, str(tmp_path / "a")).collect()
    assert len(rows) == odd.count() and {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {8}
    check_places(rows, 24)
    assert sharding.shard_documents(none, str(tmp_path / "b")).count() == 0
    sharding.write_shards(odd, str(tmp_path / "a"), 2, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == odd.count()


# token shards

def test_feistel_is_a_permutation(spark):
    for total in (1, 2, 5, 1000, 5000):
        rows = token_shards.slots(spark.range(total).withColumnRenamed("id", "number"), total)
        assert sorted(r["slot"] for r in rows.collect()) == list(range(total))
    a, b = ([r["slot"] for r in token_shards.slots(spark.range(500).withColumnRenamed("id", "number"), 500, k)
             .orderBy("number").collect()] for k in (1, 2))
    assert a != b and a != sorted(a)


@pytest.mark.parametrize("folder_of", [SMALL, MEDIUM])
def test_documents_read_back_whole_from_the_shards(spark, tmp_path, folder_of):
    docs = table(spark, "documents", folder_of).repartition(3)
    folder = f"file://{tmp_path}/shards"
    rows = token_shards.materialise(docs, WORDS, folder, per_shard=64).collect()
    plain = Tokenizer.from_file(WORDS)
    slots = {r["slot"]: r for r in rows}
    assert sorted(slots) == list(range(len(slots)))
    assert sum(r["n_tokens"] < 512 for r in slots.values()) <= 3, "only the last sequence of a task is filled up"
    found = collections.defaultdict(list)
    stored = list(token_shards.read_slots(folder, 0, len(slots), per_shard=64))
    for slot, ids in enumerate(stored):
        r = slots[slot]
        assert r["shard"] == slot // 64 and r["byte_offset"] == slot % 64 * 1024 and set(ids[r["n_tokens"]:].tolist()) <= {1}
        assert r["ids_crc32"] == zlib.crc32(ids[:r["n_tokens"]].tobytes())
    covered = collections.Counter()
    for r in rows:
        found[r["doc_id"]].append((r["start"], stored[r["slot"]][r["offset"]:r["offset"] + r["length"]].tolist()))
        covered[r["slot"]] += r["length"]
    assert covered == {s: r["n_tokens"] for s, r in slots.items()}
    expected = {r["doc_id"]: plain.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in docs.collect()}
    assert set(found) == set(expected)
    for doc_id, parts in found.items():
        joined = []
        for start, ids in sorted(parts):
            assert start == len(joined)
            joined += ids
        assert joined == expected[doc_id]
    resumed = list(token_shards.read_slots(folder, 60, 10, per_shard=64))
    assert len(resumed) == 10 and (resumed[5] == stored[65]).all()


def test_token_shards_of_odd_rows(spark, odd, none, tmp_path):  # noqa: F811
    rows = token_shards.materialise(odd, WORDS, f"file://{tmp_path}/odd").collect()
    assert sum(r["doc_id"] in (3, 4, 5) and r["length"] == 1 for r in rows) == 3
    assert sum(r["doc_id"] is None for r in rows) == 2 and sum(r["doc_id"] == 1 and r["start"] == 0 for r in rows) == 2
    long = [r for r in rows if r["doc_id"] == 7]
    assert sum(r["length"] for r in long) == 30_001
    assert token_shards.materialise(none, WORDS, f"file://{tmp_path}/none").count() == 0


def test_every_shard_is_a_partition_of_its_own(spark):
    rows = spark.range(0, 40_000, 1, 5).select(
        F.col("id").alias("slot"), F.lit(0).alias("n_tokens"), F.lit(b"").alias("ids"), F.expr(f"cast(array() as array<{token_shards.SPAN}>)").alias("spans"))
    ranged = rows.withColumn("shard", F.floor(F.col("slot") / 8).cast("int"))
    dealt = ranged.repartitionById(5000, "shard").select("shard", F.spark_partition_id().alias("p"))
    assert dealt.filter("shard <> p").isEmpty() and dealt.select("p").distinct().count() == 5000


def test_a_stream_is_cut_alike_however_it_comes():
    draw = np.random.default_rng(9)
    documents = [(i if i % 7 else None, draw.integers(2, 9, draw.integers(1, 40)).astype("<u2")) for i in range(60)]
    whole = token_shards.Stream(8)
    for d in documents:
        whole.add(*d)
    expected = whole.cut(last=True).to_pylist()
    for every in (1, 7):
        stream, out = token_shards.Stream(8), []
        for k, d in enumerate(documents):
            stream.add(*d)
            if k % every == 0:
                out += stream.cut().to_pylist()
        assert [r["ids"] for r in out + stream.cut(last=True).to_pylist()] == [r["ids"] for r in expected]
        assert stream.size == 0 and stream.documents == []
    for r in expected:
        assert sum(x["length"] for x in r["spans"]) == r["n_tokens"] == len(r["ids"]) // 2


@pytest.mark.parametrize("sizes", [[], [1], [8], [512] * 5, [512, 7, 0, 1, 513, 8]])
def test_packed_ids_unpack_to_the_same(sizes):
    draw, sizes = np.random.default_rng(9), np.array(sizes, np.int32)
    common = draw.permutation(300)[:256].astype("<u2")
    for most in (200, 1 << 16):
        ids = draw.integers(0, most, sizes.sum()).astype("<u2")
        for table in (common, common[:3]):
            rows = token_shards.pack(ids, sizes, table)
            assert len(rows) == len(sizes) and (token_shards.unpack(rows, sizes, table) == ids).all()
            rare = [~np.isin(x, table) for x in np.split(ids, np.cumsum(sizes)[:-1])] if len(sizes) else []
            assert [len(r) for r in rows] == [-(-x.size // 8) + x.size + x.sum() for x in rare]


def test_sequences_are_stored_and_moved_in_fewer_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_shards, "shared_folder", lambda _, purpose: f"file://{tmp_path}/{purpose}")
    docs = table(spark, "documents").repartition(3)
    rows = token_shards.materialise(docs, WORDS)
    ids = rows.agg(F.sum("length")).first()[0]
    stored = spark.read.parquet(f"file://{tmp_path}/token-shards/sequences").agg(F.sum("n_tokens"), F.sum(F.octet_length("ids"))).first()
    assert stored[0] == ids and stored[1] < 0.75 * 2 * ids
    assert sum(p.stat().st_size for p in tmp_path.glob("token-shards/shards/*.bin")) >= 2 * ids, "shards hold plain ids"


def test_the_first_documents_decide_no_result(spark, tmp_path):
    docs = spark.createDataFrame(
        [(0, "zebra quartz")] * 300 + [(1, "the cat sat on the mat " * 400), (2, None)], "doc_id long, text string").coalesce(1)
    common = token_shards.common_ids(docs, WORDS)
    assert len(set(common.tolist())) == token_shards.COMMON
    indexes = []
    for k, known in enumerate((None, common)):
        rows = token_shards.cut_sequences(docs, WORDS, common=known).withColumn("slot", F.monotonically_increasing_id())
        indexes.append(token_shards.write_shards(rows, 8, f"file://{tmp_path}/{k}", common=known).orderBy("slot").collect())
    assert indexes[0] == indexes[1] and sum(len(r["spans"]) for r in indexes[0]) > 300
    one, two = ((tmp_path / f"{k}/shard-00000000.bin").read_bytes() for k in (0, 1))
    assert one == two


def test_a_repeated_run_leaves_whole_shards_alone(spark, tmp_path):
    import os

    docs = table(spark, "documents", SMALL).orderBy("doc_id").coalesce(1)
    rows = token_shards.cut_sequences(docs, WORDS).withColumn("slot", F.monotonically_increasing_id())
    rows = rows.persist()
    folder = f"file://{tmp_path}/s"
    total = token_shards.write_shards(rows, rows.count(), folder, per_shard=64).count()
    names = sorted(os.listdir(tmp_path / "s"))
    before = [os.stat(tmp_path / "s" / n).st_mtime_ns for n in names]
    os.truncate(tmp_path / "s" / "shard-00000001.ok", 3)
    assert token_shards.write_shards(rows, total, folder, per_shard=64).count() == total
    after = [os.stat(tmp_path / "s" / n).st_mtime_ns for n in names]
    changed = {n for n, a, b in zip(names, before, after) if a != b}
    assert changed == {"shard-00000001.bin", "shard-00000001.ok"} and sorted(os.listdir(tmp_path / "s")) == names
