"""Near-duplicates by 64-bit SimHash fingerprints and the general pigeonhole principle.

A fingerprint bit is 1 where over half of a text's word shingles, repeats included,
have that bit in their XXH64 (seed 42). Two fingerprints are linked where they
differ in ``DISTANCE`` bits or fewer; every such pair is found.

1. Texts of one fingerprint are one class; only classes go on.
2. The 64 bits are cut into partitions. Bits that go together in a sample of
   classes (``SAMPLE``, those that hash lowest) share a partition, so what the
   corpus has in common is spent in one place. Partition i gets a threshold t_i of
   -1 (not used) or more. If the sum of (t_i + 1) is DISTANCE + 1, a pair within the
   distance is within t_i on some partition: else it would differ in at least
   sum (t_i + 1) bits. Which thresholds, and how many partitions, is a dynamic
   program over the estimated cost: keys to move, and classes that meet by chance,
   counted in the sample and never taken for less than uniform bits would give. So
   a larger corpus gets fewer, wider partitions with larger thresholds.
3. A class has one key for each choice of t_i bits left out of partition i. Two
   classes within t_i there share a key.
4. The classes of a key are compared in one task, which names a spanning forest of
   the pairs within the distance, at most one link a class for large groups: that
   keeps every component and never emits all pairs. A key of over ``GROUP`` classes is
   keyed anew by quarters of the bits, each quarter with its share of the bits that
   vary within that key (a pair within 3 bits agrees on one of four quarters); what is
   still too large after ``LEVELS`` such steps is compared block against block.
5. Components of the links; a component's name is its smallest doc_id.

The sample sets only how much work is done, not what is found. The driver gets the
sample and the number of classes; keys, links and components stay in the executors.

Defined cases: a text without words has the fingerprint zero and is linked like any
other; one with fewer words than a shingle is one shingle; rows that share a doc_id
are placed one by one, each by its own text; a row without doc_id is placed as
any other and gives its component no name, so its component_id is null if no
document it reaches has an identifier; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageloom.llm.common import ship_code, text_or_empty, written
from usageloom.llm.components import components

BITS = 64
SHINGLE = 3
DISTANCE = 3
SEED = 42
SAMPLE = 2048
#: classes of one key compared in one task; a pair of blocks has twice as many
GROUP = 4096
LEVELS = 3
#: groups up to this size are compared together, shifted against themselves
FEW = 24
#: cost of moving one key, and of comparing two classes that meet
KEY_COST, PAIR_COST = 1.0, 0.02


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text's bytes, unsigned."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # on bytes both know ASCII only, as the contract says
    if not words:
        return 0
    width = min(SHINGLE, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    n = len(words) - width + 1
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, 1 << 14):
        rows = hashes[start:start + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, bits): the fingerprint of every row, as a signed 64-bit number."""
    ship_code(docs.sparkSession)

    def fold(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [fingerprint(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "bits"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(fold, "doc_id long, bits long")


# how the bits are cut

def bit_groups(sample: np.ndarray, groups: int) -> list[list[int]]:
    """The bits in ``groups`` partitions of almost equal size, bits that go together in the sample side by side."""
    bits = (sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    spread = bits.astype(np.float64) - bits.mean(axis=0)
    scale = np.sqrt((spread ** 2).sum(axis=0))
    scale[scale == 0] = 1
    together = np.abs(spread.T @ spread / np.outer(scale, scale))
    np.fill_diagonal(together, 0)
    left, out = list(range(BITS)), []
    for i in range(groups):
        size = len(left) // (groups - i)
        chosen = [max(left, key=lambda b: (together[b, left].sum(), -b))]
        while len(chosen) < size:
            rest = [b for b in left if b not in chosen]
            chosen.append(max(rest, key=lambda b: (together[b, chosen].sum(), -b)))
        left = [b for b in left if b not in chosen]
        out.append(sorted(chosen))
    return out


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def meetings(sample: np.ndarray, mask: int, width: int, classes: int) -> list[float]:
    """For each threshold 0 .. DISTANCE the expected number of times two of ``classes`` classes meet under a key."""
    part = sample & np.uint64(mask)
    seen = np.zeros(DISTANCE + 1)
    for i in range(1, part.size):
        near = np.bitwise_count(part[:i] ^ part[i])
        seen += np.bincount(near[near <= DISTANCE], minlength=DISTANCE + 1)
    pairs = classes * (classes - 1) / 2
    in_sample = max(1, part.size * (part.size - 1) / 2)
    out = []
    for t in range(DISTANCE + 1):
        by_chance = sum(comb(width, d) * comb(width - d, t - d) for d in range(t + 1)) / 2.0 ** width
        observed = sum(seen[d] * comb(width - d, t - d) for d in range(t + 1)) / in_sample
        out.append(pairs * max(by_chance, observed))
    return out


def thresholds(costs: list[list[float]], units: int = DISTANCE + 1) -> tuple[float, list[int]]:
    """The cheapest thresholds with sum (t_i + 1) = ``units``; ``costs[i][t]`` is the cost of threshold t on partition i."""
    best: list[tuple[float, list[int]] | None] = [(0.0, [])] + [None] * units
    for cost in costs:
        after: list[tuple[float, list[int]] | None] = [None] * (units + 1)
        for used, state in enumerate(best):
            if state is None:
                continue
            for more in range(min(len(cost), units - used) + 1):
                total = state[0] + (cost[more - 1] if more else 0.0)
                if after[used + more] is None or total < after[used + more][0]:
                    after[used + more] = (total, [*state[1], more - 1])
        best = after
    return best[units]


def key_masks(sample: np.ndarray, classes: int) -> list[int]:
    """The bits each key of a class keeps."""
    plans = []
    for groups in (1, 2, 3, 4):
        parts = bit_groups(sample, groups)
        costs = [[KEY_COST * classes * comb(len(p), t) + PAIR_COST * m
                  for t, m in enumerate(meetings(sample, mask_of(p), len(p), classes))] for p in parts]
        cost, chosen = thresholds(costs)
        plans.append((cost, parts, chosen))
    _, parts, chosen = min(plans, key=lambda p: p[0])
    return [mask_of(p) & ~mask_of(out) for p, t in zip(parts, chosen, strict=True) if t >= 0
            for out in combinations(p, t)]


# comparing the classes of a key

def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def few_links(keys: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within the distance of rows sorted by key, whose groups are of ``FEW`` rows at most."""
    for shift in range(1, min(FEW, keys.size)):
        near = (keys[shift:] == keys[:-shift]) & (np.bitwise_count(bits[shift:] ^ bits[:-shift]) <= DISTANCE)
        if near.any():
            yield bits[:-shift][near], bits[shift:][near]


def forest(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within the distance: each row is reached once, from a row nearest the tree's root."""
    froms, tos = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    open_ = bits
    while open_.size:
        waiting, open_ = [open_[:1]], open_[1:]
        while waiting and open_.size:
            front = waiting.pop()
            for at in front:
                near = np.bitwise_count(open_ ^ at) <= DISTANCE
                if near.any():
                    reached = open_[near]
                    froms.append(np.full(reached.size, at, np.uint64))
                    tos.append(reached)
                    waiting.append(reached)
                    open_ = open_[~near]
                    if not open_.size:
                        break
    return np.concatenate(froms), np.concatenate(tos)


def links_within(keyed: DataFrame) -> DataFrame:
    """(a, b) from the classes ``bits`` of each ``key``, which fit one task."""

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def linked(keys: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
            edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
            sizes = np.diff(edges)
            small = np.repeat(sizes <= FEW, sizes)
            found = list(few_links(keys[small], bits[small]))
            found += [forest(np.unique(bits[a:a + n])) for a, n in zip(edges[:-1], sizes, strict=True) if n > FEW]
            ends = [np.concatenate([np.zeros(0, np.uint64), *side]).view(np.int64) for side in zip(*found, strict=True)] or \
                [np.zeros(0, np.int64)] * 2
            return pa.RecordBatch.from_arrays([pa.array(e) for e in ends], names=["a", "b"])

        keys, bits = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            bits = np.concatenate([bits, batch.column("bits").to_numpy().view(np.uint64)])
            if not keys.size:
                continue
            whole = int(np.searchsorted(keys, keys[-1]))  # the last group may go on in the next batch
            if whole:
                yield linked(keys[:whole], bits[:whole])
                keys, bits = keys[whole:], bits[whole:]
        if keys.size:
            yield linked(keys, bits)

    dealt = keyed.select("key", "bits").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(compare, "a long, b long")


def with_size(keyed: DataFrame) -> DataFrame:
    """The rows whose key has another row, with the number ``n`` of rows of the key."""
    sizes = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "key-sizes")
    return keyed.join(sizes, "key")


def quartered(heavy: DataFrame) -> DataFrame:
    """Keys by quarters of the bits, the bits that vary within a key dealt to the quarters in turn."""
    one = F.lit(1).cast("long")
    counts = [F.sum(F.shiftrightunsigned("bits", b).bitwiseAND(one)).alias(f"b{b}") for b in range(BITS)]
    seen = heavy.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), *counts)
    order = F.sort_array(F.array(*[
        F.struct((-F.least(F.col(f"b{b}"), F.col("rows") - F.col(f"b{b}"))).alias("less"), F.lit(b).alias("b"))
        for b in range(BITS)]))
    masks = [F.expr(f"aggregate(filter(bits_of_key, (x, i) -> i % 4 = {q}), 0L, (m, x) -> m | shiftleft(1L, x.b))")
             for q in range(4)]
    dealt = seen.select("key", order.alias("bits_of_key")).select("key", F.array(*masks).alias("masks"))
    parts = heavy.select("key", "bits").join(dealt, "key").select(
        "key", "bits", F.posexplode("masks").alias("quarter", "mask"))
    return parts.select(F.xxhash64("key", "quarter", F.col("bits").bitwiseAND(F.col("mask"))).alias("key"), "bits")


def in_blocks(heavy: DataFrame, group: int) -> DataFrame:
    """Each key's classes in blocks of some ``group`` classes, every pair of blocks under a key of its own."""
    blocks = F.ceil(F.col("n") / group).cast("int")
    rows = heavy.select("key", "bits", blocks.alias("blocks"), F.pmod(F.xxhash64("bits"), blocks).cast("int").alias("mine"))
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "bits")


def class_links(classes: DataFrame, total: int, group: int = GROUP) -> DataFrame:
    """(a, b): links that join exactly the classes ``bits`` that chains of pairs within the distance join."""
    lowest = classes.orderBy(F.xxhash64("bits"), "bits").limit(SAMPLE).collect()
    sample = np.array([r["bits"] for r in lowest], np.int64).view(np.uint64)
    masks = F.array(*[F.lit(signed(m)).cast("long") for m in key_masks(sample, total)])
    slots = classes.select("bits", F.posexplode(masks).alias("slot", "mask"))
    keyed = slots.select(F.xxhash64("slot", F.col("bits").bitwiseAND(F.col("mask"))).alias("key"), "bits")
    links = None
    for level in range(LEVELS + 1):
        sized = written(with_size(keyed), "simhash-keys")
        part = links_within(sized.filter(F.col("n") <= group))
        links = part if links is None else links.unionByName(part)
        heavy = sized.filter(F.col("n") > group)
        if heavy.isEmpty():
            return links.distinct()
        keyed = quartered(heavy) if level < LEVELS else in_blocks(heavy, group)
    return links.unionByName(links_within(keyed)).distinct()


def simhash_components(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, bits (signed), component_id of every row."""
    rows = written(fingerprints(docs), "fingerprints")
    classes = written(rows.groupBy("bits").agg(F.min("doc_id").alias("first")), "simhash-classes")
    total = classes.count()
    if total < 2:
        placed = classes.select("bits", F.col("first").alias("component_id"))
    else:
        found = written(components(written(class_links(classes.select("bits"), total, group), "simhash-links")), "components")
        rooted = classes.join(found.withColumnRenamed("node", "bits"), "bits", "left").select(
            "bits", "first", F.coalesce("component", "bits").alias("root"))
        names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
        placed = written(rooted.join(names, "root").select("bits", "component_id"), "simhash-placed")
    # a fingerprint that a large part of all rows shares is a skewed key, which the join splits
    return rows.join(placed, "bits").select("doc_id", "bits", "component_id")


def fingerprint_hex(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def simhash_report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 lower-case hex digits, component_id."""
    return simhash_components(docs).select("doc_id", fingerprint_hex(F.col("bits")).alias("fingerprint"), "component_id")
