"""Near-duplicates by a multi-index Hamming join over b-bit MinHash signatures.

A document is its set of 5-word shingles. Its signature is ``SIZE`` MinHash
values of ``BITS`` bits; two sets of Jaccard similarity s differ in about
(1 - s) * SIZE of them. The join finds every pair that differs in at most
``DISTANCE`` values: the signature is cut into ``CHUNKS`` chunks, and as
DISTANCE < 2 * CHUNKS, some chunk of such a pair differs in one value at most
(pigeonhole). So each chunk is a key once per value left out, and such a pair
meets under at least one key. A pair of similarity 0.75 exceeds the distance
with a chance of some 1 in 1,000, one of 0.8 with 1 in 100,000.

1. Equal sets (one strong digest) are one class; only classes go on.
2. A key's first and last class are its leaders; every class of the key is
   tried against them. Pairs within the distance are confirmed on whole sets
   and components are formed.
3. Keys whose classes still lie in several components are compared within
   themselves, in blocks of bounded size, only across components. In the first
   ``ROUNDS`` rounds each class of a meeting names its nearest partner alone,
   which joins the components of a large group as fast as they can halve.
4. What lies apart then is compared in full: every pair within the distance is
   tried once, under the first key it shares. The blocks carry each class's whole
   set, 32 bits a shingle, so a pair is named only if these have the similarity, and
   confirmed. Shortened shingles never part what is equal, so no such pair is let go.

So a large group costs a star and a few rounds of one pair a class, not all its
pairs. A link between components is missed only by the signature's chance above.
Keys, pairs and components stay in the executors.

Defined cases: a text without words is linked with nothing; one with fewer
words than a shingle is one shingle; rows that share a doc_id are one document,
of the smallest text, and all get its result; rows with a null doc_id stand
alone and are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usageloom.llm.common import ship_code, text_or_empty, written
from usageloom.llm.components import components, joined

SHINGLE = 5
PERCENT = 75
SIZE, BITS = 48, 16
DISTANCE, CHUNKS = 21, 11
#: classes of one key compared in one task
BLOCK = 1500
ROUNDS = 3
NEAREST = 3
FOLDED = "doc_id long, n_shingles long, digest string, signature binary"


class WordHashes(dict):
    """Hash of a word's bytes, bounded."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= 250_000:
            self.clear()
        value = xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str, known: WordHashes) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = text.encode("utf-8", "replace").lower().split()  # on bytes both know ASCII only, as the contract says
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + out.size])
    return np.unique(out)


def permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    return draw.integers(1, 2**64, SIZE, np.uint64) | np.uint64(1), draw.integers(0, 2**64, SIZE, np.uint64)


def signature(shingles: np.ndarray, many: np.ndarray, shift: np.ndarray) -> np.ndarray:
    least = np.full(SIZE, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, shingles.size, 4096):
        part = shingles[start:start + 4096]
        least = np.minimum(least, (part[:, None] * many + shift).min(axis=0))
    return (mixed(least) >> np.uint64(64 - BITS)).astype("<u2")


def folded(docs: DataFrame) -> DataFrame:
    """Size, digest and signature of each row's set."""
    ship_code(docs.sparkSession)

    def fold(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known, (many, shift) = WordHashes(), permutations()
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column("text"):
                found = shingle_hashes(text.as_py(), known)
                sizes.append(found.size)
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest())
                signatures.append(signature(found, many, shift).tobytes() if found.size else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(signatures, pa.binary())], names=["doc_id", "n_shingles", "digest", "signature"])

    return docs.select("doc_id", "text").mapInArrow(fold, FOLDED)


def chunk_bounds() -> list[tuple[int, int]]:
    edges = np.linspace(0, SIZE, CHUNKS + 1).round().astype(int)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))


def keys_of(classes: DataFrame) -> DataFrame:
    """(key, slot, class): each chunk once per value left out; ``slot`` says which chunk and value."""

    def keys(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids = batch.column("class_id").to_numpy()
            if not ids.size:
                continue
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2").reshape(-1, SIZE).astype(np.uint64)
            found, slots = [], []
            for chunk, (a, b) in enumerate(chunk_bounds()):
                for out in range(a, b):
                    key = np.full(ids.size, chunk * SIZE + out + 1, np.uint64)
                    for i in range(a, b):
                        if i != out:
                            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + values[:, i])
                    found.append(key.astype(np.int64))
                    slots.append(np.full(ids.size, out, np.int16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found)), pa.array(np.concatenate(slots)), pa.array(np.tile(ids, len(found)))],
                names=["key", "slot", "class_id"])

    return classes.select("class_id", "signature").mapInArrow(keys, "key long, slot short, class_id long")


def first_slots(equal: np.ndarray) -> np.ndarray:
    """The first slot whose key two signatures share, for each row of equal values; -1 if there is none."""
    out = np.full(equal.shape[0], -1)
    for a, b in chunk_bounds():
        part = equal[:, a:b]
        off = (~part).sum(axis=1)
        free = (out < 0) & (off <= 1)
        out[free] = a + np.where(off[free] == 0, 0, (~part[free]).argmax(axis=1))
    return out


def short_sets(texts: DataFrame) -> DataFrame:
    """(class_id, n_shingles, shingles): the whole set, of each shingle the leading 32 bits, sorted."""

    def shortened(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = WordHashes()
        for batch in batches:
            sizes, found = [], []
            for text in batch.column("text"):
                shingles = shingle_hashes(text.as_py(), known)
                sizes.append(shingles.size)
                found.append(np.unique((shingles >> np.uint64(32)).astype("<u4")).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("class_id"), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())],
                names=["class_id", "n_shingles", "shingles"])

    return texts.select("class_id", "text").mapInArrow(shortened, "class_id long, n_shingles long, shingles binary")


def may_be_alike(mine: np.ndarray, size: int, others: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Whether each other set can have the similarity to mine; never false for one that has it.

    Two shingles of a set may fall together when shortened; as many may be missing from the shared ones.
    """
    lengths = np.array([o.size for o in others])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(mine, flat), mine.size - 1)
    shared = np.add.reduceat(mine[at] == flat, starts, dtype=np.int64)
    shared += (size - mine.size) + (sizes - lengths)
    return 100 * shared >= PERCENT * (sizes + size - shared)


def within_distance(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``a`` < ``b`` whose signatures differ in at most ``DISTANCE`` values."""
    left = classes.select(F.col("class_id").alias("a"), F.col("signature").alias("_left"))
    right = classes.select(F.col("class_id").alias("b"), F.col("signature").alias("_right"))

    def near(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column("_left").to_pylist()), "<u2").reshape(-1, SIZE)
                y = np.frombuffer(b"".join(batch.column("_right").to_pylist()), "<u2").reshape(-1, SIZE)
                keep = pa.array((x != y).sum(axis=1) <= DISTANCE)
                yield batch.select(["a", "b"]).filter(keep)

    return pairs.join(left, "a").join(right, "b").select("a", "b", "_left", "_right").mapInArrow(near, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose whole sets have 100 * intersection >= PERCENT * union."""
    left = texts.select(F.col("class_id").alias("a"), F.col("text").alias("_left"))
    right = texts.select(F.col("class_id").alias("b"), F.col("text").alias("_right"))

    def alike(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = WordHashes()
        last: tuple[int | None, np.ndarray | None] = (None, None)
        for batch in batches:
            keep = []
            columns = (batch.column(c) for c in ("b", "_left", "_right"))
            for b, x, y in zip(*columns, strict=True):
                if last[0] != b.as_py():
                    last = (b.as_py(), shingle_hashes(y.as_py(), known))
                one, two = shingle_hashes(x.as_py(), known), last[1]
                shared = np.intersect1d(one, two, assume_unique=True).size
                keep.append(100 * shared >= PERCENT * (one.size + two.size - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").mapInArrow(alike, "a long, b long")


def leader_pairs(met: DataFrame) -> DataFrame:
    """Every class of a shared key with the key's first and last class."""
    pairs = met.select("class_id", F.explode(F.array("first", "last")).alias("leader")).filter("class_id <> leader")
    return pairs.select(F.least("class_id", "leader").alias("a"), F.greatest("class_id", "leader").alias("b")).distinct()


def with_component(rows: DataFrame, found: DataFrame) -> DataFrame:
    return (rows.join(found.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
            .withColumn("component", F.coalesce("component", "class_id")))


def block_pairs(members: DataFrame, classes: DataFrame, nearest: bool = False,
                texts: DataFrame | None = None) -> DataFrame:
    """(a, b, distance) within the distance, across components, of each key's classes, block against block.

    ``nearest``: only one pair for each class of a meeting. Else every pair, once over all keys, and given
    ``texts`` only those whose shortened sets have the similarity.
    """
    with_sets = texts is not None
    sizes = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("least"), F.max("component").alias("most"))
    open_keys = written(sizes.filter("least <> most").select(
        "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "open-keys")
    mine = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    dealt = members.join(open_keys, "key").withColumn("block", mine).select(
        "key", "slot", "class_id", "component", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = dealt.select(
        "slot", "class_id", "component", "block",
        F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("meeting"),
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    signed = rows.join(classes.select("class_id", "signature"), "class_id")
    seen = ["meeting", "class_id", "component", "block", "low", "high", "signature", "slot"]
    if with_sets:
        compared_classes = members.join(open_keys, "key", "left_semi").select("class_id").distinct()
        signed = signed.join(short_sets(texts.join(compared_classes, "class_id", "left_semi")), "class_id")
        seen += ["n_shingles", "shingles"]

    def across(batches: Iterator) -> Iterator:
        """Rows come sorted by meeting; a meeting has two blocks' rows at most."""
        import pyarrow as pa

        def compared(rows: list) -> pa.RecordBatch:
            ids = np.array([r[0] for r in rows], np.int64)
            home = np.array([r[1] for r in rows], np.int64)
            side = np.array([r[2] == r[3] for r in rows])
            alone = rows[0][3] == rows[0][4]
            values = np.frombuffer(b"".join(r[5] for r in rows), "<u2").reshape(-1, SIZE)
            if with_sets:
                sizes = np.array([r[7] for r in rows], np.int64)
                shingles = [np.frombuffer(r[8], "<u4") for r in rows]
            out_a, out_b, out_d = [], [], []
            places = np.arange(ids.size)
            first = places if alone else places[side]
            second = places if alone else places[~side]
            for i in first:
                others = second if nearest or not alone else second[second > i]
                others = others[home[others] != home[i]]
                if not others.size:
                    continue
                equal = values[others] == values[i]
                away = SIZE - equal.sum(axis=1)
                if nearest:
                    best = int(away.argmin())
                    named = np.array([best] if away[best] <= DISTANCE else [], np.int64)
                else:
                    named = np.flatnonzero(away <= DISTANCE)
                    named = named[first_slots(equal[named]) == rows[0][6]]
                    if with_sets and named.size:
                        met = others[named]
                        named = named[may_be_alike(shingles[i], sizes[i], [shingles[m] for m in met], sizes[met])]
                hit = others[named]
                out_a.append(np.minimum(ids[hit], ids[i]))
                out_b.append(np.maximum(ids[hit], ids[i]))
                out_d.append(away[named])
            empty = np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([empty, *x]).astype(np.int64)) for x in (out_a, out_b, out_d)],
                names=["a", "b", "distance"])

        now, gathered = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in seen)
            for meeting, *row in zip(*columns, strict=True):
                if meeting != now and gathered:
                    yield compared(gathered)
                    gathered = []
                now = meeting
                gathered.append(row)
        if gathered:
            yield compared(gathered)

    sorted_rows = signed.repartition("meeting").sortWithinPartitions("meeting", "class_id").select(*seen)
    named = sorted_rows.mapInArrow(across, "a long, b long, distance long")
    return named.distinct() if nearest else named


def still_apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    ends = found.select("node", "component")
    placed = (pairs.join(ends.withColumnsRenamed({"node": "a", "component": "_ca"}), "a", "left")
              .join(ends.withColumnsRenamed({"node": "b", "component": "_cb"}), "b", "left"))
    return placed.filter(F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).select(*pairs.columns)


def nearest_only(pairs: DataFrame, most: int = NEAREST) -> DataFrame:
    """For each class the ``most`` nearest partners; the rest is confirmed later if it still matters."""
    ends = pairs.select(F.col("a").alias("end"), "a", "b", "distance").unionByName(
        pairs.select(F.col("b").alias("end"), "a", "b", "distance"))
    best = ends.groupBy("end").agg(F.min_by(F.struct("a", "b"), F.struct("distance", "a", "b")).alias("p"))
    if most == 1:
        return best.select("p.a", "p.b").distinct()
    rank = F.row_number().over(W.partitionBy("end").orderBy("distance", F.xxhash64("a", "b")))
    return ends.withColumn("_rank", rank).filter(F.col("_rank") <= most).select("a", "b").distinct()


def class_components(classes: DataFrame, documents: DataFrame) -> DataFrame:
    """(node, component) of the classes that meet another under some key."""
    keys = keys_of(classes)
    shared = written(keys.groupBy("key").agg(F.min("class_id").alias("first"), F.max("class_id").alias("last"))
                     .filter("first <> last"), "shared-keys")
    met = written(keys.join(shared, "key"), "met-keys")
    pairs = written(within_distance(leader_pairs(met), classes), "leader-pairs")
    # only texts that meet another under some key are ever looked at again
    texts = written(documents.withColumnRenamed("doc_id", "class_id")
                    .join(met.select("class_id").distinct(), "class_id", "left_semi"), "met-texts")
    linked = components(written(confirmed(pairs, texts), "links"))
    found = written(texts.select(F.col("class_id").alias("node")).join(linked, "node", "left")
                    .select("node", F.coalesce("component", "node").alias("component")), "components")

    members, tried = met.select("key", "slot", "class_id"), pairs
    for _ in range(ROUNDS):
        near = block_pairs(with_component(members, found), classes, nearest=True).select("a", "b")
        chosen = written(near.join(tried, ["a", "b"], "left_anti"), "nearest-pairs")
        if chosen.isEmpty():
            break
        tried = tried.unionByName(chosen)
        found = written(joined(found, written(confirmed(chosen, texts), "links")), "components")
    left = written(block_pairs(with_component(members, found), classes, texts=texts)
                   .join(tried, ["a", "b"], "left_anti"), "open-pairs")
    for choose in (lambda p: nearest_only(p, 1), nearest_only, lambda p: p.select("a", "b")):
        left = written(still_apart(left, found), "open-pairs")
        if left.isEmpty():
            break
        chosen = written(choose(left), "chosen-pairs")
        found = written(joined(found, written(confirmed(chosen, texts), "links")), "components")
        left = left.join(chosen, ["a", "b"], "left_anti")
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document row."""
    named = docs.filter("doc_id IS NOT NULL").select("doc_id", text_or_empty().alias("text"))
    repeated = written(named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).filter("times > 1"), "repeated-ids")
    repeats = not repeated.isEmpty()
    documents = named.groupBy("doc_id").agg(F.min("text").alias("text")) if repeats else named
    rows = written(folded(documents), "folded")
    classes = written(rows.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("class_id"), F.first("signature").alias("signature")), "classes")
    found = class_components(classes, documents)
    placed = with_component(classes.select("digest", "class_id"), found).select("digest", "component")
    # every row finds its class by the digest; a large class is a skewed key, which the join splits
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    result = (rows.join(placed, "digest", "left")
              .select("doc_id", "n_shingles", component.alias("component_id"))
              .withColumn("kept", F.col("doc_id") == F.col("component_id")))
    if repeats:
        result = (result.join(repeated, "doc_id", "left")
                  .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.coalesce("times", F.lit(1)).cast("int"))))
                  .drop("times", "_copy"))
    unnamed = folded(docs.filter("doc_id IS NULL").select("doc_id", text_or_empty().alias("text")))
    return result.unionByName(unnamed.select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def without_near_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, one of each component, whole and in their own columns.

    Dropped identifiers are the fewer, so they are what is looked up. Of rows
    that repeat an identifier that stays, all stay.
    """
    dropped = near_duplicates(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("_usageloom_dropped")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["_usageloom_dropped"], "left_anti")
