"""Hard negatives by exact search over lists that the anchors of a cluster share.

1. Anchors are clustered by angle (spherical k-means on at most ``SAMPLE`` of them, those
   that hash lowest; every anchor is then assigned). A cluster has a centre and the largest
   angle ``wide`` of a member to it.
2. No member scores a row v above |a| * bound(v), where bound(v) = |v| * cos(max(0, angle(centre, v) - wide)).
   A cluster's list is all rows by falling bound, the same for all its members. It is
   laid out once by counting bounds per bin and cut into ``SHARES`` of growing size.
3. Each member walks its cluster's list: from each piece it keeps its best rows, and it
   stops for good once |a| * bound of the next row is below the last score it would still
   take. That certifies the result: nothing further down can enter it. Within a piece the walk
   stops at every block of rows in the same way.
4. The list is walked for the anchors' positives first, then for their negatives, which must
   lie in a range that depends on the positive's score; the low end of it stops the walk too.

A piece is spread over tasks by slices of some ``SLICE`` rows and blocks of ``BLOCK`` members,
so no task holds a list, a cluster or a label. A round is one pass over the rows, which
sends on only those of the next piece of a cluster with members still walking. The driver gets
the sample, the centres, counts per cluster and bin, and members per cluster: bounded by
``CLUSTERS`` and ``BINS``. Clusters, bins and shares set the work alone, not the result.

Scores are exact integers: 53 bits by matrix products, beyond that by Python integers; a
score beyond +-``MOST`` counts as that.

Defined cases: a row with a null identifier, label or vector, or a null or non-finite
component, takes no part; of rows that share an identifier the smallest (label, vector)
is taken; shorter vectors are filled up with zeros; ties go to the smaller identifier; an
anchor without another row of its label, or with no row in the range, has no rows; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usageloom.llm.common import ship_code, written

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
CLUSTERS, MEMBERS, SAMPLE = 64, 64, 4096
BINS = 512
#: shares of a list at which its pieces end
SHARES = (0.02, 0.1, 0.4, 1.0)
SLICE, BLOCK, STEP = 8192, 512, 1024
MOST = (2**63 - 1) // 100
#: angles and bounds are widened by these for rounding
ANGLE_SLACK, BOUND_SLACK = 2e-6, 1e-9

PACKED = "id long, label long, vec binary, norm double"
BEST = "anchor long, query long, other long, score long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(rows: DataFrame) -> DataFrame:
    """Rows (id, label, vector of doubles) that take part."""
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(fine)


def packed(rows: DataFrame) -> DataFrame:
    """(id, label, vec, norm): vectors of whole numbers as bytes, one row per identifier, stored."""
    ship_code(rows.sparkSession)
    plain = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                        F.transform("vector", lambda x: F.floor(x)).alias("vector"))  # ends at 64 bits, unlike a cast
    if not plain.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        plain = plain.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*")

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            vectors = [np.asarray(x.values, "<i8") for x in batch.column("vector")]
            norms = [float(np.sqrt((v.astype(np.float64) ** 2).sum())) for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([v.tobytes() for v in vectors], pa.binary()),
                 pa.array(norms, pa.float64())], names=["id", "label", "vec", "norm"])

    return written(plain.mapInArrow(pack, PACKED), "vectors")


def matrix(vectors: list[bytes], width: int = 0) -> np.ndarray:
    """The vectors as rows of 64-bit numbers, filled up with zeros."""
    sizes = {len(v) for v in vectors}
    width = max([width, *(s // 8 for s in sizes)])
    if sizes <= {width * 8}:
        return np.frombuffer(b"".join(vectors), "<i8").reshape(len(vectors), width)
    return np.frombuffer(b"".join(v.ljust(width * 8, b"\0") for v in vectors), "<i8").reshape(len(vectors), width)


def inner(left: np.ndarray, right: np.ndarray, largest: float) -> np.ndarray:
    """All inner products, exactly; ``largest`` bounds their size."""
    if largest < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    whole = left.astype(object) @ right.astype(object).T
    return np.clip(whole, -MOST, MOST).astype(np.int64)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    rows = vectors.astype(np.float64)
    length = np.sqrt((rows ** 2).sum(axis=1, keepdims=True))
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def centres(sample: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means, started from rows far from each other; the same rows give the same centres."""
    rows = unit_rows(sample)
    chosen = [0]
    nearest = rows @ rows[0]
    while len(chosen) < min(clusters, len(rows)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
    middle = rows[chosen]
    for _ in range(rounds):
        home = (rows @ middle.T).argmax(axis=1)
        sums = np.zeros_like(middle)
        np.add.at(sums, home, rows)
        length = np.sqrt((sums ** 2).sum(axis=1, keepdims=True))
        middle = np.where(length > 0, sums / np.where(length > 0, length, 1), middle)
    return middle


def angles(vectors: list[bytes], middle: np.ndarray) -> np.ndarray:
    """Angles of rows to the centres; a row of zeros lies at angle 0 to all."""
    rows = unit_rows(matrix(vectors, middle.shape[1]))
    wide = np.pad(middle, ((0, 0), (0, rows.shape[1] - middle.shape[1])))
    found = np.arccos(np.clip(rows @ wide.T, -1, 1))
    found[~rows.any(axis=1)] = 0
    return found


@dataclass
class Lists:
    """The clusters' shared lists: centres, widest member, longest row, and rows per bin of falling bound."""

    middle: np.ndarray
    wide: np.ndarray
    longest: float
    counts: np.ndarray | None = None

    def bounds(self, vectors: list[bytes], norms: np.ndarray) -> np.ndarray:
        """No member of unit length scores a row (first axis) above its bound for the cluster (second axis)."""
        over = np.maximum(0, angles(vectors, self.middle) - self.wide - ANGLE_SLACK)
        return norms[:, None] * (np.cos(over) + BOUND_SLACK)

    def bins(self, bounds: np.ndarray) -> np.ndarray:
        return np.clip(((1 - bounds / self.longest) / 2 * BINS).astype(np.int64), 0, BINS - 1)

    def cuts(self) -> np.ndarray:
        """The bin at which each piece of each list begins, and ``BINS`` after the last."""
        below = np.cumsum(self.counts, axis=1)
        ends = [[min(int(np.searchsorted(row, share * row[-1])) + 1, BINS) for share in SHARES[:-1]] for row in below]
        return np.concatenate([np.zeros((len(ends), 1), int), np.array(ends, int).reshape(len(ends), -1),
                               np.full((len(ends), 1), BINS)], axis=1)

    def edge(self, at: np.ndarray) -> np.ndarray:
        """The highest bound from bin ``at`` on."""
        return np.where(at >= BINS, -np.inf, np.where(at <= 0, np.inf, self.longest * (1 - 2 * at / BINS + BOUND_SLACK)))


def clustered(anchors: DataFrame, total: int) -> tuple[DataFrame, Lists]:
    """The anchors with their cluster, and the lists' centres."""
    sample = anchors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").collect()
    middle = centres(matrix([bytes(r["vec"]) for r in sample]), max(1, min(CLUSTERS, total // MEMBERS)))

    def assign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            away = angles(batch.column("vec").to_pylist(), middle) if batch.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(away.argmin(axis=1).astype(np.int32)), pa.array(away.min(axis=1))],
                names=[*batch.schema.names, "cluster", "angle"])

    members = written(anchors.mapInArrow(assign, f"{PACKED}, cluster int, angle double"), "anchors")
    wide = np.zeros(len(middle))
    for row in members.groupBy("cluster").agg(F.max("angle").alias("angle")).collect():
        wide[row["cluster"]] = row["angle"]
    return members.drop("angle"), Lists(middle, wide, 1.0)


def counted(items: DataFrame, lists: Lists) -> Lists:
    """The lists with their rows per bin."""
    lists.longest = items.agg(F.max("norm")).first()[0] or 1.0

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums = np.zeros((len(lists.middle), BINS), np.int64)
        for batch in batches:
            if batch.num_rows:
                bins = lists.bins(lists.bounds(batch.column("vec").to_pylist(), batch.column("norm").to_numpy()))
                for c in range(len(sums)):
                    sums[c] += np.bincount(bins[:, c], minlength=BINS)
        c, b = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(sums[c, b])], names=["cluster", "bin", "n"])

    found = items.select("vec", "norm").mapInArrow(count, "cluster int, bin int, n long")
    lists.counts = np.zeros((len(lists.middle), BINS), np.int64)
    for row in found.groupBy("cluster", "bin").agg(F.sum("n").alias("n")).collect():
        lists.counts[row["cluster"], row["bin"]] = row["n"]
    return lists


def per_cluster(values: np.ndarray) -> Column:
    return F.element_at(F.array(*[F.lit(v.item()) for v in values]), F.col("cluster") + 1)


def piece(items: DataFrame, lists: Lists, first: np.ndarray, last: np.ndarray, slices: np.ndarray,
          blocks: np.ndarray) -> DataFrame:
    """The rows of bins ``first`` to ``last`` of each list, each in a slice and once for every block of members."""

    def emit(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            bounds = lists.bounds(batch.column("vec").to_pylist(), batch.column("norm").to_numpy())
            bins = lists.bins(bounds)
            ids = batch.column("id").to_numpy().astype(np.uint64)
            spread = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            for c in range(len(lists.middle)):
                rows = np.flatnonzero((bins[:, c] >= first[c]) & (bins[:, c] < last[c]))
                part = batch.take(pa.array(rows))
                own = (spread[rows] % np.uint64(slices[c])).astype(np.int32)
                for block in range(blocks[c] if rows.size else 0):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(rows.size, c, np.int32)), pa.array(own), pa.array(np.full(rows.size, block, np.int32)),
                         *part.columns, pa.array(bounds[rows, c])],
                        names=["cluster", "slice", "block", *part.schema.names, "bound"])

    return items.mapInArrow(emit, f"cluster int, slice int, block int, {PACKED}, bound double")


def walker(want: int, same: bool):
    """Walks one slice of a list for one block of members; see the module's text."""

    def walk(rows, members):
        import pyarrow as pa

        found: list[tuple[int, int, int, int]] = []
        if rows.num_rows and members.num_rows:
            order = np.argsort(-rows.column("bound").to_numpy(), kind="stable")
            bound = rows.column("bound").to_numpy()[order]
            ids, labels = (rows.column(c).to_numpy()[order] for c in ("id", "label"))
            vectors = matrix(rows.column("vec").to_pylist())[order]
            anchors = matrix(members.column("vec").to_pylist(), vectors.shape[1])
            vectors = np.pad(vectors, ((0, 0), (0, anchors.shape[1] - vectors.shape[1])))
            own, homes, norms = (members.column(c).to_numpy() for c in ("id", "label", "norm"))
            largest = float(norms.max() * rows.column("norm").to_numpy().max())
            empty = np.zeros(0, np.int64)
            asked = [[[q["query"], q["low"], q["high"], q["last"], empty, empty] for q in qs]
                     for qs in members.column("queries").to_pylist()]
            for at in range(0, ids.size, STEP):
                highest = norms * bound[at]
                # a query goes on while a row of this bound can reach its last place
                going = [[q for q in asked[i] if highest[i] >= (q[1] if q[3] is None else max(q[1], q[3]))] for i in range(own.size)]
                walking = np.array([i for i, qs in enumerate(going) if qs], np.int64)
                if not walking.size:
                    break
                part = slice(at, at + STEP)
                scores = inner(anchors[walking], vectors[part], largest)
                for i, row in zip(walking, scores, strict=True):
                    fits = (labels[part] == homes[i]) & (ids[part] != own[i]) if same else labels[part] != homes[i]
                    for q in going[i]:
                        low = q[1] if q[3] is None else max(q[1], q[3])
                        hit = np.flatnonzero(fits & (row >= low) & (row <= q[2]))
                        if hit.size:
                            score, other = np.concatenate([q[4], row[hit]]), np.concatenate([q[5], ids[part][hit]])
                            best = np.lexsort((other, -score))[:want]
                            q[4], q[5] = score[best], other[best]
                            if best.size == want:
                                q[3] = max(q[3], int(q[4][-1])) if q[3] is not None else int(q[4][-1])
            for i, qs in enumerate(asked):
                for q in qs:
                    found += [(int(own[i]), q[0], int(o), int(s)) for s, o in zip(q[4], q[5], strict=True)]
        columns = zip(*found, strict=True) if found else [[]] * 4
        return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=["anchor", "query", "other", "score"])

    return walk


def best_rows(found: DataFrame, want: int) -> DataFrame:
    """The first ``want`` rows of each query."""
    rank = F.row_number().over(W.partitionBy("anchor", "query").orderBy(F.desc("score"), "other"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= want)


def searched(items: DataFrame, members: DataFrame, lists: Lists, queries: DataFrame, want: int, same: bool) -> DataFrame:
    """The best rows of each query (anchor, query, low, high): anchor, query, other, score, rank, stored."""
    spark = items.sparkSession
    best = spark.createDataFrame([], BEST)
    cuts = lists.cuts()
    for turn in range(cuts.shape[1] - 1):
        first, last = cuts[:, turn], cuts[:, turn + 1]
        full = best.groupBy("anchor", "query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last")).filter(
            F.col("n") >= want).select("anchor", "query", "last")
        highest = F.col("norm") * per_cluster(lists.edge(first))
        open_ = (queries.join(full, ["anchor", "query"], "left")
                 .join(members.select(F.col("id").alias("anchor"), "cluster", "norm"), "anchor")
                 .filter((F.col("low") <= F.col("high"))
                         & (highest >= F.greatest("low", F.coalesce("last", "low")).cast("double"))))
        asked = open_.groupBy("anchor").agg(F.collect_list(F.struct("query", "low", "high", "last")).alias("queries"))
        walking = written(members.join(asked, members["id"] == asked["anchor"]).drop("anchor"), "walking")
        active = np.zeros(len(cuts), np.int64)
        for row in walking.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect():
            active[row["cluster"]] = row["n"]
        if not active.any():
            break
        rows = np.array([lists.counts[c, first[c]:last[c]].sum() for c in range(len(cuts))])
        slices, blocks = np.maximum(1, -(-rows // SLICE)), -(-active // BLOCK)
        units = ["cluster", "slice", "block"]
        block = F.pmod(F.xxhash64("id"), F.greatest(per_cluster(blocks), F.lit(1))).cast("int")
        dealt = walking.withColumn("block", block).withColumn(
            "slice", F.explode(F.sequence(F.lit(0), per_cluster(slices).cast("int") - 1)))
        met = (piece(items, lists, first, last, slices, blocks).groupBy(*units)
               .cogroup(dealt.select(*units, "id", "label", "vec", "norm", "queries").groupBy(*units))
               .applyInArrow(walker(want, same), BEST))
        best = written(best_rows(best.select("anchor", "query", "other", "score").unionByName(met), want), "best-rows")
    return best if "rank" in best.columns else best.withColumn("rank", F.lit(0))


def floored(hundredths: Column) -> Column:
    """Whole hundreds of a whole number, rounded down, without leaving whole numbers."""
    whole = (hundredths - F.pmod(hundredths, F.lit(100)))
    return F.call_function("div", whole, F.lit(100))


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: id, label, vector of whole numbers. Anchors are the rows of which ``anchors``, a
    condition on id, holds. Their positives are the first ``positives`` other rows of their label; a negative has
    another label and a score from ``low`` to ``high`` percent of the positive's.
    """
    items = packed(usable(rows))
    chosen = items.filter(anchors)
    total = chosen.count()
    if not total:
        return rows.sparkSession.createDataFrame([], MINED)
    members, lists = clustered(chosen, total)
    counted(items, lists)
    any_score = members.select(F.col("id").alias("anchor"), F.lit(0).cast("long").alias("query"),
                               F.lit(-MOST).alias("low"), F.lit(MOST).alias("high"))
    found = searched(items, members, lists, any_score, positives, same=True)
    # scores of 30 to 90 percent: 100 * score from low * positive to high * positive, in whole numbers
    wanted = found.select("anchor", F.col("other").alias("query"), F.col("score").alias("positive_score"))
    over, under = -low * F.col("positive_score"), high * F.col("positive_score")
    ranges = wanted.select("anchor", "query", (-floored(over)).alias("low"), floored(under).alias("high"))
    mined = searched(items, members, lists, ranges, negatives, same=False)
    return mined.join(wanted, ["anchor", "query"]).select(
        F.col("anchor").alias("anchor_id"), F.col("query").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def embedding_rows(embeddings: DataFrame) -> DataFrame:
    """The rows of the mining query: labels moved on where vec_id divides by 7, components floor(256 * x)."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # floor would turn a component that is not finite into a number; it is kept as it is, so that its row takes no part
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.select(F.col("vec_id").alias("id"), moved.alias("label"), F.when(finite, whole).alias("vector"))
