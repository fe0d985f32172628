"""Packing token pieces into sequences by a configuration linear program.

A configuration is a multiset of piece lengths that fits one sequence. The
program asks for the fewest configurations that cover the histogram of lengths:

* ``fractional_cover`` solves it by multiplicative weights: each length has a
  price, a knapsack over the capacity (dynamic programming) finds the dearest
  configuration, which is used as far as its scarcest length allows, and the
  prices of the lengths it covers fall by the share it covered. It works in
  classes of ``CLASS`` tokens, a length counting as the top of its class.
* ``plan`` scales and rounds that down to whole configurations, draws real
  lengths for their classes, and packs what is left over by best fit, on the
  histogram too. The shortest piece of each configuration is left to best fit,
  which sees real lengths, so that rounding up to classes wastes nothing.

The histogram has ``capacity`` lengths at most, whatever the size of the
corpus, so the program is solved on the driver; pieces never leave the
executors. A piece finds its sequence by its rank among pieces of its length:
the plan says which ranks go to which sequences and offsets. Ranks are taken in
blocks by hash, so a length with a third of all pieces is ranked by many tasks.

Defined cases: a null text is empty and is one piece, the end mark alone; only
documents longer than the capacity are cut; repeated rows are packed each; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usageloom.llm.common import ship_code, shuffle_width, text_or_empty, written
from usageloom.llm.encoders import KNOWN, rows_of, word_bpe

CAPACITY = 4096
END = 1
CLASS = 8
STEP = 0.5
ROUNDS = 800

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False,
               units: int = KNOWN) -> DataFrame:
    """The pieces of every document; ``ids`` (little-endian unsigned 32 bit) only if asked for."""
    ship_code(docs.sparkSession)

    def pieces(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder, end = word_bpe(vocabulary, units=units), END.to_bytes(4, "little")
        kind = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        width = 6 if with_ids else 5
        for batch in batches:
            out = []
            for doc_id, text in rows_of([batch], "doc_id", "text"):
                ids = encoder.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part)[:width])
            columns = zip(*out, strict=True) if out else [[]] * width
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kind[:width], strict=True)], names=names[:width])

    texts = docs.select("doc_id", text_or_empty().alias("text"))
    return texts.mapInArrow(pieces, PIECES + (", ids binary" if with_ids else ""))


@dataclass(frozen=True)
class Use:
    """A configuration, lengths in falling order, and how many sequences have it."""

    lengths: tuple[int, ...]
    times: int


def dearest(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, ...]:
    """The configuration of the highest total price: unbounded knapsack by dynamic programming."""
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, np.int32)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        n = upto[room]
        value = prices[:n] + best[room - lengths[:n]]
        k = int(value.argmax())
        best[room], choice[room] = value[k], lengths[k]
    room, out = capacity, []
    while room > 0 and choice[room]:
        out.append(int(choice[room]))
        room -= out[-1]
    return tuple(sorted(out, reverse=True))


def fractional_cover(
    histogram: dict[int, int], capacity: int, rounds: int = ROUNDS, step: float = STEP
) -> dict[tuple[int, ...], float]:
    """Configurations and how often to use each, so that no length is used more often than it occurs."""
    lengths = np.array(sorted(x for x, n in histogram.items() if n), np.int64)
    if not lengths.size:
        return {}
    demand = np.array([histogram[int(x)] for x in lengths], np.float64)
    place = {int(x): i for i, x in enumerate(lengths)}
    weights = lengths / capacity
    used: dict[tuple[int, ...], float] = {}
    covered = np.zeros(lengths.size)
    for _ in range(rounds):
        found = dearest(weights, lengths, capacity)
        counts = np.bincount([place[x] for x in found], minlength=lengths.size)
        inside = counts > 0
        times = float((demand[inside] / counts[inside]).min())
        used[found] = used.get(found, 0.0) + times
        share = counts * times / demand
        covered += share
        weights = weights * (1 - step * share)
    scale = {c: 1 / max(1.0, max(covered[place[x]] for x in c)) for c in used}
    return {c: n * scale[c] for c, n in used.items()}


def best_fit(histogram: dict[int, int], opened: list[Use], capacity: int = CAPACITY) -> list[Use]:
    """Best fit, longest first, on counts: sequences alike are kept and filled together.

    ``opened`` are sequences that hold something already.
    """
    groups: dict[int, dict[tuple[int, ...], int]] = {}  # room left -> contents -> how many
    rooms: list[int] = []

    def put(room: int, contents: tuple[int, ...], times: int) -> None:
        if not times:
            return
        if room not in groups:
            groups[room] = {}
            insort(rooms, room)
        groups[room][contents] = groups[room].get(contents, 0) + times

    for use in opened:
        put(capacity - sum(use.lengths), use.lengths, use.times)
    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = min(capacity // length, left)
                put(capacity - each * length, (length,) * each, left // each)
                put(capacity - left % each * length, (length,) * (left % each), int(left % each > 0))
                break
            room = rooms[at]
            contents, times = next(iter(groups[room].items()))
            each = min(room // length, left)
            filled = min(times, left // each)
            del groups[room][contents]
            if not groups[room]:
                del groups[room]
                rooms.remove(room)
            put(room, contents, times - filled)
            put(room - each * length, contents + (length,) * each, filled)
            left -= filled * each
    return [Use(c, n) for room in sorted(groups) for c, n in groups[room].items()]


def drawn(classes: tuple[int, ...], times: int, stock: dict[int, list[list[int]]]) -> list[Use]:
    """``times`` sequences of a configuration of classes, with real lengths from ``stock``: [length, count] by class."""
    runs = []
    for c in classes:
        run, need = [], times
        while need:
            length, n = stock[c][-1]
            take = min(n, need)
            run.append([length, take])
            need -= take
            if take == n:
                stock[c].pop()
            else:
                stock[c][-1][1] -= take
        runs.append(run[::-1])
    out = []
    while runs and runs[0]:
        step = min(run[-1][1] for run in runs)
        out.append(Use(tuple(run[-1][0] for run in runs), step))
        for run in runs:
            run[-1][1] -= step
            if not run[-1][1]:
                run.pop()
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, width: int = CLASS) -> list[Use]:
    """Whole configurations that hold exactly the pieces of the histogram."""
    full = histogram.get(capacity, 0)
    stock: dict[int, list[list[int]]] = {}
    for length in sorted(x for x, n in histogram.items() if n and x < capacity):
        stock.setdefault(-(-length // width), []).append([length, histogram[length]])
    left = {c: sum(n for _, n in rows) for c, rows in stock.items()}
    uses = [Use((capacity,), full)] if full else []
    opened: list[Use] = []
    for classes, times in sorted(fractional_cover(left, capacity // width).items(), key=lambda x: (-x[1], x[0])):
        whole = min([int(times), *(left[c] // classes.count(c) for c in set(classes))])
        if whole:
            opened += drawn(classes[:-1], whole, stock)
            for c in classes[:-1]:
                left[c] -= whole
    rest = {length: n for rows in stock.values() for length, n in rows}
    return uses + best_fit(rest, opened, capacity)


def slots_of(uses: list[Use]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, offset): rank r goes to sequence first + r - first rank."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for use in uses:
        offset = 0
        for length in use.lengths:
            first = taken.get(length, 0)
            rows.append((length, first, first + use.times - 1, sequence, offset))
            taken[length] = first + use.times
            offset += length
        sequence += use.times
    return rows


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``pieces`` must be stored rows, as it is read twice."""
    spark = pieces.sparkSession
    blocks = 4 * shuffle_width(spark)
    blocked = pieces.withColumn("_block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)).cast("int"))
    counts = written(blocked.groupBy("length", "_block").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most `capacity` rows
    slots = spark.createDataFrame(
        slots_of(plan(histogram, capacity)) or [(0, 0, -1, 0, 0)],
        "length long, first long, last long, sequence long, offset long")
    lines = slots.groupBy("length").agg(F.sort_array(F.collect_list(
        F.struct("first", "last", "sequence", "offset"))).alias("slots"))
    before = W.partitionBy("length").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = (counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .withColumn("_top", F.col("base") + F.col("n") - 1)
              .join(lines, "length")
              .select("length", "_block", "base", F.filter(
                  "slots", lambda s: (s["last"] >= F.col("base")) & (s["first"] <= F.col("_top"))).alias("slots")))
    within = F.row_number().over(W.partitionBy("length", "_block").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = blocked.withColumn("_within", within - 1).join(starts, ["length", "_block"])
    rank = F.col("base") + F.col("_within")
    mine = F.filter("slots", lambda s: (s["first"] <= F.col("_rank")) & (s["last"] >= F.col("_rank")))[0]
    return (
        ranked.withColumn("_rank", rank).withColumn("_slot", mine)
        .withColumn("sequence_id", F.col("_slot.sequence") + F.col("_rank") - F.col("_slot.first"))
        .withColumn("offset", F.col("_slot.offset"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, units: int = KNOWN) -> DataFrame:
    """One row per piece of every document: which sequence it lies in, and where."""
    pieces = written(cut_pieces(docs, vocabulary, capacity, units=units), "pieces")
    return packed(pieces, capacity)


def packed_sequences(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: sequence_id and the ids of its pieces in order (at most ``capacity`` of them)."""
    pieces = written(cut_pieces(docs, vocabulary, capacity, with_ids=True), "pieces")
    rows = packed(pieces, capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(
        F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), "").alias("hexed")
    ).select("sequence_id", F.unhex("hexed").alias("ids"))
