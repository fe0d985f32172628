"""Periodic runs of words within a text, by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words whose smallest period is q, which no
neighbouring word extends, and which is at least max(``LEAST``, ``TIMES`` * q) long.

1. A word of a run of period q returns every q words, so it occurs at least
   ``TIMES`` times in the run. A word that occurs more rarely in its segment (a
   whole text at first) is in no run and splits the segment; pieces shorter than
   ``LEAST`` are dropped, and pieces are split again until none changes. All texts
   of a batch are split together, one sort of (segment, word) pairs a round.
2. A surviving segment is scanned lag by lag. At lag q a run is a stretch of at
   least s = max(LEAST - q, (TIMES - 1) * q) places that equal the place q
   further on, so it holds a place s - 1, 2s - 1, 3s - 1, ... Only these are
   looked at (n log n of them over all lags, not n times n) and followed in both
   directions where they agree. Places within a known run whose period divides
   the lag find nothing new and are passed over.
3. A stretch found at lag q whose smallest period is p < q is the run of period p
   with the same ends (both periods fit twice, so p divides q); lags come in
   ascending order, so the first finder is kept.

Each text is dealt with in one task, with memory in proportion to that text; no row
needs another, so nothing is shuffled.

Defined cases: a null or empty text has no words, no runs and an empty collapsed
text; rows that share an identifier, or have none, are answered one by one; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageloom.llm.common import SPACE, ship_code, text_or_empty

LEAST, TIMES = 6, 4
#: bytes of text split together; a longer text goes alone
TOGETHER = 2_000_000
#: places looked at in one step of a lag scan
PLACES = 1_000_000
#: from this length on a run hides the places of later lags
LONG = 64

RUN = "struct<start:long,length:long,period:long>"
FOUND = f"doc_id long, n_words long, runs array<{RUN}>, collapsed string"


class Numbers(dict):
    """Word to its number, given in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def segments(words: np.ndarray, starts: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """(start, end) of the stretches, none across a text's end, in which every word occurs ``times`` times or more."""
    place = np.arange(words.size)
    part = np.repeat(np.arange(starts.size - 1), np.diff(starts))
    out = []
    many = int(words.max(initial=0)) + 1
    while place.size:
        count = np.bincount(part)
        long = count[part] >= least
        place, part = place[long], part[long]
        if not place.size:
            break
        pairs = part * many + words[place]
        order = np.argsort(pairs, kind="stable")
        same = pairs[order]
        edges = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1], [True]]))
        sizes = np.diff(edges)
        common = np.empty(place.size, bool)
        common[order] = np.repeat(sizes >= times, sizes)
        changed = np.zeros(int(part.max()) + 1, bool)
        changed[part[~common]] = True
        whole = ~changed[part]
        if whole.any():
            at, of = place[whole], part[whole]
            cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
            out += zip(at[cut[:-1]].tolist(), (at[cut[1:] - 1] + 1).tolist(), strict=True)
        left = common & ~whole
        place, part = place[left], part[left]
        if place.size:
            new = np.concatenate([[False], (np.diff(place) != 1) | (part[1:] != part[:-1])])
            part = np.cumsum(new)
    return sorted(out)


def same_from(words: np.ndarray, i: int, j: int, step: int) -> int:
    """How many places agree from ``i`` and ``j`` > ``i`` on, going forward (step 1) or back (step -1)."""
    room = words.size - j if step > 0 else i + 1
    done, width = 0, 32
    while done < room:
        n = min(width, room - done)
        if step > 0:
            equal = words[i + done:i + done + n] == words[j + done:j + done + n]
        else:
            equal = (words[i - done - n + 1:i - done + 1] == words[j - done - n + 1:j - done + 1])[::-1]
        if not equal.all():
            return done + int(equal.argmin())
        done, width = done + n, width * 2
    return done


def places(size: int, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(lag, place) arrays, lags ascending, of every place that a segment of ``size`` words is looked at."""
    lags = np.arange(1, size // times + 1)
    step = np.maximum(least - lags, (times - 1) * lags)
    count = (size - lags) // step
    lags, step, count = (x[count > 0] for x in (lags, step, count))
    first = 0
    total = np.cumsum(count)
    while first < lags.size:
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + PLACES, "right")))
        n = count[first:last]
        turn = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(lags[first:last], n), (turn + 1) * np.repeat(step[first:last], n) - 1
        first = last


def segment_runs(words: np.ndarray, least: int = LEAST, times: int = TIMES, near: int = 8) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one segment."""
    found: dict[tuple[int, int], int] = {}
    long_runs: list[tuple[int, int, int]] = []

    def hidden(lag: np.ndarray, at: np.ndarray, run: tuple[int, int, int]) -> np.ndarray:
        start, end, period = run
        return (lag % period == 0) & (at >= start) & (at + lag < end)

    for lag, at in places(words.size, least, times):
        agree = words[at] == words[at + lag]
        lag, at = lag[agree], at[agree]
        for run in long_runs:
            if lag.size:
                open_ = ~hidden(lag, at, run)
                lag, at = lag[open_], at[open_]
        if not lag.size:
            continue
        # most places agree by chance: their stretch ends within a few words
        reach = np.ones(lag.size, np.int64)
        closed = np.ones(lag.size, bool)
        for step in (-1, 1):
            going = np.ones(lag.size, bool)
            for k in range(1, near + 1):
                low = at + step * k
                high = low + lag
                inside = (low >= 0) & (high < words.size)
                going &= inside
                going[going] = words[low[going]] == words[high[going]]
                reach += going
            closed &= ~going
        need = np.maximum(least - lag, (times - 1) * lag)
        kept = ~closed | (reach >= need)
        lag, at = lag[kept], at[kept]
        i = 0
        while i < lag.size:
            q, j = int(lag[i]), int(at[i])
            i += 1
            left = same_from(words, j, j + q, -1)
            start = j - left + 1
            end = j + same_from(words, j, j + q, 1) + q
            if end - start < max(least, times * q) or (start, end) in found:
                continue
            found[start, end] = q
            if end - start >= LONG:
                long_runs.append((start, end, q))
                open_ = ~hidden(lag[i:], at[i:], long_runs[-1])
                lag, at, i = lag[i:][open_], at[i:][open_], 0
    return [(start, end - start, q) for (start, end), q in found.items()]


def collapsed_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words left when every run keeps its first period alone; a word any run drops is dropped."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(depth[:-1]).tolist(), strict=True) if not d]


def text_runs(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, by start, then period."""
    numbers = Numbers()
    starts = np.cumsum([0, *map(len, texts)])
    ids = np.concatenate([np.zeros(0, np.int64), *(np.fromiter(map(numbers.__getitem__, t), np.int64, len(t)) for t in texts)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, end in segments(ids, starts, least, times):
        runs = segment_runs(ids[start:end], least, times)
        if runs:
            text = int(np.searchsorted(starts, start, "right")) - 1
            out[text] += [(int(start - starts[text]) + a, n, q) for a, n, q in runs]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def gathered(batch, least_bytes: int = TOGETHER) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of a batch, so many rows together as ``least_bytes`` need."""
    import pyarrow as pa

    texts, first, size = [], 0, 0
    for row, text in enumerate(batch.column("text").cast(pa.binary())):
        texts.append(text.as_py())
        size += len(texts[-1])
        if size >= least_bytes:
            yield first, texts
            texts, first, size = [], row + 1, 0
    if texts:
        yield first, texts


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and the collapsed text of every row."""
    if times < 2:
        raise ValueError("a run repeats its period twice at least")
    ship_code(docs.sparkSession)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            for first, texts in gathered(batch):
                words = [t.split() for t in texts]  # on bytes this knows ASCII white space only, as the contract says
                runs = text_runs(words, least, times)
                flat = np.array([r for each in runs for r in each], np.int64).reshape(-1, 3)
                offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(flat[:, i].copy()) for i in range(3)], fields=list(kind))
                short = [b" ".join(collapsed_words(w, r)) for w, r in zip(words, runs, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(texts)), pa.array(map(len, words), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets), spans), pa.array(short, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(scan, FOUND)


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run and the digests of :func:`periodic_runs`."""
    best = F.col("best")
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        (-best["less"]).alias("length"), best["period"].alias("period"),
        F.floor(-best["less"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The texts of the run query: where crc32(doc_id) % 10 is 0, the words from place a on repeat p words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    n = F.size("w").cast("long")
    a = F.pmod(g, n)
    p = F.lit(1) + F.floor((n - F.col("a")) / (3 + F.pmod(g, F.lit(8))))
    again = F.array_join(F.transform("w", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("w", (F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int")))), " ")
    chosen = F.coalesce(h % 10 == 0, F.lit(False)) & F.col("text").isNotNull()
    rows = docs.select("doc_id", "text", F.when(chosen, words).alias("w"))
    rows = rows.withColumn("a", F.when(n > 0, a)).withColumn("p", p)
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), again).otherwise(F.col("text")).alias("text"))
