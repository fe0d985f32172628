"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed terms: lower-case words and, so that an
inflected insult is known by its stem, the beginnings of ``STEMS`` characters
of longer words. With x_i = 1 / sqrt(n) for each of the n known terms of a text, the score is
sigmoid(bias + sum of w_i + sum of u_i x_i + sum over pairs i < j of <v_i, v_j> x_i x_j),
so two terms that are harmless apart, such as an insult and the mention of a group, can
count together. <v_i, v_j> adds its ``RANK`` parts with a sign each, so a pair can also excuse.

* Term statistics cover all labelled training rows: documents and toxic documents per bucket.
  Every bucket in at least ``FLOOR`` of them has a weight, whatever its labels.
* The weights w are fitted by AdaGrad on the logistic loss. A term's steps are scaled by
  chi / (chi + ``DOUBT``), chi being its chi-squared value: what may be chance moves slowly, and the
  penalty falls with the number of documents that bear a term out.
* The factors follow greedily (convex factorization machines): the products of two terms that
  explain most of what the weights leave over are the leading eigenvectors of the matrix of left-over
  error summed over texts with both terms, found by orthogonal iteration and then held to their
  largest entries (``SPARSE``). Their strengths, and u, come from Newton's method. So a pair is
  found among all pairs of frequent terms, neutral ones included, in texts of hundreds of terms.
* How many epochs and factors, none included, is set by the loss on one fifth of the
  training rows that those fits do not see.
* The machine is fitted on at most ``TRAIN_ROWS`` labelled rows, those whose
  identifiers hash lowest: a bounded sample, by parameter. The driver holds it as two flat arrays.
* Every whole text is scored in the executors; the model is ``BUCKETS`` x
  (``RANK`` + 3) numbers at most.

Labels of held-out rows (crc32 of doc_id mod 4 is 2) are never used, and
labels, lang, source and doc_id are no inputs of a score.

Defined cases: a null text is empty and scores the bias; without training rows
of both labels every score is the share of toxic rows (0 without any); a
doc_id labelled twice counts as toxic if any of its rows says so; repeated rows
are scored each; a null doc_id is not held out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from usageloom.llm.common import ship_code, text_or_empty, written

BUCKETS = 1 << 18
RANK = 6
TRAIN_ROWS = 16_000
#: chi-squared value at which a term's steps are half as large as those of a certain one
DOUBT = 30.0
#: training rows a bucket must be in to be known
FLOOR = 5
STEMS = range(4, 9)
CUT = 0.3
EPOCHS = 8
BATCH = 64
RATE, PENALTY = 0.3, 1e-3
#: rounds of orthogonal iteration, then the entries a factor keeps in each round after
ROUNDS, SPARSE = 8, (256, 64, 16, 16)
#: share of the loss that another epoch or factor has to save on rows not seen
SAVING = 0.01
#: penalty of a factor's strength, in standard deviations of what it adds
RIDGE = 3.0
#: labelled rows up to which they are sent to every task; more are joined by a shuffle
SENT_ROWS = 1_000_000
#: rows of the sample worked on at a time
SLICE = 1024

WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Machine:
    """Bias, and per bucket whether it is known, its weights w and u, and its factors with their signs."""

    bias: float
    known: np.ndarray
    weights: np.ndarray
    slopes: np.ndarray
    factors: np.ndarray
    signs: np.ndarray

    def score(self, buckets: np.ndarray) -> float:
        used = buckets[self.known[buckets]]
        raw = self.bias
        if used.size:
            v = self.factors[used].astype(np.float64)
            s = v.sum(axis=0)
            raw += self.weights[used].sum(dtype=np.float64) + self.slopes[used].sum(dtype=np.float64) / used.size ** 0.5
            raw += 0.5 * float((self.signs * (s * s - (v * v).sum(axis=0))).sum()) / used.size
        return float(1.0 / (1.0 + np.exp(-np.clip(raw, -30, 30))))


def constant(share: float) -> Machine:
    """The machine that knows no term."""
    bias = float(np.log(share / (1 - share))) if 0 < share < 1 else 30.0 if share else -30.0
    none = np.zeros(BUCKETS, np.float32)
    return Machine(bias, np.zeros(BUCKETS, bool), none, none, np.zeros((BUCKETS, 0), np.float32), np.zeros(0))


def bucket_of(word: str) -> int:
    return xxh64_intdigest(word) & (BUCKETS - 1)


def terms_of(word: str) -> list[str]:
    """The word and its marked beginnings."""
    return [word, *("^" + word[:k] for k in STEMS if k < len(word))]


class Buckets(dict):
    """Word to the buckets of its terms, 32 bits each in one bytes object, bounded to some 50 MB."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= 250_000:
            self.clear()
        buckets = array("i", map(bucket_of, terms_of(word))).tobytes()
        if len(word) <= 64:
            self[word] = buckets
        return buckets


def buckets_of(text: str, known: Buckets) -> np.ndarray:
    words = set(WORDS.findall(text.lower()))
    return np.unique(np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32))


def held_out() -> Column:
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(4)) == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, buckets) of the labelled rows that are not held out; no other text is hashed."""
    known = written(labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
                    .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "toxicity-labels")
    if known.count() <= SENT_ROWS:
        known = F.broadcast(known)
    rows = docs.filter(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", text_or_empty().alias("text"))

    def hashed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen = Buckets()
        for batch in batches:
            found = [buckets_of(t.as_py(), seen) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array([f.tobytes() for f in found], pa.binary())],
                names=["doc_id", "toxic", "buckets"])

    return rows.join(known, "doc_id").select("doc_id", "toxic", "text").mapInArrow(
        hashed, "doc_id long, toxic int, buckets binary")


def term_statistics(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents and toxic documents per bucket, over all rows; each task counts its own first."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, k = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for toxic, buckets in zip(batch.column("toxic").to_pylist(), batch.column("buckets"), strict=True):
                here = np.frombuffer(buckets.as_py(), np.int32)  # each bucket once a row
                n[here] += 1
                k[here] += toxic
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(n[seen]), pa.array(k[seen])], names=["bucket", "n", "k"])

    found = rows.select("toxic", "buckets").mapInArrow(count, "bucket long, n long, k long")
    found = found.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    n, k = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    # one row of bytes a task, at most BUCKETS places of 24 bytes in all
    for packed in found.mapInArrow(_in_bytes, "places binary").toLocalIterator():
        bucket, documents, toxic = np.frombuffer(packed["places"], np.int64).reshape(3, -1)
        n[bucket], k[bucket] = documents, toxic
    return n, k


def _in_bytes(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        columns = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([columns.tobytes()], pa.binary())], names=["places"])


def chi_squared(n: np.ndarray, k: np.ndarray, rows: int, toxic: int) -> np.ndarray:
    """How far the toxic share of a bucket's rows is from what chance gives; 0 where that is undefined."""
    n, k = n.astype(np.float64), k.astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = rows * (k * (rows - toxic - n + k) - (n - k) * (toxic - k)) ** 2 / (n * (rows - n) * toxic * (rows - toxic))
    return np.nan_to_num(value, posinf=0.0)


@dataclass
class Sample:
    """Training rows as flat arrays: the known terms of row r are terms[offsets[r]:offsets[r + 1]]."""

    terms: np.ndarray
    offsets: np.ndarray
    labels: np.ndarray

    def slices(self, rows: np.ndarray, size: int = SLICE) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """(place among ``rows``, terms, row of each term within the slice, terms a row) of some rows at a time."""
        for start in range(0, rows.size, size):
            part = rows[start:start + size]
            sizes = self.offsets[part + 1] - self.offsets[part]
            skip = np.cumsum(sizes) - sizes
            at = np.repeat(self.offsets[part] - skip, sizes) + np.arange(int(sizes.sum()))
            yield slice(start, start + part.size), self.terms[at], np.repeat(np.arange(part.size), sizes), np.maximum(sizes, 1)

    def blocks(self, size: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, their terms, where each row's terms start, terms a row) of the rows that have terms, in order."""
        for first in range(0, self.labels.size, size):
            ends = self.offsets[first:first + size + 1]
            sizes = np.diff(ends)
            full = np.flatnonzero(sizes)
            if full.size:
                yield first + full, self.terms[ends[0]:ends[-1]], (ends[:-1] - ends[0])[full], sizes[full]

    def counts(self, rows: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and toxic rows per term."""
        n, k = np.zeros(terms, np.int64), np.zeros(terms, np.int64)
        for place, found, row, _ in self.slices(rows):
            n += np.bincount(found, minlength=terms)
            k += np.bincount(found, self.labels[rows[place]][row], terms).astype(np.int64)
        return n, k


def sample_of(rows: list[tuple[int, np.ndarray]], known: np.ndarray) -> Sample:
    """(label, buckets) rows as flat arrays; a known bucket's term is its place among ``known``."""
    place = np.full(BUCKETS, -1, np.int32)
    place[known] = np.arange(known.size)
    parts = [place[np.asarray(b, np.int64)] for _, b in rows]
    parts = [p[p >= 0] for p in parts]
    offsets = np.concatenate([[0], np.cumsum([p.size for p in parts])]).astype(np.int64)
    return Sample(np.concatenate([np.zeros(0, np.int32), *parts]), offsets, np.array([y for y, _ in rows], np.float64))


def sigmoid(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def log_loss(raw: np.ndarray, y: np.ndarray) -> float:
    return float((np.logaddexp(0, raw) - y * raw).mean())


def linear_epochs(sample: Sample, rows: np.ndarray, trust: np.ndarray, documents: np.ndarray, seed: int = 7) -> Iterator[tuple[float, np.ndarray]]:
    """Bias and weights before the first epoch and after each; the weights are changed in place."""
    y = sample.labels
    share = float(y[rows].mean())
    bias, seen_b = float(np.log(share / (1 - share))), 1e-2
    inner = np.zeros(trust.size, np.float32)
    seen = np.full(trust.size, 1e-4, np.float32)
    penalty = (PENALTY / np.maximum(documents, 1)).astype(np.float32)
    order = np.random.default_rng(seed)
    at = np.zeros(trust.size, np.int64)
    yield bias, inner * trust
    for _ in range(EPOCHS):
        shuffled = order.permutation(rows)
        for place, terms, row, _ in sample.slices(shuffled, BATCH):
            n = place.stop - place.start
            raw = bias + np.bincount(row, inner[terms] * trust[terms], n)
            error = (sigmoid(raw) - y[shuffled[place]]) / n
            touched = np.flatnonzero(np.bincount(terms, minlength=trust.size))
            at[touched] = np.arange(touched.size)
            slope = np.bincount(at[terms], error[row], touched.size).astype(np.float32) * trust[touched]
            slope += penalty[touched] * inner[touched]
            seen[touched] += slope ** 2
            inner[touched] -= RATE * slope / np.sqrt(seen[touched])
            whole = float(error.sum())
            seen_b += whole ** 2
            bias -= 0.1 * whole / seen_b ** 0.5
        yield bias, inner * trust


def linear_raw(sample: Sample, rows: np.ndarray, bias: float, weights: np.ndarray) -> np.ndarray:
    raw = np.empty(rows.size)
    for place, terms, row, _ in sample.slices(rows):
        raw[place] = bias + np.bincount(row, weights[terms], place.stop - place.start)
    return raw


def pair_directions(sample: Sample, rows: np.ndarray, error: np.ndarray, size: int, seed: int = 7) -> np.ndarray:
    """``RANK`` sparse unit vectors over the terms, along which products of two terms go with ``error`` most.

    They are eigenvectors of the sum over ``rows`` of error * (x - mean)(x - mean)', whose diagonal, a term with
    itself, is left out. The matrix is never made: it is applied to a vector by one pass over the rows.
    """
    weight, told = np.zeros(sample.labels.size), np.zeros(sample.labels.size)
    weight[rows], told[rows] = 1.0, error
    diagonal, mean, tilt = np.zeros(size), np.zeros(size), np.zeros(size)
    for row, terms, _, n in sample.blocks():
        x = 1 / np.sqrt(n)
        diagonal += np.bincount(terms, np.repeat(told[row] / n, n), size)
        mean += np.bincount(terms, np.repeat(weight[row] * x, n), size)
        tilt += np.bincount(terms, np.repeat(told[row] * x, n), size)
    mean /= max(rows.size, 1)
    total = float(error.sum())

    def applied(u: np.ndarray) -> np.ndarray:
        out = np.zeros((u.shape[1], size))
        across = np.ascontiguousarray(u.T)
        for row, terms, starts, n in sample.blocks():
            e = told[row] / n
            for f, own in enumerate(across):
                out[f] += np.bincount(terms, np.repeat(np.add.reduceat(own[terms], starts) * e, n), size)
        out = out.T - diagonal[:, None] * u
        return out - np.outer(tilt, mean @ u) - np.outer(mean, tilt @ u - total * (mean @ u))

    u = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, min(RANK, size))))[0].astype(np.float32)
    for _ in range(ROUNDS):
        u = np.linalg.qr(applied(u))[0].astype(np.float32)
    for keep in SPARSE:
        out = applied(u)
        if keep < size:
            least = np.partition(np.abs(out), size - keep, axis=0)[size - keep]
            out[np.abs(out) < least] = 0
        u = (out / np.maximum(np.sqrt((out ** 2).sum(axis=0)), 1e-12)).astype(np.float32)
    return u


def pair_features(sample: Sample, u: np.ndarray) -> np.ndarray:
    """Per row of the sample and direction the products of two terms, then the direction's own sum."""
    rank = u.shape[1]
    out = np.zeros((sample.labels.size, 2 * rank))
    across = np.ascontiguousarray(u.T)
    for row, terms, starts, n in sample.blocks():
        for f, column in enumerate(across):
            own = column[terms]
            s = np.add.reduceat(own, starts, dtype=np.float64)
            out[row, f] = (s * s - np.add.reduceat(own * own, starts, dtype=np.float64)) / n
            out[row, rank + f] = s / np.sqrt(n)
    return out


def strengths(features: np.ndarray, offset: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Coefficients of the features and a constant, beside ``offset``, by Newton's method with halved steps."""
    scale = features.std(axis=0)
    scale[scale < 1e-12] = 1
    x = np.concatenate([features / scale, np.ones((y.size, 1))], axis=1)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    c = np.zeros(x.shape[1])

    def loss(at: np.ndarray) -> float:
        raw = offset + x @ at
        return float((np.logaddexp(0, raw) - y * raw).sum() + 0.5 * (penalty * at * at).sum())

    now = loss(c)
    for _ in range(30):
        p = sigmoid(offset + x @ c)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * c)
        length = 1.0
        while length > 1e-4 and loss(c - length * step) > now:
            length /= 2
        if length <= 1e-4:
            break
        c -= length * step
        before, now = now, loss(c)
        if before - now < 1e-7 * abs(before):
            break
    c[:-1] /= scale
    return c


def with_pairs(raw: np.ndarray, features: np.ndarray, c: np.ndarray) -> np.ndarray:
    return raw + features @ c[:-1] + c[-1]


def first_factors(features: np.ndarray, rank: int) -> np.ndarray:
    """The columns of the first ``rank`` of all directions."""
    half = features.shape[1] // 2
    return features[:, [*range(rank), *range(half, half + rank)]]


def fit(sample: Sample, known: np.ndarray, chi: np.ndarray, documents: np.ndarray, seed: int = 7) -> Machine:
    """The machine of the ``known`` buckets; the same rows give the same machine.

    ``chi`` and ``documents`` are those buckets' chi-squared values and training rows.
    """
    y = sample.labels
    machine = constant(float(y.mean()) if y.size else 0.0)
    if not y.size or not 0 < y.sum() < y.size or not known.size:
        return machine
    everything = np.arange(y.size)
    fold = everything % 5 == 0
    part, fold = everything[~fold], everything[fold]
    trust = (chi / (chi + DOUBT)).astype(np.float32)
    epochs, rank = 0, 0
    if 0 < y[part].sum() < part.size:
        # the fold's labels must not say which terms to trust either
        seen, hits = sample.counts(part, known.size)
        less = chi_squared(seen, hits, part.size, int(y[part].sum()))
        less = (less / (less + DOUBT)).astype(np.float32)
        least, kept = np.inf, None
        for epoch, (bias, weights) in enumerate(linear_epochs(sample, part, less, seen, seed)):
            loss = log_loss(linear_raw(sample, fold, bias, weights), y[fold])
            if loss < (1 - SAVING) * least:
                least, epochs, kept = loss, epoch, (bias, weights.copy())
        raw = linear_raw(sample, part, *kept)
        u = pair_directions(sample, part, y[part] - sigmoid(raw), known.size, seed)
        features = pair_features(sample, u)
        beside = linear_raw(sample, fold, *kept)
        for more in range(1, u.shape[1] + 1):
            some = first_factors(features, more)
            c = strengths(some[part], raw, y[part])
            loss = log_loss(with_pairs(beside, some[fold], c), y[fold])
            if loss < (1 - SAVING) * least:
                least, rank = loss, more
        del features, some, u
    for epoch, (bias, weights) in enumerate(linear_epochs(sample, everything, trust, documents, seed)):
        if epoch == epochs:
            break
    machine = Machine(bias, np.zeros(BUCKETS, bool), np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32),
                      np.zeros((BUCKETS, rank), np.float32), np.zeros(rank))
    machine.known[known] = True
    machine.weights[known] = weights
    if rank:
        raw = linear_raw(sample, everything, bias, weights)
        u = pair_directions(sample, everything, y - sigmoid(raw), known.size, seed)[:, :rank]
        c = strengths(pair_features(sample, u), raw, y)
        machine.bias += float(c[-1])
        machine.slopes[known] = u @ c[rank:-1]
        machine.factors[known] = u * np.sqrt(2 * np.abs(c[:rank]))
        machine.signs = np.sign(c[:rank])
    return machine


def gathered(rows: DataFrame, known: np.ndarray, most: int) -> Sample:
    """The ``most`` rows of the lowest (hash of identifier, identifier), their known terms as flat arrays.

    The last place is found from identifiers alone, so no task sorts rows with their buckets; tasks
    send one row of bytes a batch, so the driver makes no object for each training row.
    """
    rank = F.xxhash64("doc_id")
    last = (rows.select(F.struct(rank.alias("h"), "doc_id").alias("at")).orderBy("at").limit(most)
            .agg(F.max("at.h").alias("h")).first()["h"])
    place = np.full(BUCKETS, -1, np.int32)
    place[known] = np.arange(known.size)

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            parts = [place[np.frombuffer(b.as_py(), np.int32)] for b in batch.column("buckets")]
            parts = [p[p >= 0] for p in parts]
            heads = np.stack([batch.column("h").to_numpy(), batch.column("doc_id").to_numpy(),
                              batch.column("toxic").to_numpy().astype(np.int64), np.array([p.size for p in parts], np.int64),
                              np.array([crc32(p.tobytes()) for p in parts], np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([heads.tobytes()], pa.binary()), pa.array([b"".join(p.tobytes() for p in parts)], pa.binary())],
                names=["heads", "terms"])

    kept = rows.withColumn("h", rank).filter(F.col("h") <= F.lit(last)).select("h", "doc_id", "toxic", "buckets")
    heads, parts = [np.zeros((5, 0), np.int64)], []
    for packed in kept.mapInArrow(pack, "heads binary, terms binary").toLocalIterator():
        heads.append(np.frombuffer(packed["heads"], np.int64).reshape(5, -1))
        terms = np.frombuffer(packed["terms"], np.int32)
        parts += np.split(terms, np.cumsum(heads[-1][3])[:-1]) if heads[-1].shape[1] else []
    h, doc_id, toxic, sizes, checksum = np.concatenate(heads, axis=1)
    # rows that repeat an identifier are told apart by their terms
    order = np.lexsort((checksum, sizes, doc_id, h))[:most]
    offsets = np.concatenate([[0], np.cumsum(sizes[order])]).astype(np.int64)
    return Sample(np.concatenate([np.zeros(0, np.int32), *(parts[i] for i in order)]), offsets, toxic[order].astype(np.float64))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Machine:
    ship_code(docs.sparkSession)
    rows = written(training_rows(docs, labels), "toxicity-terms")
    counts = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not counts[0]:
        return constant(0.0)
    n, k = term_statistics(rows)
    known = np.flatnonzero(n >= FLOOR)
    chi = chi_squared(n[known], k[known], counts[0], counts[1])
    return fit(gathered(rows, known, most), known, chi, n[known])


def scorer(spark: SparkSession, machine: Machine):
    """A pandas UDF from text to score."""
    ship_code(spark)
    shared = spark.sparkContext.broadcast(machine)  # BUCKETS x (RANK + 3) numbers at most

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, model = Buckets(), shared.value
        for texts in batches:
            yield pd.Series([model.score(buckets_of(t or "", known)) for t in texts], dtype="float64")

    return score


def toxicity_scores(docs: DataFrame, labels: DataFrame, machine: Machine | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    score = scorer(docs.sparkSession, machine or train(docs, labels))
    scored = docs.select("doc_id", held_out().alias("held_out"), score(text_or_empty()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def clean_documents(docs: DataFrame, labels: DataFrame, machine: Machine | None = None) -> DataFrame:
    """The documents below the cut, whole, in their own columns."""
    score = scorer(docs.sparkSession, machine or train(docs, labels))
    return docs.filter(score(text_or_empty()) < CUT)
