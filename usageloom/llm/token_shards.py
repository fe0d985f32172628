"""Token ids in training order, as fixed-stride binary shards.

The ids of a task's documents, each with an end mark behind it, are one stream that is cut into
sequences of ``STRIDE`` ids; only the last sequence of a task is filled up (with the end mark). So a
sequence holds spans of one document or more, and a document runs on from one sequence into the next.
Sequences have numbers 0 to n - 1; a keyed Feistel
permutation gives each a global slot: it permutes the smallest power of four
that holds n, and a slot beyond n - 1 is permuted again until it lies within
(cycle-walking). So the order needs no sort key, no memory and only the key to
repeat. Slot s lies in shard s // ``PER_SHARD`` at byte
(s % PER_SHARD) * STRIDE * 2, as little-endian unsigned 16-bit ids; readers seek.

A shard is a range of slots and is one partition, by its number; it is written by one task at a time,
under a name of its own first and then renamed, so a task that runs twice, or dies, leaves
whole files only. Beside every shard lies its checksum; a repeated run leaves
shards alone whose checksum is as it would be written.

Sequences are numbered by the file they were stored in and their row there, so
numbering moves nothing. Until they are in a shard their ids are packed: one byte for the ``COMMON`` ids most frequent
in the first documents, two for any other, and a bit that says which. Those documents decide the size only.
The index has one row per span: where it lies, and which ids of its document it holds.

Defined cases: a null or empty text is one id, the end mark; repeated rows are written each; a null doc_id stays
null in the index; an empty table writes no shard and gives an empty result.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usageloom.llm.common import shared_folder, ship_code, text_or_empty, written
from usageloom.llm.encoders import rows_of, word_bpe

STRIDE = 512
PER_SHARD = 8192
END = 1
ROUNDS = 6
KEY = 20240229

SPAN = "struct<doc_id:long,start:long,offset:int,length:int>"
SEQUENCES = f"n_tokens int, ids binary, spans array<{SPAN}>"
PLACED = f"slot long, n_tokens int, shard long, byte_offset long, ids_crc32 long, shard_crc32 long, spans array<{SPAN}>"
#: ids gathered before they are cut
GATHERED = 1 << 18
#: characters encoded together, and what a document counts for besides its own
AT_ONCE, EACH = 1 << 20, 64
#: ids that are packed into one byte, and the documents, and characters of each, that are looked at to find them
COMMON = 256
SAMPLE, CHARACTERS = 256, 4000


class Stream:
    """The ids of documents one behind the other, given back in sequences."""

    def __init__(self, stride: int):
        self.stride, self.size, self.documents = stride, 0, []

    def add(self, doc_id: int | None, ids: np.ndarray, start: int = 0) -> None:
        self.documents.append((doc_id, start, ids))
        self.size += ids.size

    def cut(self, last: bool = False):
        """A batch of the whole sequences there are, ``last`` with the one that is not; the rest stays."""
        import pyarrow as pa

        stride = self.stride
        rows = -(-self.size // stride) if last else self.size // stride
        flat = np.concatenate([np.zeros(0, "<u2"), *(ids for _, _, ids in self.documents)])
        upto = min(rows * stride, flat.size)
        sizes = np.array([ids.size for _, _, ids in self.documents], np.int64)
        begins = np.cumsum(sizes) - sizes
        ends = np.minimum(begins + sizes, upto)
        used = np.flatnonzero(begins < upto)
        first = begins[used] // stride
        parts = (ends[used] - 1) // stride - first + 1
        document = np.repeat(used, parts)
        sequence = np.repeat(first - (np.cumsum(parts) - parts), parts) + np.arange(int(parts.sum()))
        at = np.maximum(begins[document], sequence * stride)
        length = np.minimum(ends[document], (sequence + 1) * stride) - at
        starts = np.array([start for _, start, _ in self.documents], np.int64)
        names = [self.documents[d][0] for d in document.tolist()]
        spans = pa.StructArray.from_arrays(
            [pa.array(names, pa.int64()), pa.array(starts[document] + at - begins[document]),
             pa.array((at - sequence * stride).astype(np.int32)), pa.array(length.astype(np.int32))],
            names=["doc_id", "start", "offset", "length"])
        edges = np.searchsorted(sequence, np.arange(rows + 1)).astype(np.int32)
        cuts = np.minimum(np.arange(rows + 1) * stride, upto)
        ids = pa.Array.from_buffers(
            pa.binary(), rows, [None, pa.py_buffer((cuts * 2).astype(np.int32)), pa.py_buffer(flat[:upto].tobytes())])
        batch = pa.RecordBatch.from_arrays(
            [pa.array(np.diff(cuts).astype(np.int32)), ids, pa.ListArray.from_arrays(pa.array(edges), spans)],
            names=["n_tokens", "ids", "spans"])
        if flat.size > upto:
            left = int(np.searchsorted(begins, upto, "right")) - 1
            rest, skipped = self.documents[left:], int(upto - begins[left])
            doc_id, start, ids = rest[0]
            self.documents = [(doc_id, start + skipped, ids[skipped:]), *rest[1:]]
        else:
            self.documents = []
        self.size = flat.size - upto
        return batch


def together(rows: Iterator[tuple]) -> Iterator[tuple[list, list[str]]]:
    """Names and texts of documents, in groups of some ``AT_ONCE`` characters."""
    names, texts, size = [], [], 0
    for name, text in rows:
        names.append(name)
        texts.append(text)
        size += len(text) + EACH
        if size >= AT_ONCE:
            yield names, texts
            names, texts, size = [], [], 0
    if texts:
        yield names, texts


def common_ids(docs: DataFrame, vocabulary: str) -> np.ndarray:
    """The ``COMMON`` most frequent ids in the beginnings of the first documents."""
    encoder, mark = word_bpe(vocabulary), END.to_bytes(4, "little")
    texts = docs.select(F.substring(text_or_empty(), 1, CHARACTERS).alias("text")).take(SAMPLE)
    ids = np.frombuffer(b"".join(encoder.encode(r["text"]) + mark for r in texts), "<u4").astype("<u2")
    return np.argsort(-np.bincount(ids, minlength=COMMON), kind="stable")[:COMMON].astype("<u2")


def pack(ids: np.ndarray, sizes: np.ndarray, common: np.ndarray) -> list[bytes]:
    """Each sequence of ``ids`` as bytes: a bit for every id, set if it is rare (not in ``common``), up to a whole byte;
    for every id its place in ``common``, or its low byte; the high bytes of the rare ones."""
    code = np.arange(1 << 16, dtype="<u2") & 255 | 256
    code[common] = np.arange(common.size)
    found = np.take(code, ids)
    rare = found > 255
    ends, gaps = np.cumsum(sizes), -sizes % 8
    marks = np.packbits(np.insert(rare, np.repeat(ends, gaps), False)).tobytes()
    first = found.astype(np.uint8).tobytes()
    at = np.flatnonzero(rare)
    second = (ids[at] >> 8).astype(np.uint8).tobytes()
    edges = np.stack([np.cumsum((sizes + gaps) // 8), ends, np.searchsorted(at, ends)], axis=1).tolist()
    return [marks[m:n] + first[a:b] + second[c:d] for (m, a, c), (n, b, d) in zip([[0, 0, 0], *edges], edges)]


def unpack(rows: list[bytes], sizes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The ids of packed sequences, one sequence behind the other."""
    ends, gaps = np.cumsum(sizes), -sizes % 8
    edges = np.stack([(sizes + gaps) // 8, (sizes + gaps) // 8 + sizes], axis=1).tolist()
    marks, first, second = (np.frombuffer(b"".join(parts), np.uint8) for parts in (
        [r[:m] for r, (m, _) in zip(rows, edges, strict=True)],
        [r[m:n] for r, (m, n) in zip(rows, edges, strict=True)],
        [r[n:] for r, (_, n) in zip(rows, edges, strict=True)]))
    filled = np.repeat(ends, gaps) + np.arange(gaps.sum())
    at = np.flatnonzero(np.delete(np.unpackbits(marks), filled).view(bool))
    ids = np.take(np.resize(common, COMMON), first)
    ids[at] = first[at] | second.astype("<u2") << 8
    return ids


def cut_sequences(docs: DataFrame, vocabulary: str, stride: int = STRIDE, common: np.ndarray | None = None) -> DataFrame:
    """Sequences with the spans they hold, all full but the last of a task; ids as unsigned 16 bit, or packed by ``common``."""
    ship_code(docs.sparkSession)

    def stored(batch):
        import pyarrow as pa

        if common is None:
            return batch
        ids = np.frombuffer(batch.column("ids").buffers()[2], "<u2")
        packed = pa.array(pack(ids, batch.column("n_tokens").to_numpy(), common), pa.binary())
        return batch.set_column(batch.schema.get_field_index("ids"), "ids", packed)

    def sequences(batches: Iterator) -> Iterator:
        encoder, stream = word_bpe(vocabulary), Stream(stride)
        for names, texts in together(rows_of(batches, "doc_id", "text")):
            ids, ends = encoder.encode_all(texts)
            marked = np.insert(ids.astype("<u2"), ends, END)
            for doc_id, part in zip(names, np.split(marked, ends[:-1] + np.arange(1, ends.size)), strict=True):
                stream.add(doc_id, part)
            if stream.size >= max(GATHERED, stride):
                yield stored(stream.cut())
        if stream.size:
            yield stored(stream.cut(last=True))

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(sequences, SEQUENCES)


def half_bits(total: int) -> int:
    """Bits of each half of the domain, the smallest power of four that holds ``total``."""
    return max(1, (max(total - 1, 1).bit_length() + 1) // 2)


def feistel(value: Column, bits: int, key: int = KEY, rounds: int = ROUNDS) -> Column:
    """A permutation of 0 .. 4 ** bits - 1 under ``key``."""
    mask = F.lit((1 << bits) - 1).cast("long")
    left, right = F.shiftright(value, bits), value.bitwiseAND(mask)
    for i in range(rounds):
        mix = F.xxhash64(right, F.lit(key).cast("long"), F.lit(i)).bitwiseAND(mask)
        left, right = right, left.bitwiseXOR(mix)
    return F.shiftleft(left, bits).bitwiseOR(right)


def slots(numbered: DataFrame, total: int, key: int = KEY) -> DataFrame:
    """Adds ``slot`` to rows with ``number`` in 0 .. total - 1, by walking the cycle of each until it is below ``total``.

    The domain is under four times ``total``, so a row walks four steps on average. Steps are evaluated one
    after another, each only for rows still outside; the few longest walks go on in the executors as well.
    """
    bits = half_bits(total)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(64)), feistel(F.col("number"), bits, key),
        lambda at, _: F.when(at < total, at).otherwise(feistel(at, bits, key)))
    rows = numbered.withColumn("slot", walked)
    outside = F.col("slot") >= total
    again = F.aggregate(F.sequence(F.lit(1), F.lit(4096)), F.col("slot"),
                        lambda at, _: F.when(at < total, at).otherwise(feistel(at, bits, key)))
    return rows.withColumn("slot", F.when(outside, again).otherwise(F.col("slot")))


def numbered(path: str, spark: SparkSession) -> tuple[DataFrame, int]:
    """Stored sequences with ``number``: rows of the files before, in order of file names, plus the row in the file."""
    stored = spark.read.schema(SEQUENCES).parquet(path)
    hidden = stored.metadataColumn("_metadata")
    placed = stored.select("*", hidden["file_name"].alias("_file"), hidden["row_index"].alias("_row"))
    counts = written(placed.groupBy("_file").agg(F.count(F.lit(1)).alias("n")), "sequence-files")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    before = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    base = counts.withColumn("_base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return placed.join(base, "_file").withColumn("number", F.col("_base") + F.col("_row")), total


def open_store(uri: str):
    """File system and path of a shared folder, for executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def write_shards(placed: DataFrame, total: int, folder: str, stride: int = STRIDE, per_shard: int = PER_SHARD,
                 common: np.ndarray | None = None) -> DataFrame:
    """Writes the shards and returns where each sequence lies. ``placed``: slot, n_tokens, ids (packed if ``common`` is given), spans."""
    ship_code(placed.sparkSession)
    shards = max(1, -(-total // per_shard))
    ranged = placed.withColumn("shard", F.floor(F.col("slot") / per_shard).cast("int"))
    dealt = ranged.repartitionById(shards, "shard").sortWithinPartitions("slot")

    def plain(batch) -> list[bytes]:
        rows = batch.column("ids").to_pylist()
        if common is None:
            return rows
        sizes = batch.column("n_tokens").to_numpy()
        ids = unpack(rows, sizes, common).tobytes()
        ends = (2 * np.cumsum(sizes)).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        filling = np.full(stride, END, "<u2").tobytes()
        kept, parts = [], []
        for batch in batches:
            if batch.num_rows:
                rows = plain(batch)
                parts += [ids + filling[len(ids):] for ids in rows]
                kept.append((batch.select(["shard", "slot", "n_tokens", "spans"]), [zlib.crc32(ids) for ids in rows]))
        if not kept:
            return
        shard = kept[0][0].column("shard")[0].as_py()
        crc = 0
        for part in parts:
            crc = zlib.crc32(part, crc)
        name = f"{root}/shard-{shard:08d}"
        note = f"{len(parts)} {stride} {crc}".encode()
        if not already(store, name, note):
            own = f"{name}.{uuid.uuid4().hex}.part"
            for suffix, content in ((".bin", parts), (".ok", [note])):
                with store.open_output_stream(own) as out:
                    for part in content:
                        out.write(part)
                store.move(own, name + suffix)
        for batch, sums in kept:
            slot, n = batch.column("slot"), batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [slot, batch.column("n_tokens"), pa.array([shard] * n, pa.int64()),
                 pa.array(slot.to_numpy() % per_shard * stride * 2), pa.array(sums, pa.int64()), pa.array([crc] * n, pa.int64()),
                 batch.column("spans")],
                names=["slot", "n_tokens", "shard", "byte_offset", "ids_crc32", "shard_crc32", "spans"])

    return dealt.select("shard", "slot", "n_tokens", "ids", "spans").mapInArrow(write, PLACED)


def already(store, name: str, note: bytes) -> bool:
    from pyarrow import fs

    found = store.get_file_info([f"{name}.bin", f"{name}.ok"])
    if any(f.type != fs.FileType.File for f in found):
        return False
    with store.open_input_stream(f"{name}.ok") as inp:
        return inp.read() == note


def read_slots(folder: str, first: int, count: int, stride: int = STRIDE, per_shard: int = PER_SHARD) -> Iterator[np.ndarray]:
    """Sequences ``first`` .. ``first + count - 1`` in training order: resumes anywhere by seeking."""
    store, root = open_store(folder)
    at, end = first, first + count
    while at < end:
        shard, row = divmod(at, per_shard)
        with store.open_input_file(f"{root}/shard-{shard:08d}.bin") as inp:
            rows = min(end - at, per_shard - row)
            inp.seek(row * stride * 2)
            part = np.frombuffer(inp.read(rows * stride * 2), "<u2").reshape(-1, stride)
        yield from part
        at += rows


def materialise(docs: DataFrame, vocabulary: str, folder: str | None = None, key: int = KEY,
                stride: int = STRIDE, per_shard: int = PER_SHARD) -> DataFrame:
    """Writes all shards under ``folder`` and returns one row per span of a document: where it lies, with checksums.

    The span holds the document's ids ``start`` to ``start + length`` and lies ``offset`` ids behind the
    beginning of its sequence, which is at ``byte_offset`` of the shard.
    """
    spark = docs.sparkSession
    base = shared_folder(spark, "token-shards")
    common = common_ids(docs, vocabulary)
    cut_sequences(docs, vocabulary, stride, common).write.option("compression", "zstd").parquet(f"{base}/sequences")
    rows, total = numbered(f"{base}/sequences", spark)
    placed = slots(rows, total, key).select("slot", "n_tokens", "ids", "spans")
    index = write_shards(placed, total, folder or f"{base}/shards", stride, per_shard, common).select(
        F.inline("spans"), "slot", "n_tokens", "shard", "byte_offset", "ids_crc32", "shard_crc32")
    return written(index, "shard-index")
