"""Byte-level BPE over Arrow batches: encode to ids with offsets, decode back to bytes.

* ``encode_documents``: ids and, for each, the characters it covers (``offsets``) and its first byte (``byte_starts``).
* ``decode_documents``: ids to bytes through the reversed byte table, and to text.
* ``StreamDecoder``: text as ids arrive; bytes of a character still incomplete wait for the next id.
* ``token_digests``: what a query needs of both directions, in one pass over the texts.

Defined cases: a null or empty text has no ids and decodes to no bytes;
repeated rows are encoded each; an empty table gives an empty result. Ids that
end within a character decode to its first bytes, shown as U+FFFD in ``text``.
Lone surrogates cannot occur in a Spark string.
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from usageloom.llm.common import ship_code
from usageloom.llm.encoders import byte_alphabet, byte_bpe, rows_of

ENCODED = "doc_id long, ids array<int>, offsets array<struct<start:int,end:int>>, byte_starts array<int>"
DECODED = "doc_id long, bytes binary, text string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def reversed_table() -> dict[str, int]:
    return {character: byte for byte, character in enumerate(byte_alphabet())}


def token_bytes(path: str, pattern: str) -> list[bytes]:
    """The bytes of each id, read back from the encoder's own vocabulary through the reversed byte table."""
    encoder = byte_bpe(path, pattern)
    if not hasattr(encoder, "table"):
        back = reversed_table()
        table = [b""] * encoder.tokenizer.get_vocab_size()
        for token, i in encoder.tokenizer.get_vocab().items():
            table[i] = bytes(back[c] for c in token)
        encoder.table = table
    return encoder.table


def decode_ids(ids: Iterable[int], table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids))


class StreamDecoder:
    """Decodes id by id; a character split over ids appears once its last byte is there."""

    def __init__(self, table: list[bytes]):
        self.table = table
        self.text = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, token: int) -> str:
        return self.text.decode(self.table[token])

    def end(self) -> str:
        return self.text.decode(b"", final=True)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    ship_code(docs.sparkSession)

    def encoded(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder, table = byte_bpe(path, pattern), token_bytes(path, pattern)
        kind = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())),
                          ("offsets", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                          ("byte_starts", pa.list_(pa.int32()))])
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            ids, spans = encoder.encode_with_offsets(text or "")
            starts, at = [], 0
            for i in ids:
                starts.append(at)
                at += len(table[i])
            spans = [{"start": a, "end": b} for a, b in spans]
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": doc_id, "ids": ids, "offsets": spans, "byte_starts": starts}], schema=kind)

    return docs.select("doc_id", "text").mapInArrow(encoded, ENCODED)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    ship_code(encoded.sparkSession)

    def decoded(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = token_bytes(path, pattern)
        kind = pa.schema([("doc_id", pa.int64()), ("bytes", pa.binary()), ("text", pa.string())])
        for doc_id, ids in rows_of(batches, "doc_id", "ids"):
            whole = decode_ids(ids or [], table)
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": doc_id, "bytes": whole, "text": whole.decode("utf-8", "replace")}], schema=kind)

    return encoded.select("doc_id", "ids").mapInArrow(decoded, DECODED)


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Number of ids, their digest, and the digest of what they decode to, for each whole text."""
    ship_code(docs.sparkSession)

    def digests(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encoder, table = byte_bpe(path, pattern), token_bytes(path, pattern)
        kind = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                          ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
        for batch in batches:
            out = []
            for doc_id, text in rows_of([batch], "doc_id", "text"):
                ids = encoder.encode(text or "")
                whole = decode_ids(np.frombuffer(ids, "<u4").tolist(), table)
                out.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(whole).hexdigest()))
            columns = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

    return docs.select("doc_id", "text").mapInArrow(digests, DIGESTS)
