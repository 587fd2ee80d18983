"""Byte-level BPE over a documents table: encoding with offsets, decoding, and round-trip digests."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.bpe import encoder
from trendspark.llm.common import mapped, text_or_empty


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, offsets)``: token ids of each whole text and the byte offset of each token.

    ``vocabulary`` is the path of a rank file or of a byte-level tokenizer
    file that every executor has. Null and empty texts give empty arrays. Rows
    with a null or repeated id are encoded like any other.
    """
    def encode(batches):
        own = encoder(vocabulary, fast=True)
        for batch in batches:
            ids = list(own.encode(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                 pa.array([own.offsets(x)[:-1] for x in ids], pa.list_(pa.int64()))], ["doc_id", "ids", "offsets"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return mapped(rows, encode, "doc_id long, ids array<int>, offsets array<long>")


def decode_documents(tokens: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, data)``: the bytes that the ids stand for. A null list gives null; an unknown id is an error."""
    def decode(batches):
        own = encoder(vocabulary, fast=True)
        for batch in batches:
            data = [None if x is None else own.decode(np.asarray(x, np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    rows = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return mapped(rows, decode, "doc_id long, data binary")


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every whole text in one pass and returns digests only.

    ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: the first digest is of
    the decimal ids joined by commas, the second of the decoded bytes. The ids
    never leave the task, so nothing is shuffled. Null is the empty text.
    """
    def digest(batches):
        own = encoder(vocabulary, fast=True)
        decimal = [str(i) for i in range(len(own.values))]
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for ids in own.encode(batch.column(1).to_pylist()):
                listed = ids.tolist()
                counts.append(len(listed))
                of_ids.append(hashlib.sha256(",".join(map(decimal.__getitem__, listed)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(b"".join(map(own.values.__getitem__, listed))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return mapped(rows, digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
