"""Operator 4: token ids as length-delimited binary records.

A shard is a sequence of records, each framed as

    u64 length | u32 masked crc of the length | payload | u32 masked crc of the payload

(little-endian; the mask rotates a CRC-32 by 15 bits and adds a constant, so a
checksum stored beside its data is not a checksum of checksums). A payload is
the i64 document id, the u8 width of an id in bytes (2 where the vocabulary
fits, else 4) and the ids. Beside each shard lies an index of fixed-width
entries (document id, byte offset, payload length, ids), which lets a reader
fetch records in any order.

Documents are dealt by ranges of ``doc_id`` and sorted in their range; one task
writes one shard under a name of its own, so a repeated task leaves at most an
unlisted file, and the manifest, one row per shard, names the files that count.
The global start of a document is the shard's offset (a running sum over the
manifest) plus its place in the shard.

Defined results: null or empty text -> the end id alone; null ids sort first;
rows that repeat an id follow each other in unspecified order; an empty
table writes no shard and gives no rows; extra columns are ignored.
"""
from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.llm.bpe_words import BatchEncoder, slices
from balances.llm.common import new_path, table, text_or_empty

END_ID = 2
MASK_DELTA = 0xA282EAD8
NO_ID = -(1 << 63)
HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
BODY = struct.Struct("<qB")
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u8"), ("n_ids", "<u8")])
MANIFEST = "path string, first_id long, n_docs long, n_ids long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"

_encoders: dict = {}


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, TAIL.pack(masked(size)), payload, TAIL.pack(masked(payload))))


def unframe(stream, where: str = "") -> bytes | None:
    """The next record's payload, None at the end; raises on damage."""
    head = stream.read(HEAD.size)
    if not head:
        return None
    if len(head) < HEAD.size or HEAD.unpack(head)[1] != masked(head[:8]):
        raise ValueError(f"damaged record length {where}")
    n = HEAD.unpack(head)[0]
    payload, crc = stream.read(n), stream.read(TAIL.size)
    if len(payload) < n or len(crc) < TAIL.size or TAIL.unpack(crc)[0] != masked(payload):
        raise ValueError(f"damaged record {where}")
    return payload


def ids_of(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc, width = BODY.unpack_from(payload)
    return (None if doc == NO_ID else doc), np.frombuffer(payload, f"<u{width}", offset=BODY.size)


def file_system(uri: str):
    """File system and path of a URI, for local and shared stores alike."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if ":" in uri else (fs.LocalFileSystem(), uri)


def _encoder(path: str) -> BatchEncoder:
    if path not in _encoders:
        e = BatchEncoder(path)
        if e.library.get_vocab_size() <= 1 << 16:
            e = BatchEncoder(path, "<u2")
        _encoders[path] = e
    return _encoders[path]


def write_shard(batches, folder: str, tokenizer_path: str, end_id: int):
    """Write one task's rows, already in order, as a shard and its index."""
    coder, name = _encoder(tokenizer_path), f"{folder}/{uuid.uuid4().hex}"
    end = np.array([end_id], coder.dtype).tobytes()
    width = coder.dtype.itemsize
    out = index = None
    first, offset, total, docs = None, 0, 0, 0
    for b in batches:
        keys, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
        if out is None and keys:
            store, path = file_system(name)
            store.create_dir(path.rpartition("/")[0], recursive=True)
            out, index = (store.open_output_stream(f"{path}.{kind}") for kind in ("records", "index"))
            first = keys[0]
        for i, j in slices(texts):
            entries = []
            for key, ids in zip(keys[i:j], coder.encode_many(texts[i:j])):
                record = frame(BODY.pack(NO_ID if key is None else key, width) + ids + end)
                n = len(ids) // width + 1
                entries.append((NO_ID if key is None else key, offset, len(record) - HEAD.size - TAIL.size, n))
                out.write(record)
                offset += len(record)
                total += n
            index.write(np.array(entries, INDEX).tobytes())
            docs += len(entries)
    if out is not None:
        out.close()
        index.close()
        yield pa.RecordBatch.from_pydict({"path": [name], "first_id": pa.array([first], pa.int64()),
                                          "n_docs": [docs], "n_ids": [total]})


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID,
                  id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """Write all shards; returns (path, start) per shard in document order. The
    driver sees one manifest row per shard, never ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       text_or_empty(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    manifest = rows.mapInArrow(
        lambda bs: write_shard(bs, folder, tokenizer_path, end_id), MANIFEST).collect()
    start, shards = 0, []
    for m in sorted(manifest, key=lambda m: (m.first_id is not None, m.first_id or 0)):
        shards.append((m.path, start))
        start += m.n_ids
    return shards


def read_index(path: str) -> np.ndarray:
    store, p = file_system(path)
    with store.open_input_stream(f"{p}.index") as f:
        return np.frombuffer(f.read(), INDEX)


def read_record(path: str, entry) -> tuple[int | None, np.ndarray]:
    """One record by its index entry, for reads in any order."""
    store, p = file_system(path)
    with store.open_input_file(f"{p}.records") as f:
        f.seek(int(entry["offset"]))
        return ids_of(unframe(f, f"{path} at {entry['offset']}"))


def read_shards(batches):
    """Digest rows of the shards named in each batch, streamed by record and
    held against the index."""
    for b in batches:
        for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
            store, p = file_system(path)
            entries = read_index(path)
            rows = []
            with store.open_input_stream(f"{p}.records", buffer_size=1 << 20) as f:
                for entry in entries:
                    doc, ids = ids_of(unframe(f, path))
                    if len(ids) != entry["n_ids"]:
                        raise ValueError(f"index and record differ in {path}")
                    rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
                if unframe(f, path) is not None:
                    raise ValueError(f"record without index entry in {path}")
            if rows:
                yield _batch(rows)


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, shards: list[tuple[str, int]]) -> DataFrame:
    if not shards:
        return spark.createDataFrame([], RESULT)
    named = spark.createDataFrame(shards, "path string, start long")
    return named.repartition(len(shards)).mapInArrow(read_shards, RESULT)


def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    shards = write_records(table(spark, sf_dir, "documents"), new_path(spark, "records"),
                           public_tokenizers.path("byte_bpe_50k.json"))
    return read_digests(spark, shards)
