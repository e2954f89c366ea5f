"""Token-id files: every document its own zstandard frame, one shared dictionary.

File format (little-endian), one file per range of document ids:

    8 bytes   magic "TOKSHRD1"
    32 bytes  sha256 of the shared dictionary (zeros: no dictionary)
    8 bytes   bytes per id (2 or 4)
    frames    one per document, in ascending id order
    index     int64 ids, int64 token counts, int64 frame offsets (one more
              than documents: the last is the end of the frames)
    16 bytes  number of documents, position of the index

The index gives random access to short documents: one seek, one frame, the
dictionary making small frames compress well. The dictionary is trained on a
bounded sample (``SAMPLE_CHUNKS`` chunks of at most ``CHUNK_BYTES`` of
serialized ids, the chunks with the smallest hashes); it changes only sizes,
never contents.

Documents are range-partitioned by (id, text hash), encoded and written by
the task that holds the range, so ids are never shuffled; positions are a
prefix sum over one row per file. A null text is an empty document. A null id
sorts after all ids and comes back as null. Repeated ids are separate
documents next to each other, equal rows included. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import NO_ID, Workspace, column, fetch, id_or_null, ids, prepare, publish
from riskloom.llm.encode import encoder

MAGIC = b"TOKSHRD1"
SAMPLE_CHUNKS = 2000
CHUNK_BYTES = 8192
DICT_BYTES = 64 << 10
FILE_BYTES = 32 << 20  # of text
LEVEL = 3


def _sorted_by_id(docs: DataFrame, id_col: str, text_col: str, file_bytes: int) -> tuple[DataFrame, int]:
    """(id, text) in ascending id order over as many partitions as the text's size asks for, and the row count."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = max(1, -(-(size or 0) // file_bytes))
    by = ("id", F.xxhash64("text"))
    return rows.repartitionByRange(parts, *by).sortWithinPartitions(*by), n


def train_dictionary(docs: DataFrame, n: int, tokenizer, spaces: str, end_id: int, id_col: str, text_col: str) -> bytes:
    """Dictionary trained on about ``SAMPLE_CHUNKS`` chunks of id arrays; empty where there is too little to train on."""
    every = max(1, n // SAMPLE_CHUNKS)

    def chunks(batches):
        enc = encoder(tokenizer, spaces)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            for text in column(batch, "text").to_pylist():
                data = enc.encode(text) + end
                parts = [data[i : i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES)]
                yield pa.RecordBatch.from_arrays([pa.array([hash_of(p) for p in parts], pa.int64()), pa.array(parts, pa.binary())], ["h", "chunk"])

    def hash_of(part: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(part, digest_size=7).digest(), "little")

    some = docs.where(F.pmod(F.xxhash64(id_col), F.lit(every)) == 0).select(F.col(text_col).alias("text"))
    sample = some.mapInArrow(chunks, "h long, chunk binary").orderBy("h", "chunk").limit(SAMPLE_CHUNKS).collect()
    data = [bytes(r["chunk"]) for r in sample]
    size = min(DICT_BYTES, sum(map(len, data)) // 8)
    if size < 1024 or len(data) < 16:
        return b""
    try:
        return zstd.train_dictionary(size, data).as_bytes()
    except zstd.ZstdError:  # the trainer found nothing that repeats
        return b""


def _dictionary(data: bytes) -> zstd.ZstdCompressionDict | None:
    return zstd.ZstdCompressionDict(data) if data else None


def _digest(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest() if dictionary else bytes(32)


class ShardWriter:
    """Collects the frames of one file."""

    def __init__(self, dictionary: bytes, width: int):
        self._compress = zstd.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary)).compress
        self._head = MAGIC + _digest(dictionary) + width.to_bytes(8, "little")
        self._width, self._frames, self._ids, self._counts, self._offsets = width, [], [], [], [len(self._head)]

    def add(self, doc: int, data: bytes) -> None:
        frame = self._compress(data)
        self._frames.append(frame)
        self._ids.append(doc)
        self._counts.append(len(data) // self._width)
        self._offsets.append(self._offsets[-1] + len(frame))

    def tokens(self) -> int:
        return sum(self._counts)

    def to_bytes(self) -> bytes:
        index = b"".join(np.array(x, "<i8").tobytes() for x in (self._ids, self._counts, self._offsets))
        tail = np.array([len(self._ids), self._offsets[-1]], "<i8").tobytes()
        return b"".join([self._head, *self._frames, index, tail])


class ShardReader:
    """Reads any document of one file by its place, or all in order."""

    def __init__(self, data: bytes, dictionary: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        if data[8:40] != _digest(dictionary):
            raise ValueError("the file was written with another dictionary")
        self._data, self.dtype = data, np.dtype(f"<u{int.from_bytes(data[40:48], 'little')}")
        n, at = np.frombuffer(data[-16:], "<i8")
        index = np.frombuffer(data, "<i8", 3 * n + 1, at)
        self.ids, self.counts, self.offsets = index[:n], index[n : 2 * n], index[2 * n :]
        self._plain = zstd.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress

    def __len__(self) -> int:
        return len(self.ids)

    def tokens(self, place: int) -> np.ndarray:
        return np.frombuffer(self._plain(self._data[self.offsets[place] : self.offsets[place + 1]]), self.dtype)


def write_tokens(
    docs: DataFrame, folder: str, tokenizer_json: str, spaces: str, end_id: int,
    id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Encode every text, append ``end_id`` and publish the files; returns (file, docs, tokens), one row per file."""
    spark = docs.sparkSession
    prepare(spark)
    tokenizer = spark.sparkContext.broadcast(tokenizer_json)
    rows, n = _sorted_by_id(docs, id_col, text_col, file_bytes)
    dictionary = train_dictionary(docs, n, tokenizer, spaces, end_id, id_col, text_col)
    publish(folder, "dictionary", dictionary)

    def write(batches):
        enc = encoder(tokenizer, spaces)
        end = np.array([end_id], enc.dtype).tobytes()
        out = ShardWriter(dictionary, enc.dtype.itemsize)
        for batch in batches:
            for doc, text in zip(column(batch, "id").to_pylist(), column(batch, "text").to_pylist()):
                out.add(doc, enc.encode(text) + end)
        part = TaskContext.get().partitionId()
        publish(folder, f"part-{part:06d}", out.to_bytes())
        yield pa.RecordBatch.from_pydict({"file": pa.array([part], pa.int32()), "tokens": pa.array([out.tokens()], pa.int64())})

    return rows.mapInArrow(write, "file int, tokens long")


def read_tokens(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, read from the files that ``files`` lists."""
    before = F.sum("tokens").over(Window.orderBy("file")) - F.col("tokens")  # one row per file
    dictionary = fetch(folder, "dictionary")

    def read(batches):
        for batch in batches:
            for file, start in zip(column(batch, "file").to_pylist(), column(batch, "before").to_pylist()):
                shard = ShardReader(fetch(folder, f"part-{file:06d}"), dictionary)
                crc = [zlib.crc32(shard.tokens(i).astype("<u4").tobytes()) for i in range(len(shard))]
                starts = start + np.cumsum(shard.counts) - shard.counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.ids), pa.array(starts, pa.int64()), pa.array(shard.counts), pa.array(crc, pa.int64())],
                    ["id", "start", "n_tokens", "ids_crc32"],
                )

    placed = files.withColumn("before", before)
    n = max(1, files.count())
    return placed.repartition(n, "file").mapInArrow(read, "id long, start long, n_tokens long, ids_crc32 long")


def token_files(
    docs: DataFrame, tokenizer_json: str, spaces: str = "joins", end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write the files and read every document back from them."""
    spark = docs.sparkSession
    ws = Workspace(spark, "tokens")
    folder = folder or ws.path("files")
    files = ws.save(write_tokens(docs, folder, tokenizer_json, spaces, end_id, id_col, text_col, file_bytes), "manifest")
    back = read_tokens(spark, folder, files)
    return back.select(id_or_null("id").alias(id_col), "start", "n_tokens", "ids_crc32")
