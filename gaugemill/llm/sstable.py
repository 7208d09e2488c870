"""Token ids in sorted-string-table shards.

A shard holds documents in ascending order of their key. Its parts, in order:

* data blocks of about ``BLOCK_BYTES``: entries of varints (shared, unshared, value length), the
  key's unshared suffix and the value; the first entry of a block shares nothing; a checksum ends
  the block;
* the sparse index: for each block its first key, place and length;
* a Bloom filter over all keys;
* the footer: places of index and filter, counts of entries and ids, and a magic number.

A key is looked up by the filter, a binary search of the index, and a scan of one block. A value
is the document's ids as little-endian unsigned integers of ``width`` bytes.

Keys are identifiers turned into bytes that sort as the identifiers do: nothing for null (so null
comes first), else a tag and eight big-endian bytes for integers, or a tag and UTF-8 for text.
Repeated keys stay as repeated entries, ordered by their text's hash and the text.

Spark deals the documents by key ranges; each task streams one shard to the shared folder under a
name of its own and renames it at the end, so that a retried task replaces nothing half-written.

Edge cases: an empty table gives a manifest without documents, and no rows when it is read; null and
empty texts have the end id alone; a very long text is one entry, and a block of its own; rows that
share a key are entries of their own; of the table only key and text are read.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import file_system, put_file, scratch, sliced
from .piece_cache import piece_encoder

BLOCK_BYTES = 64 * 1024
BLOOM_BITS_A_KEY, BLOOM_HASHES = 10, 7
MAGIC = b"GMSST\x00\x00\x01"
FOOTER = struct.Struct("<QQQQQQB8s")
#: Characters of text for which one shard is planned.
SHARD_CHARS = 64_000_000


def key_bytes(key: int | str | None) -> bytes:
    """Bytes that sort as the keys do: null, integers, text."""
    if key is None:
        return b""
    if isinstance(key, int):
        return b"i" + struct.pack(">Q", key + (1 << 63))
    return b"t" + key.encode()


def key_of(raw: bytes) -> int | str | None:
    if not raw:
        return None
    return struct.unpack(">Q", raw[1:])[0] - (1 << 63) if raw[:1] == b"i" else raw[1:].decode()


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def bloom_places(key: bytes, bits: int) -> list[int]:
    """The filter's bits for a key, by double hashing."""
    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & (1 << 64) - 1, h >> 64 | 1
    return [(a + i * b) % bits for i in range(BLOOM_HASHES)]


class Writer:
    """Streams entries, given in ascending order of their keys, to ``out``; holds one block."""

    def __init__(self, out, width: int = 2):
        self.out, self.width, self.at = out, width, 0
        self.block, self.last, self.first = bytearray(), b"", b""
        self.index: list[tuple[bytes, int, int]] = []
        self.hashes: list[bytes] = []
        self.entries = self.ids = 0

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, key: bytes, value: bytes) -> None:
        if self.entries and key < self.last:
            raise ValueError("keys must come in ascending order")
        shared = 0
        if self.block:
            most = min(len(key), len(self.last))
            while shared < most and key[shared] == self.last[shared]:
                shared += 1
        else:
            self.first = key
        self.block += varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:] + value
        if not self.hashes or self.last != key:
            self.hashes.append(xxhash.xxh3_128_digest(key))
        self.last = key
        self.entries += 1
        self.ids += len(value) // self.width
        if len(self.block) >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.block:
            data = bytes(self.block)
            self.index.append((self.first, self.at, len(data)))
            self.put(data + struct.pack("<I", zlib.crc32(data)))
            self.block = bytearray()

    def close(self) -> None:
        self.flush()
        index_at = self.at
        for key, at, length in self.index:
            self.put(varint(len(key)) + key + varint(at) + varint(length))
        bloom_at = self.at
        bits = max(64, BLOOM_BITS_A_KEY * len(self.hashes))
        bits = -(-bits // 8) * 8
        field = np.zeros(bits // 8, np.uint8)
        if self.hashes:
            pair = np.frombuffer(b"".join(self.hashes), ">u8").astype(np.uint64).reshape(-1, 2)
            for i in range(BLOOM_HASHES):
                with np.errstate(over="ignore"):
                    place = self._places(pair, i, bits)
                np.bitwise_or.at(field, place >> 3, (1 << (place & 7)).astype(np.uint8))
        self.put(field.tobytes())
        self.put(FOOTER.pack(index_at, bloom_at, bits, len(self.index), self.entries, self.ids, self.width, MAGIC))

    @staticmethod
    def _places(pair: np.ndarray, i: int, bits: int) -> np.ndarray:
        high, low = pair[:, 0] | np.uint64(1), pair[:, 1]
        n = np.uint64(bits)
        # (a + i * b) mod bits with every step reduced, so that nothing overflows.
        return ((low % n + np.uint64(i) * (high % n)) % n).astype(np.int64)


class Reader:
    """One shard; looks up a key or streams all entries."""

    def __init__(self, uri: str):
        files, path = file_system(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        (self.index_at, self.bloom_at, self.bits, blocks, self.entries, self.ids, self.width, magic) = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no shard of this format")
        raw = self.file.read_at(self.bloom_at - self.index_at, self.index_at)
        self.keys, self.blocks, at = [], [], 0
        for _ in range(blocks):
            n, at = read_varint(raw, at)
            self.keys.append(raw[at : at + n])
            place, at = read_varint(raw, at + n)
            length, at = read_varint(raw, at)
            self.blocks.append((place, length))
        self.size = size

    def may_have(self, key: bytes) -> bool:
        """False only if the key isn't in the shard."""
        if not hasattr(self, "bloom"):
            self.bloom = self.file.read_at(self.bits // 8, self.bloom_at)
        return all(self.bloom[p >> 3] >> (p & 7) & 1 for p in bloom_places(key, self.bits))

    def block(self, i: int) -> Iterator[tuple[bytes, bytes]]:
        place, length = self.blocks[i]
        data = self.file.read_at(length + 4, place)
        if zlib.crc32(data[:length]) != struct.unpack("<I", data[length:])[0]:
            raise ValueError(f"block {i} is damaged")
        at, key = 0, b""
        while at < length:
            shared, at = read_varint(data, at)
            rest, at = read_varint(data, at)
            n, at = read_varint(data, at)
            key = key[:shared] + data[at : at + rest]
            at += rest
            yield key, data[at : at + n]
            at += n

    def get(self, key: bytes) -> list[bytes]:
        """The values of a key."""
        if not self.keys or not self.may_have(key):
            return []
        found = []
        i = max(0, bisect_right(self.keys, key) - 1)
        while i and self.keys[i] == key:  # repeated keys may begin in an earlier block
            i -= 1
        for j in range(i, len(self.blocks)):
            if self.keys[j] > key:
                break
            found += [v for k, v in self.block(j) if k == key]
        return found

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for i in range(len(self.blocks)):
            yield from self.block(i)

    def close(self) -> None:
        self.file.close()


def write_shards(df: DataFrame, encode: Callable[[], Callable[[list[str]], list[bytes]]], end_id: int | None, folder: str | None = None, key: str = "doc_id", text: str = "text", width: int = 2, shard_chars: int = SHARD_CHARS) -> str:
    """Encodes every text and writes the ids in shards in ascending order of ``key``.

    ``encode`` gives, in a worker, a function from texts to ids as little-endian unsigned 32-bit
    integers; ``end_id`` is appended to each document (None: nothing is). ``width`` is the number
    of bytes of an id in the files (2 or 4); an id that doesn't fit is refused. Null texts are
    empty. Returns the folder, which holds the shards and ``manifest``, a Parquet table of
    (shard, path, first_key, last_key, n_docs, n_ids).
    """
    spark = df.sparkSession
    folder = folder or scratch(spark, "sst")
    chars = df.agg(F.sum(F.length(text))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // shard_chars))
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    # Ranges by key and hash: a key that many rows share is dealt over several shards.
    rows = rows.repartitionByRange(n, F.asc_nulls_first("key"), "tie").sortWithinPartitions(F.asc_nulls_first("key"), "tie", "text").select("key", "text")
    kind = np.dtype("<u2" if width == 2 else "<u4")
    ending = b"" if end_id is None else np.array([end_id], kind).tobytes()
    schema = "shard int, path string, first_key binary, last_key binary, n_docs long, n_ids long"

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, made = TaskContext.get().partitionId(), []
        path = f"{folder}/shard-{shard:06d}.sst"

        def stream(out) -> None:
            writer, encoder, ends = Writer(out, width), encode(), []
            for batch in sliced(of):
                keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for k, ids in zip(keys, encoder(texts)):
                    if width == 2:
                        wide = np.frombuffer(ids, "<u4")
                        if len(wide) and wide.max() > 0xFFFF:
                            raise ValueError("an id doesn't fit two bytes; use width=4")
                        ids = wide.astype(kind).tobytes()
                    raw = key_bytes(k)
                    ends = [ends[0] if ends else raw, raw]
                    writer.add(raw, ids + ending)
            writer.close()
            made.extend([*(ends or [None, None]), writer.entries, writer.ids])

        put_file(path, stream)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "first_key": [made[0]], "last_key": [made[1]], "n_docs": [made[2]], "n_ids": [made[3]]}, schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("first_key", pa.binary()), ("last_key", pa.binary()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    rows.mapInArrow(run, schema).write.parquet(f"{folder}/manifest")
    return folder


def read_shards(spark: SparkSession, folder: str, key_type: str = "long") -> DataFrame:
    """(key, shard, start, n_ids, ids) of every entry, from the shard files.

    ``start`` counts the ids of all entries before it; ``ids`` are little-endian unsigned 32-bit.
    The window below sees one row for each shard file, not documents.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.filter("n_docs > 0").select("shard", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    files = files.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard")
    schema = pa.schema([("key", pa.int64() if key_type == "long" else pa.string()), ("shard", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.binary())])

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in of:
            for shard, path, base in zip(*(c.to_pylist() for c in batch.columns)):
                reader, rows, start = Reader(path), [], base
                kind = np.dtype("<u2" if reader.width == 2 else "<u4")
                for raw, value in reader:
                    ids = np.frombuffer(value, kind)
                    rows.append((key_of(raw), shard, start, len(ids), ids.astype("<u4").tobytes()))
                    start += len(ids)
                    if len(rows) >= 256:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                reader.close()

    return files.mapInArrow(run, f"key {key_type}, shard int, start long, n_ids long, ids binary")


def lookup(spark: SparkSession, folder: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, ids) of the asked keys only: the manifest's ranges find shards, each shard's filter,
    index and one block find the entry. Keys that aren't there, and nulls, give no row."""
    key_type = "string" if dict(keys.dtypes)[key] == "string" else "long"
    asked = keys.select(F.col(key).cast(key_type).alias("key")).where("key is not null").distinct()
    # Bytes that sort as the keys do, as key_bytes makes them.
    raw = F.concat(F.lit(b"t"), F.encode("key", "UTF-8")) if key_type == "string" else F.concat(F.lit(b"i"), F.unhex(F.lpad(F.hex(F.col("key").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")))
    asked = asked.withColumn("raw", raw)
    # One row for each shard, which holds at least one task's share of the corpus.
    shards = spark.read.parquet(f"{folder}/manifest").filter("n_docs > 0")
    hits = asked.join(F.broadcast(shards), (asked.raw >= shards.first_key) & (asked.raw <= shards.last_key)).select("key", "raw", "path").repartition("path").sortWithinPartitions("path")
    schema = pa.schema([("key", pa.int64() if key_type == "long" else pa.string()), ("ids", pa.binary())])

    def run(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = reader = None
        for batch in of:
            for k, r, p in zip(*(c.to_pylist() for c in batch.columns)):
                if p != path:
                    path, reader = p, Reader(p)
                found = [np.frombuffer(value, "<u2" if reader.width == 2 else "<u4").astype("<u4").tobytes() for value in reader.get(r)]
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(found), schema.types[0]), pa.array(found, pa.binary())], schema=schema)

    return hits.mapInArrow(run, f"key {key_type}, ids binary")


def library_encoder(path: str, plain: bool = False) -> Callable[[], Callable[[list[str]], list[bytes]]]:
    """An ``encode`` for write_shards by a tokenizers file that every executor has.

    With ``plain`` the strings of special tokens are ordinary text, else the library's tokens.
    """
    return lambda: piece_encoder(path, plain).encode
