"""Token-id shards with a shared compression dictionary (operator 3).

Layout of a store, written by Spark so that it may lie in any store Spark writes:

    <path>/dictionary   one row: dict_id (SHA-256, hex), body (a zstandard dictionary)
    <path>/shards       part, shard, dict_id, width, n_docs, first_id, n_ids, index, frames

A shard is a few MB of documents in ascending key order.  `frames` holds one
zstandard frame a document (its ids as little-endian numbers of `width` bytes,
compressed with the dictionary), `index` an array of (offset, ids before it in the
shard) pairs of 64-bit numbers with one entry more than documents, `keys` the
documents' keys.  So one short document is read by its two index entries and one
frame.  The dictionary is trained on the serialized ids of at most `sample`
documents (those smallest by a hash of the key), a bounded number of rows of their
ids; only the compression depends on it.

Positions: a part is one range of keys.  Ids before a document are those of
earlier parts (one number a part), of earlier shards in the part, and the index.

Defined cases: null text is empty, so a document always has its end id; a null key
comes first; rows that repeat a key stand next to each other; an empty table makes
an empty store, read back as an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.llm.tokens import crc, encode
from tidewell.session import scratch

PART_BYTES = 16 << 20
SHARD_IDS = 1 << 20


def _serial(ids: np.ndarray, width: int) -> bytes:
    return ids.astype("<u2" if width == 2 else "<u4").tobytes()


def train_dictionary(docs: DataFrame, key: str, text: str, tokenizer: str, end_id: int, width: int, *, sample: int = 1000, chunk: int = 1000, size: int = 64 << 10) -> bytes:
    """A dictionary from a bounded sample: of the sampled documents' ids in rows of
    `chunk`, the 2 * sample rows smallest by hash.  Empty if that is too little."""
    keys = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("k")).distinct().orderBy(F.xxhash64("k"), "k").limit(sample)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = (np.r_[x, np.uint32(end_id)] for x in encode(tokenizer, b["t"].tolist()))
            yield pd.DataFrame({"x": [_serial(x[i:i + chunk], width) for x in ids for i in range(0, len(x), chunk)]})

    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(keys), "k").select("t")
    parts = [bytes(r["x"]) for r in rows.mapInPandas(run, "x binary").orderBy(F.xxhash64("x")).limit(2 * sample).collect()]  # bounded by sample and chunk
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", *, tokenizer: str, end_id: int, width: int = 2, level: int = 3) -> None:
    """Encode every document and write the store."""
    spark = docs.sparkSession
    body = train_dictionary(docs, key, text, tokenizer, end_id, width)
    name = hashlib.sha256(body).hexdigest()
    spark.createDataFrame([(name, body)], "dict_id string, body binary").write.parquet(f"{path}/dictionary")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(1, math.ceil(size / PART_BYTES))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(body) if body else None
        if shared:
            shared.precompute_compress(level=level)  # else every frame would read the dictionary anew
        coder = zstandard.ZstdCompressor(level=level, dict_data=shared, write_content_size=True, write_checksum=False)
        part, shard, first = TaskContext.get().partitionId(), 0, 0
        keys, frames, index, ids = [], [], [(0, 0)], 0
        for b in batches:
            for k, x in zip(b.column("k"), encode(tokenizer, b.column("t").to_pylist()), strict=True):
                if len(x) and int(x.max()) >> (8 * width):
                    raise ValueError("ids do not fit the width")
                frame = coder.compress(_serial(np.r_[x, np.uint32(end_id)], width))
                keys.append(k.as_py())
                frames.append(frame)
                ids += len(x) + 1
                index.append((index[-1][0] + len(frame), ids))
                if ids >= SHARD_IDS:
                    yield _shard(part, shard, name, width, first, keys, index, frames, b.column("k").type)
                    shard, first = shard + 1, first + ids
                    keys, frames, index, ids = [], [], [(0, 0)], 0
        if keys:
            yield _shard(part, shard, name, width, first, keys, index, frames, b.column("k").type)

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    placed = rows.repartitionByRange(parts, F.col("k").asc_nulls_first()).sortWithinPartitions(F.col("k").asc_nulls_first(), F.xxhash64("t"))
    schema = f"part int, shard int, dict_id string, width int, n_docs long, first_id long, n_ids long, keys array<{kind}>, index binary, frames binary"
    # frames are compressed already
    placed.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{path}/shards")


def _shard(part: int, shard: int, name: str, width: int, first: int, keys: list, index: list, frames: list, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([name]), pa.array([width], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([first], pa.int64()),
         pa.array([index[-1][1]], pa.int64()), pa.array([keys], pa.list_(kind)), pa.array([np.array(index, "<i8").tobytes()], pa.binary()), pa.array([b"".join(frames)], pa.binary())],
        names=["part", "shard", "dict_id", "width", "n_docs", "first_id", "n_ids", "keys", "index", "frames"])


def dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(bytes(row["body"])).hexdigest() != row["dict_id"]:
        raise ValueError("the dictionary differs from its hash")
    return row["dict_id"], bytes(row["body"])


def _decoder(body: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body)) if body else zstandard.ZstdDecompressor()


def _frame(frames: bytes, index: np.ndarray, i: int, coder: zstandard.ZstdDecompressor, width: int) -> np.ndarray:
    return np.frombuffer(coder.decompress(frames[index[i, 0]:index[i + 1, 0]]), "<u2" if width == 2 else "<u4")


def read(spark: SparkSession, path: str, key: str = "doc_id", *, with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document in the store, and its ids if asked for."""
    name, body = dictionary(spark, path)
    shards = spark.read.parquet(f"{path}/shards")
    totals = {r["part"]: r["n"] for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}  # one number a part
    before, base = 0, {}
    for p in sorted(totals):
        base[p] = before
        before += totals[p]
    kind = shards.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _decoder(body)
        for b in batches:
            for i in range(b.num_rows):
                if b.column("dict_id")[i].as_py() != name:
                    raise ValueError("a shard was written with another dictionary")
                index = np.frombuffer(b.column("index")[i].as_py(), "<i8").reshape(-1, 2)
                frames, width = b.column("frames")[i].as_py(), b.column("width")[i].as_py()
                docs = [_frame(frames, index, j, coder, width) for j in range(len(index) - 1)]
                start = base[b.column("part")[i].as_py()] + b.column("first_id")[i].as_py() + index[:-1, 1]
                cols = [b.column("keys")[i].values, pa.array(start, pa.int64()), pa.array([len(x) for x in docs], pa.int64()), pa.array([crc(x) for x in docs], pa.int64())]
                names = ["k", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([x.astype(np.int32) for x in docs], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    out = shards.select("part", "dict_id", "width", "first_id", "keys", "index", "frames").mapInArrow(run, f"k {kind}, start long, n_tokens long, ids_crc32 long{', ids array<int>' if with_ids else ''}")
    return out.withColumnRenamed("k", key)


def read_document(spark: SparkSession, path: str, value) -> list[np.ndarray]:
    """Ids of the documents with one key: only their shards and frames are read."""
    _, body = dictionary(spark, path)
    coder, out = _decoder(body), []
    for r in spark.read.parquet(f"{path}/shards").filter(F.array_contains("keys", F.lit(value))).orderBy("part", "shard").collect():
        index = np.frombuffer(bytes(r["index"]), "<i8").reshape(-1, 2)
        out += [_frame(bytes(r["frames"]), index, j, coder, r["width"]) for j, k in enumerate(r["keys"]) if k == value]
    return out


def store_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", *, tokenizer: str, end_id: int) -> DataFrame:
    """Write a store into the shared folder and read it back."""
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    write(docs, path, key, text, tokenizer=tokenizer, end_id=end_id)
    return read(spark, path, key)
