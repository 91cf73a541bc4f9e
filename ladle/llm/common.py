"""Shared helpers: tables, shared work folder, text blocks, word hashes and block exchanges.

A *block* is a bounded run of documents that one Python call holds in memory. Two exchanges between blocks use the
same shape: every block sends, per hash bucket, its sorted distinct keys (with what it knows of them) as packed
columns; a bucket answers each block in the order of the keys that it sent. A hot key costs one entry per block,
however often it occurs in it, and the answers need no positions.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - makes pa.compute available
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: UTF-8 bytes of text that one Python call handles at once (a longer document is a block of its own).
BLOCK_BYTES = 4 << 20

_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_WORD_CHUNK = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors see. A local session without it gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        root = tempfile.mkdtemp(prefix="ladle-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root}/ladle-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts lineage, and survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined_hot(rows: DataFrame, table: DataFrame, key: str, many: str) -> DataFrame:
    """Inner join of rows with a stored table that holds each key once and, as `many`, the number of its rows (left out
    of the result).

    A key with more than 1 / (4 n) of all counted rows, for n shuffle partitions, is hot. There are fewer than 4 n such
    keys, whatever the data: they are broadcast, and their rows stay where they are. All other rows are shuffled by key.
    """
    n = partitions(rows.sparkSession)
    total = table.agg(F.sum(many)).first()[0] or 0
    hot = F.col(many) * (4 * n) > total
    heads = F.broadcast(table.filter(hot).drop(many))
    usual = rows.join(heads.select(key), key, "left_anti").join(table.filter(~hot).drop(many), key)
    return rows.join(heads, key).unionByName(usual)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(name: str, *taken: list[str]) -> str:
    """The name, with underscores added until no column has it (Spark ignores case)."""
    used = {c.lower() for columns in taken for c in columns}
    while name.lower() in used:
        name += "_"
    return name


def dealt(n: int, *columns: str) -> Column:
    """Block number of a row, from its content and the partition that it was read in: equal rows spread, too."""
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), F.lit(n)).cast("int")


def crc(column: str | Column) -> Column:
    """crc32 of a column as text; null stays null."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"))


def text_blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold at most limit bytes of text each, or one document."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if not len(column):
            continue
        ends = np.cumsum(np.asarray(pa.compute.binary_length(column.fill_null("")), dtype=np.int64))
        at = 0
        while at < len(ends):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def texts_of(batch: pa.RecordBatch | pa.Table, text: str = "text") -> list[str]:
    return [t or "" for t in batch.column(text).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of the texts of a block: 64-bit hashes, document ordinals and byte spans."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, lower: bool = False):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
            if isinstance(column, pa.ChunkedArray):
                column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
        column = column.fill_null("").cast(pa.large_string())
        self.docs = len(column)
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=column.offset + self.docs + 1)[column.offset:] \
            if self.docs else np.zeros(1, np.int64)
        body = column.buffers()[2] if self.docs else None
        data = np.frombuffer(body, dtype=np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        self.data = data
        gap = (data == 32) | ((data >= 9) & (data <= 13))
        first = np.zeros(len(data) + 1, dtype=bool)
        first[offsets] = True
        inside = ~gap
        before = np.ones(len(data), dtype=bool)
        before[1:] = gap[:-1]
        after = np.ones(len(data), dtype=bool)
        after[:-1] = gap[1:]
        self.start = np.flatnonzero(inside & (before | first[:-1]))
        self.end = np.flatnonzero(inside & (after | first[1:])) + 1
        self.offsets = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(self.docs, dtype=np.int32), np.diff(self.offsets))
        self.hash = self._hashes(lower)

    def _hashes(self, lower: bool) -> np.ndarray:
        out = np.empty(len(self.start), dtype=np.uint64)
        at = 0
        while at < len(out):
            base = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, base + _WORD_CHUNK, "right")))
            part = self.data[base:self.end[to - 1]]
            n = max(_WORD_CHUNK, 1 << int(len(part) - 1).bit_length())
            x = part.astype(np.uint64)
            if lower:
                x[(part >= 65) & (part <= 90)] += np.uint64(32)
            x += np.uint64(1)
            x *= _powers(_P, n)[:len(part)]
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(x, out=sums[1:])
            s, e = self.start[at:to] - base, self.end[at:to] - base
            out[at:to] = (sums[e] - sums[s]) * _powers(_P_INVERSE, n)[s]
            at = to
        return mix(out)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Order-sensitive hashes of all runs of k neighbouring word hashes (not mixed yet)."""
    if len(words) < k:
        return np.zeros(0, dtype=np.uint64)
    out, done, run, size = None, 0, words, 1
    while True:
        if k & size:
            if out is None:
                out = run
            else:
                n = len(words) - done - size + 1
                out = out[:n] + run[done:done + n] * np.uint64(pow(_P, done, 1 << 64))
            done += size
        if done == k:
            return out
        run = run[:len(run) - size] + run[size:] * np.uint64(pow(_P, size, 1 << 64))
        size *= 2


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in ascending 64-bit keys; bucket = upper 32 bits * buckets >> 32."""
    upper = (keys >> np.uint64(32)).astype(np.int64)
    return np.searchsorted((upper * buckets) >> 32, np.arange(buckets + 1))


def asked(block: int, keys: np.ndarray, columns: list[np.ndarray], buckets: int) -> list[dict]:
    """Rows (bucket, block, keys, columns...) for ascending keys; empty buckets send nothing."""
    bounds = bucket_bounds(keys, buckets)
    return [{"bucket": b, "block": block, "keys": keys[i:j].tobytes(), **{f"c{n}": c[i:j].tobytes() for n, c in enumerate(columns)}}
            for b, (i, j) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)) if i < j]


def ask_schema(columns: int) -> str:
    return "bucket int, block int, keys binary" + "".join(f", c{n} binary" for n in range(columns))


def rows_table(rows: list[dict], schema: str | pa.Schema) -> pa.Table:
    if isinstance(schema, str):
        schema = arrow_schema(schema)
    return pa.Table.from_pylist(rows, schema=schema)


@lru_cache(maxsize=32)
def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64(),
             "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (f.strip().split(" ") for f in ddl.split(","))])


def gathered(table: pa.Table, kinds: dict[str, type]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The block of each row, its packed columns put together, and the bounds of the rows in them."""
    blocks = np.asarray(table.column("block"))
    first = next(iter(kinds))
    sizes = [len(x) // np.dtype(kinds[first]).itemsize for x in table.column(first).to_pylist()]
    columns = [np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind) for name, kind in kinds.items()]
    return blocks, columns, np.concatenate([[0], np.cumsum(sizes)])


def answered(table: pa.Table, kind: type) -> np.ndarray:
    """A block's answers in the order of the keys that it sent."""
    order = np.argsort(np.asarray(table.column("bucket")), kind="stable")
    parts = table.column("answer").to_pylist()
    return np.frombuffer(b"".join(parts[i] for i in order), dtype=kind)


def runs_of(sorted_keys: np.ndarray) -> np.ndarray:
    """First positions of the runs of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
