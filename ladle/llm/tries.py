"""A prefix trie over conversations, from padded matrices of turn ids.

Conversations with one sequence of turns become a class. Classes are range-partitioned by their first turns into
shards; inside one, turn ids are codes in a padded matrix, sorted by NumPy, and OR-accumulated column changes say how
many turns a row shares with the one before it. With that, every node of a depth is a run of rows, and sums over runs
give its members and its subtree. Only the paths of a shard's first and last class can go on in another shard: their
nodes carry keys and are put together by Spark, with a correction for what two neighbours count twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import crc, partitions, stored

_WORD = r"[^\x20\x09-\x0D]+"
#: Columns of one padded matrix; rows that still agree after it go on in the next.
BAND = 32
#: Turns by which classes are dealt to shards. Classes that agree in all of them stay in one shard.
RANGE_TURNS = 64
_NO_ID = np.iinfo(np.int64).max
_ID = 16


# -- sequences ----------------------------------------------------------------
def sequences(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, seq): each conversation's turns as array<struct<id, words>>, in order.

    Order: turn (null first), then role, the first 32 characters of text, and the id. A null role or text is empty. id is
    the MD5 of role and text, words counts the text's words. A null conv_id is one conversation.
    """
    empty = F.lit("")
    r, t = F.coalesce(F.col(role), empty), F.coalesce(F.col(text), empty)
    item = F.struct(
        F.col(turn).isNotNull().alias("given"), F.col(turn).alias("turn"), r.alias("role"), F.left(t, F.lit(32)).alias("lead"),
        F.md5(F.concat(F.length(r).cast("string"), F.lit(":"), r, t)).alias("id"), F.regexp_count(t, F.lit(_WORD)).cast("int").alias("words"))
    return (rows.select(F.col(conv).alias("conv_id"), item.alias("item")).groupBy("conv_id")
            .agg(F.array_sort(F.collect_list("item")).alias("items"))
            .select("conv_id", F.transform("items", lambda x: F.struct(x["id"].alias("id"), x["words"].alias("words"))).alias("seq")))


def with_shared_heads(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """(conv_id, seq) rebuilt: the first h turns of conversation c - c % every, then c's own after its first h.

    h = crc32(c) % most. Without that conversation only c's own turns after the first h remain; a null id keeps its own.
    """
    c = F.col("conv_id")
    h = F.coalesce(crc("conv_id") % most, F.lit(0)).cast("int")
    heads = convs.filter(c % every == 0).select(c.alias("base"), F.slice("seq", 1, most - 1).alias("head"))
    own = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq"), F.lit(1)))
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.slice("seq", F.lit(1), F.lit(0)))
    return (convs.withColumn("h", h).withColumn("from", c - c % every)
            .join(heads, F.col("from") == F.col("base"), "left").select("conv_id", F.concat(head, own).alias("seq")))


# -- classes ------------------------------------------------------------------
_ENDS_DDL = "k binary, part int, ids binary, ends string"
_ENDS = pa.schema([("k", pa.binary()), ("part", pa.int32()), ("ids", pa.binary()), ("ends", pa.string())])


def _part() -> int:
    return TaskContext.get().partitionId() if TaskContext.get() else 0


def _id_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of each class as text, from sorted (k, conv_id); a class inside the partition is hashed at once."""
    part, key, ids, out, first = _part(), None, [], [], True

    def row(last: bool) -> dict:
        joined = b",".join(b"%d" % i for i in ids if i is not None)
        done = not first and not last
        return {"k": key, "part": part, "ids": None if done else joined, "ends": hashlib.sha256(joined).hexdigest() if done else None}

    for batch in batches:
        for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    out.append(row(False))
                    first = False
                key, ids = k, []
            ids.append(conv)
        if len(out) >= 5000:
            yield pa.RecordBatch.from_pylist(out, schema=_ENDS)
            out = []
    if key is not None:
        out.append(row(True))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_ENDS)


def _id_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one class hashed one after the other; only the hash's state is held."""
    key, sha, begun, out = None, None, False, []
    for batch in batches:
        for k, ids, ends in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("k", "ids", "ends")), strict=True):
            if k != key:
                if key is not None:
                    out.append({"k": key, "ends": sha if isinstance(sha, str) else sha.hexdigest()})
                key, sha, begun = k, ends or hashlib.sha256(), False
            if ids:
                sha.update((b"," if begun else b"") + ids)
                begun = True
    if key is not None:
        out.append({"k": key, "ends": sha if isinstance(sha, str) else sha.hexdigest()})
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("k", pa.binary()), ("ends", pa.string())]))


def classes(convs: DataFrame) -> DataFrame:
    """(k, packed, words, n, least, ends): one row per distinct sequence, with its members' count, least id and hash.

    A class that a third of all conversations share is counted before the shuffle; its ids are dealt by range.
    """
    n = partitions(convs.sparkSession)
    packed = F.unhex(F.array_join(F.transform("seq", lambda x: x["id"]), ""))
    rows = stored(convs.select("conv_id", packed.alias("packed"), F.transform("seq", lambda x: x["words"]).alias("words"))
                  .withColumn("k", F.unhex(F.md5("packed"))))
    found = rows.groupBy("k").agg(F.first("packed").alias("packed"), F.first("words").alias("words"), F.count("*").alias("n"),
                                  F.min("conv_id").alias("least"))
    runs = rows.select("k", "conv_id").repartitionByRange(n, "k", "conv_id").sortWithinPartitions("k", "conv_id").mapInArrow(_id_runs, _ENDS_DDL)
    ends = runs.repartition(n, "k").sortWithinPartitions("k", "part").mapInArrow(_id_hashes, "k binary, ends string")
    return found.join(ends, "k")


# -- shards -------------------------------------------------------------------
def _codes(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Turn ids as codes from 1 that keep their byte order, and where each row's begin."""
    size = np.array([len(p) // _ID for p in packed], dtype=np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    halves = np.frombuffer(b"".join(packed), dtype=">u8").reshape(-1, 2).astype(np.uint64)
    if not len(halves):
        return np.zeros(0, dtype=np.int64), at
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (halves[order[1:]] != halves[order[:-1]]).any(axis=1)
    codes = np.empty(len(order), dtype=np.int64)
    codes[order] = np.cumsum(new)
    return codes, at


def sorted_rows(packed: list[bytes], band: int = BAND) -> tuple[np.ndarray, np.ndarray]:
    """Order of different sequences, and how many turns each shares with the one before it."""
    codes, at = _codes(packed)
    size = np.diff(at)
    order, lcp = np.arange(len(packed)), np.zeros(len(packed), dtype=np.int64)
    places, group, begin = np.arange(len(packed)), np.zeros(len(packed), dtype=np.int64), 0
    while len(places):
        rows = order[places]
        padded = np.zeros((len(rows), band), dtype=np.int64)
        for j in range(band):  # 0 where a row has ended: shorter rows come first
            there = size[rows] > begin + j
            padded[there, j] = codes[at[rows[there]] + begin + j]
        by = np.lexsort((*padded.T[::-1], group))
        order[places] = rows[by]
        padded, group = padded[by], group[by]
        changed = np.logical_or.accumulate(padded[1:] != padded[:-1], axis=1)
        together = group[1:] == group[:-1]
        lcp[places[1:][together]] = begin + (~changed[together]).sum(axis=1)
        tied = together & ~changed[:, -1]  # different rows that agree so far
        left = np.zeros(len(places), dtype=bool)
        left[1:] |= tied
        left[:-1] |= tied
        group = np.concatenate([[0], np.cumsum(~tied)])[left]
        places, begin = places[left], begin + band
    return order, lcp


def path_keys(packed: bytes, depth: int) -> list[bytes]:
    """Keys of the nodes on a path, the root's first."""
    out = [bytes(_ID)]
    for d in range(depth):
        out.append(hashlib.md5(out[-1] + packed[d * _ID:(d + 1) * _ID]).digest())
    return out


_NODE = pa.schema([
    *[(c, pa.int64()) for c in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
    ("ends", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()), ("shard", pa.int32()), ("first", pa.binary()),
    ("first_words", pa.list_(pa.int32())), ("last", pa.binary())])
_NODE_DDL = ("depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
             "ends string, key binary, parent_key binary, shard int, first binary, first_words array<int>, last binary")


def _table(columns: dict, rows: int) -> pa.RecordBatch:
    arrays = [columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in _NODE]
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, _NODE, strict=True)],
                                      schema=_NODE)


def _ids(values: np.ndarray, known: np.ndarray | None = None) -> pa.Array:
    missing = values == _NO_ID
    return pa.array(values, pa.int64(), mask=missing if known is None else missing | ~known)


def shard_nodes(table: pa.Table, shard: int, band: int = BAND) -> Iterator[pa.RecordBatch]:
    """All nodes of one shard's classes (packed, words, n, least, ends), and one row with its first and last class.

    A node on the path of the first or last class has a key and holds this shard's part only; a child of such a node
    names its parent by key.
    """
    packed = table.column("packed").to_pylist()
    rows = len(packed)
    order, lcp = sorted_rows(packed, band)
    packed = [packed[i] for i in order]
    table = table.take(pa.array(order))
    size = np.array([len(p) // _ID for p in packed], dtype=np.int64)
    lists = table.column("words").combine_chunks() if isinstance(table.column("words"), pa.ChunkedArray) else table.column("words")
    words = np.asarray(lists.flatten(), dtype=np.int64)
    sums, at = np.concatenate([[0], np.cumsum(words)]), np.concatenate([[0], np.cumsum(size)])
    n = np.asarray(table.column("n"), dtype=np.int64)
    least = np.asarray(table.column("least").fill_null(_NO_ID), dtype=np.int64)
    ends = table.column("ends").combine_chunks()
    following = np.append(lcp[1:], 0)
    total = sums[at[1:]] - sums[at[:-1]]
    fresh = total - (sums[at[:-1] + lcp] - sums[at[:-1]])  # words of nodes that no row before has
    leaf = (following < size).astype(np.int64)
    leaf[-1] = 1  # the next shard may know better
    shared = np.maximum(lcp, following)
    last = rows - 1
    first_keys, last_keys = path_keys(packed[0], int(size[0])), path_keys(packed[last], int(size[last]))

    def upto(row: np.ndarray, depth: int | np.ndarray) -> np.ndarray:
        """Words of a row's turns above that depth; none above the first."""
        return sums[at[row] + np.maximum(depth - 1, 0)] - sums[at[row]]

    above = np.full(rows, _NO_ID, dtype=np.int64)  # least member of the deepest node so far
    open_ = np.zeros(rows, dtype=np.int8)  # whether that node has a key: 1 on the first path, 2 on the last

    def keys(which: np.ndarray, depth: np.ndarray) -> list:
        return [(first_keys if w == 1 else last_keys)[d] if w else None for w, d in zip(which.tolist(), depth.tolist(), strict=True)]

    active, depth = np.arange(rows), 0
    while len(active):
        starts = np.flatnonzero((lcp[active] < depth) | (active == 0)) if depth else np.zeros(1, dtype=np.int64)
        heads, tails = active[starts], active[np.append(starts[1:], len(active)) - 1]
        members = np.add.reduceat(n[active], starts)
        smallest = np.minimum.reduceat(least[active], starts)
        before = upto(heads, depth)
        every = np.add.reduceat((n * total)[active], starts) - members * before
        once = np.add.reduceat(fresh[active], starts) - fresh[heads] + total[heads] - before
        children = np.add.reduceat(((lcp[active] <= depth) & (size[active] > depth)).astype(np.int64), starts)
        which = np.where(heads == 0, 1, np.where(tails == last, 2, 0)).astype(np.int8)
        up = open_[heads]
        yield _table({
            "depth": np.full(len(heads), depth), "conv_id": _ids(smallest), "parent_conv_id": _ids(above[heads], up == 0),
            "n_convs": members, "n_children": children, "n_leaves": np.add.reduceat(leaf[active], starts), "saved_tokens": every - once,
            "ends": ends.take(pa.array(heads, mask=size[heads] != depth)), "key": pa.array(keys(which, np.full(len(heads), depth)), pa.binary()),
            "parent_key": pa.array(keys(up, np.full(len(heads), depth - 1)), pa.binary())}, len(heads))
        lengths = np.diff(np.append(starts, len(active)))
        above[active], open_[active] = np.repeat(smallest, lengths), np.repeat(which, lengths)
        depth += 1
        active = active[shared[active] >= depth]
    for low in range(0, rows, 4096):  # what is left of each row is a path of its own
        part = np.arange(low, min(low + 4096, rows))
        tail = size[part] - shared[part]
        row = np.repeat(part, tail)
        if not len(row):
            continue
        d = np.arange(len(row)) - np.repeat(np.cumsum(tail) - tail, tail) + shared[row] + 1
        begins = d == shared[row] + 1
        which = np.where(row == 0, 1, np.where(row == last, 2, 0)).astype(np.int8)
        up = np.where(begins, open_[row], which).astype(np.int8)
        yield _table({
            "depth": d, "conv_id": _ids(least[row]), "parent_conv_id": _ids(np.where(begins, above[row], least[row]), up == 0),
            "n_convs": n[row], "n_children": (d < size[row]).astype(np.int64), "n_leaves": np.ones(len(row), dtype=np.int64),
            "saved_tokens": (n[row] - 1) * (total[row] - upto(row, d)), "ends": ends.take(pa.array(row, mask=d != size[row])),
            "key": pa.array(keys(which, d), pa.binary()), "parent_key": pa.array(keys(up, d - 1), pa.binary())}, len(row))
    yield _table({"shard": pa.array([shard], pa.int32()), "first": pa.array([packed[0]], pa.binary()), "last": pa.array([packed[last]], pa.binary()),
                  "first_words": pa.array([words[at[0]:at[1]].tolist()], pa.list_(pa.int32()))}, 1)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = [b for b in batches if b.num_rows]
    if found:
        yield from shard_nodes(pa.Table.from_batches(found), _part())


def shared_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // _ID
    x, y = (np.frombuffer(v[:n * _ID], dtype=np.uint64).reshape(-1, 2) for v in (a, b))
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if len(differ) else n


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What two neighbouring shards both count of the path that they share, per node of it."""
    for batch in batches:
        for last, first, words in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("last", "first", "first_words")), strict=True):
            common = shared_turns(last, first)
            sums = np.concatenate([[0], np.cumsum(np.array(words[:common], dtype=np.int64))])
            depth = np.arange(common + 1)
            yield _table({
                "key": pa.array(path_keys(first, common), pa.binary()), "n_convs": np.zeros(common + 1, dtype=np.int64),
                "n_children": -(depth < common).astype(np.int64),
                "n_leaves": np.full(common + 1, -1 if common * _ID == len(last) else 0), "saved_tokens": sums[common] - sums[np.maximum(depth - 1, 0)],
            }, common + 1)


_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row per node of the trie over (conv_id, seq): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    conv_id is a node's least member (null if all its members have a null id; null ids are left out of ends_sha256, too).
    Empty sequences end at the root. An empty table has no nodes, not even a root.
    """
    n = partitions(convs.sparkSession)
    found = stored(classes(convs).repartitionByRange(n, F.substring("packed", 1, _ID * RANGE_TURNS)).mapInArrow(_shards, _NODE_DDL))
    edges = found.filter("shard is not null")
    nexts = edges.select("shard", F.lead("shard").over(Window.orderBy("shard")).alias("next"))  # a row per shard
    pairs = (edges.select("shard", "last").join(nexts, "shard")
             .join(edges.select(F.col("shard").alias("next"), "first", "first_words"), "next"))
    nodes = found.filter("shard is null")
    parts = nodes.filter("key is not null").unionByName(pairs.mapInArrow(_corrections, _NODE_DDL))
    joined = parts.groupBy("key").agg(F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("ends").alias("ends"),
                                      F.max("parent_key").alias("parent_key"), *[F.sum(c).alias(c) for c in _SUMS])
    kept = ["conv_id", "depth", "parent_conv_id", *_SUMS, "ends"]
    parents = joined.select(F.col("key").alias("of"), F.col("conv_id").alias("parent_conv_id"))

    def hung(rows: DataFrame) -> DataFrame:
        return rows.drop("parent_conv_id").join(parents, F.col("parent_key") == F.col("of"), "left").select(*kept)

    alone = nodes.filter("key is null")
    return (alone.filter("parent_key is null").select(*kept)
            .unionByName(hung(alone.filter("parent_key is not null"))).unionByName(hung(joined))
            .select(*kept[:-1], F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
