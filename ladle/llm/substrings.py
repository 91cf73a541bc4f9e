"""Removal of repeated word spans by compacting a de Bruijn graph of the corpus.

Nodes are seeds: runs of SEED words whose hash is the least of a window's seeds. Every window of WINDOW words has one,
and equal windows have it at the same place. Edges lead from a seed to the next one of the document; as two neighbours
overlap or touch, an edge fixes all words between them. A seed that occurs once ends every path, so only repeated
seeds remain. An edge is part of a path if no document leaves its first seed or enters its second one in another way
(the ends of a document count as ways). All documents that touch such a path run through the whole of it, so one
occurrence of the path stands for all windows inside it. Windows that lie across the ends of paths stand for themselves.
The first source coordinate (document, start) of each path and window decides what is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.bpe import ragged
from ladle.llm.common import (
    _P, _P_INVERSE, Words, _powers, answered, ask_schema, asked, dealt, gathered, grams, mix, partitions, rows_table, runs_of,
)

SEED = 11
_MANY = np.uint64(1)
_REPEATED, _ONE_BEFORE, _ONE_AFTER = 1, 2, 4
_ANSWER = "bucket int, block int, answer binary"
_NO_ID = np.iinfo(np.int64).max


@dataclass
class Walk:
    """The seeds of a block's documents in order, and each window's seed."""

    words: Words
    windows: np.ndarray  # first words of the windows
    seed_of: np.ndarray  # of each window, as an index into seeds
    seeds: np.ndarray  # word positions
    keys: np.ndarray  # hash of each seed
    linked: np.ndarray  # whether seed i + 1 is in the same document as seed i
    distinct: np.ndarray
    entry: np.ndarray  # of each seed in distinct


def walk_of(column: pa.ChunkedArray, window: int) -> Walk:
    words = Words(column)
    n, width = len(words.hash), window - SEED + 1
    count = max(0, n - window + 1)
    windows = np.flatnonzero(words.doc[:count] == words.doc[window - 1:window - 1 + count])
    g = mix(grams(words.hash, SEED))
    least = g[windows]
    for j in range(1, width):
        np.minimum(least, g[windows + j], out=least)
    place = windows + width - 1
    for j in range(width - 2, -1, -1):
        place = np.where(g[windows + j] == least, windows + j, place)
    seeds, seed_of = np.unique(place, return_inverse=True)
    keys = mix(g[seeds])  # the least hashes are small: mixed again, they fill all buckets
    doc = words.doc[seeds]
    distinct, entry = np.unique(keys, return_inverse=True)
    return Walk(words, windows, seed_of, seeds, keys, doc[1:] == doc[:-1], distinct, entry)


def _ways(walk: Walk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per distinct seed: the way into it, the way out of it (0: an end of a document, 1: several), and if it repeats."""
    step = mix(np.diff(walk.seeds).astype(np.uint64)) if len(walk.seeds) > 1 else np.zeros(0, np.uint64)
    into, out = np.zeros(len(walk.seeds), np.uint64), np.zeros(len(walk.seeds), np.uint64)
    if len(step):
        into[1:] = np.where(walk.linked, mix(walk.keys[:-1] + step), 0)
        out[:-1] = np.where(walk.linked, mix(walk.keys[1:] + step), 0)
    order = np.argsort(walk.entry, kind="stable")
    first = runs_of(walk.entry[order])
    one = []
    for way in (into, out):
        if not len(first):
            one.append(np.zeros(0, np.uint64))
            continue
        low, high = np.minimum.reduceat(way[order], first), np.maximum.reduceat(way[order], first)
        one.append(np.where(low == high, low, _MANY))
    return one[0], one[1], np.bincount(walk.entry, minlength=len(walk.distinct)) > 1


def _judge_seeds(table: pa.Table) -> pa.Table:
    """For a bucket of seeds: which repeat, and which have one way in or out."""
    blocks, (keys, into, out, more), bounds = gathered(table, {"keys": np.uint64, "c0": np.uint64, "c1": np.uint64, "c2": np.uint8})
    order = np.argsort(keys, kind="stable")
    first = runs_of(keys[order])
    size = np.diff(np.append(first, len(keys)))
    flags = np.where((size > 1) | (np.maximum.reduceat(more[order], first) > 0), _REPEATED, 0)
    for way, flag in ((into, _ONE_BEFORE), (out, _ONE_AFTER)):
        low, high = np.minimum.reduceat(way[order], first), np.maximum.reduceat(way[order], first)
        flags += np.where((low == high) & (low != _MANY), flag, 0)
    answer = np.empty(len(keys), dtype=np.uint8)
    answer[order] = np.repeat(flags, size)
    return _answers(table, blocks, answer, bounds)


def _answers(table: pa.Table, blocks: np.ndarray, answer: np.ndarray, bounds: np.ndarray) -> pa.Table:
    bucket = table.column("bucket")[0].as_py()
    return rows_table([{"bucket": bucket, "block": int(b), "answer": answer[i:j].tobytes()}
                       for b, i, j in zip(blocks, bounds[:-1], bounds[1:], strict=True)], _ANSWER)


@dataclass
class Spans:
    """Paths and lone windows of a block, with their first occurrence in it."""

    start: np.ndarray  # word position in the block
    length: np.ndarray
    keys: np.ndarray  # distinct, ascending
    entry: np.ndarray  # of each span in keys
    first_doc: np.ndarray  # per key
    first_start: np.ndarray
    at_first: np.ndarray  # whether a span stands at its key's first coordinate


def spans_of(walk: Walk, flags: np.ndarray, doc_ids: np.ndarray, window: int) -> Spans:
    """flags: the bucket's word on each distinct seed."""
    flag = flags[walk.entry]
    repeated = (flag & _REPEATED) > 0
    joined = np.zeros(len(walk.seeds), dtype=bool)  # to the seed before
    if len(walk.seeds) > 1:
        joined[1:] = walk.linked & repeated[1:] & repeated[:-1] & ((flag[:-1] & _ONE_AFTER) > 0) & ((flag[1:] & _ONE_BEFORE) > 0)
    heads = np.flatnonzero(~joined)
    path = np.cumsum(~joined) - 1
    tails = np.append(heads[1:], len(walk.seeds)) - 1
    begin, end = walk.seeds[heads], walk.seeds[tails] + SEED
    long_ = repeated[heads] & (end - begin >= window)
    # windows of repeated seeds that don't lie inside their path
    of = path[walk.seed_of]
    lone = walk.windows[repeated[walk.seed_of] & ((walk.windows < begin[of]) | (walk.windows + window > end[of]))]
    h = walk.words.hash
    n = max(1 << 16, 1 << int(len(h)).bit_length())
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * _powers(_P, n)[:len(h)], out=sums[1:])
    start = np.concatenate([begin[long_], lone])
    length = np.concatenate([(end - begin)[long_], np.full(len(lone), window)])
    keys = mix((sums[start + length] - sums[start]) * _powers(_P_INVERSE, n)[start] + mix(length.astype(np.uint64)))
    doc = doc_ids[walk.words.doc[start]]
    place = start - walk.words.offsets[walk.words.doc[start]]
    order = np.lexsort((place, doc, keys))
    first = runs_of(keys[order])
    entry = np.empty(len(keys), dtype=np.int64)
    entry[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    lead = order[first]
    return Spans(start, length, keys[lead], entry, doc[lead], place[lead], (doc == doc[lead][entry]) & (place == place[lead][entry]))


def _judge_spans(table: pa.Table) -> pa.Table:
    """For a bucket of spans: which block holds the first coordinate of each."""
    blocks, (keys, doc, place), bounds = gathered(table, {"keys": np.uint64, "c0": np.int64, "c1": np.int64})
    order = np.lexsort((place, doc, keys))
    first = runs_of(keys[order])
    lead = np.repeat(order[first], np.diff(np.append(first, len(keys))))
    answer = np.empty(len(keys), dtype=np.uint8)
    answer[order] = (doc[order] == doc[lead]) & (place[order] == place[lead])
    return _answers(table, blocks, answer, bounds)


def _ids(table: pa.Table) -> np.ndarray:
    return np.asarray(table.column("doc_id").fill_null(_NO_ID), dtype=np.int64)


def remove_repeats(docs: DataFrame, window: int = 20, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_text of every row: words covered by a window of `window` words whose
    sequence also starts earlier (smaller doc_id, or earlier in the document) are removed, the rest joined by spaces.

    window: at least 12. Documents are dealt into hash blocks, twice as many as shuffle partitions, which each hold
    their share of the text; the shuffle of texts is one exchange that all three passes read. Seeds and spans travel as
    packed hashes, one entry per distinct key and block, so a span that a third of all rows holds costs a few entries.
    Windows are judged on the input. Rows of one doc_id count as one document: equal starts in them are no repeats.
    A null doc_id comes after all others. Null, empty and short texts keep all their words; further columns are left
    behind. Hashes have 64 bits.
    """
    if window <= SEED:
        raise ValueError("the window must be longer than a seed")
    n = partitions(docs.sparkSession)
    blocked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"),
                          dealt(2 * n, "doc_id", text).alias("block"))

    def send_seeds(table: pa.Table) -> pa.Table:
        walk = walk_of(table.column("text"), window)
        into, out, more = _ways(walk)
        return rows_table(asked(table.column("block")[0].as_py(), walk.distinct, [into, out, more.astype(np.uint8)], n), ask_schema(3))

    def send_spans(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows or not replies.num_rows:
            return rows_table([], ask_schema(2))
        walk = walk_of(table.column("text"), window)
        spans = spans_of(walk, answered(replies, np.uint8), _ids(table), window)
        return rows_table(asked(table.column("block")[0].as_py(), spans.keys, [spans.first_doc, spans.first_start.astype(np.int64)], n), ask_schema(2))

    def close(table: pa.Table, replies: pa.Table) -> pa.Table:
        step = np.asarray(replies.column("step"))
        walk = walk_of(table.column("text"), window)
        words = walk.words
        gone = np.zeros(len(words.hash) + 1, dtype=np.int64)
        if (step == 0).any():
            spans = spans_of(walk, answered(replies.filter(pa.array(step == 0)), np.uint8), _ids(table), window)
            if (step == 1).any():
                first = answered(replies.filter(pa.array(step == 1)), np.uint8)[spans.entry] > 0
                late = ~(first & spans.at_first)
                np.add.at(gone, spans.start[late], 1)
                np.add.at(gone, (spans.start + spans.length)[late], -1)
        kept = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
        doc = words.doc[kept]
        sizes = words.end[kept] - words.start[kept]
        more = np.zeros(len(kept), dtype=np.int64)
        more[:-1] = doc[:-1] == doc[1:]  # a space follows
        body = ragged(np.append(words.data, np.uint8(32)), words.start[kept], sizes + more).copy()
        ends = np.cumsum(sizes + more)
        body[ends[more > 0] - 1] = 32
        at = np.searchsorted(doc, np.arange(words.docs + 1))
        offsets = np.concatenate([[0], ends])[at]
        texts = pa.LargeStringArray.from_buffers(words.docs, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(body.tobytes()))
        total = np.diff(words.offsets)
        return pa.table([table.column("doc_id"), pa.array(total.astype(np.int64)), pa.array((total - np.diff(at)).astype(np.int64)), texts.cast(pa.string())],
                        names=["doc_id", "n_words", "n_removed", "kept_text"])

    by_block = blocked.groupBy("block")
    seeds = by_block.applyInArrow(send_seeds, ask_schema(3)).groupBy("bucket").applyInArrow(_judge_seeds, _ANSWER)
    spans = (by_block.cogroup(seeds.groupBy("block")).applyInArrow(send_spans, ask_schema(2))
             .groupBy("bucket").applyInArrow(_judge_spans, _ANSWER))
    replies = seeds.withColumn("step", F.lit(0)).unionByName(spans.withColumn("step", F.lit(1)))
    return by_block.cogroup(replies.groupBy("block")).applyInArrow(
        close, "doc_id long, n_words long, n_removed long, kept_text string")
