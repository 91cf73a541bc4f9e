"""Hashed character n-grams of whole texts, TF-IDF weights over a corpus, and per-document sparse rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import text_blocks, texts_of

_CHUNK = 1 << 20
_A, _B = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gram_counts(points: np.ndarray, longest: int, bits: int) -> np.ndarray:
    """Counts of hashed character n-grams of 1 to longest characters, in 2^bits cells. Long texts go in chunks that
    overlap by longest - 1 characters, so that every n-gram counts once."""
    total = np.zeros(1 << bits, dtype=np.int64)
    shift = np.uint32(32 - bits)
    for at in range(0, len(points), _CHUNK):
        part = points[at:at + _CHUNK + longest - 1]
        parts, h = [], np.zeros(0, np.uint32)
        for n in range(1, longest + 1):
            if n == 1:
                h = part[:_CHUNK] * _A
            else:
                keep = min(len(h), len(part) - n + 1)
                if keep <= 0:
                    break
                h = (h[:keep] ^ (h[:keep] >> np.uint32(15))) * _B + part[n - 1:n - 1 + keep] * _A + np.uint32(n)
            parts.append((h * _A) >> shift)
        total += np.bincount(np.concatenate(parts), minlength=1 << bits)
    return total


def document_frequencies(texts: DataFrame, count: Callable[[str], tuple[np.ndarray, np.ndarray]], cells: int) -> tuple[np.ndarray, int]:
    """In how many texts each cell occurs, and the number of texts, over all rows of texts. A task sends one partial
    vector; the driver gets one number per cell. count gives a text's cells and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(cells, dtype=np.int64), 0
        for block in text_blocks(batches):
            for text in texts_of(block):
                total[count(text)[0]] += 1
                n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(total[at], n), pa.int64())], names=["cell", "n"])

    sums = texts.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cell, n = np.asarray(sums.column("cell")), np.asarray(sums.column("n"))
    out = np.zeros(cells, dtype=np.int64)
    out[cell[cell >= 0]] = n[cell >= 0]
    return out, int(n[cell < 0].sum())


def inverse_frequencies(df: np.ndarray, n: int) -> np.ndarray:
    return (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)


def bounded_sample(rows: DataFrame, group: str, bound: int) -> DataFrame:
    """About bound rows of each value of group (all, if fewer), chosen by a hash of doc_id: one counting pass, and a
    threshold per value. group has few values."""
    counts = {r[0]: r[1] for r in rows.groupBy(group).count().collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(group) == F.lit(value), F.lit(min(1.0, bound / max(1, n)))).otherwise(share)
    spread = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return rows.filter(spread < share)


def sparse_rows(rows: DataFrame, label: str, count: Callable[[str], tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    """(doc_id, label, cells, counts) of the rows of a bounded sample, on the driver, in order of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            pairs = [count(t) for t in texts_of(block)]
            yield pa.RecordBatch.from_arrays([
                block.column(0), block.column(1), pa.array([p[0].astype(np.int32) for p in pairs], pa.list_(pa.int32())),
                pa.array([p[1].astype(np.float32) for p in pairs], pa.list_(pa.float32()))], names=["doc_id", "label", "cells", "counts"])

    kind = dict(rows.dtypes)[label]
    return (rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"), "text")
            .mapInArrow(run, f"doc_id long, label {kind}, cells array<int>, counts array<float>").toArrow().sort_by("doc_id"))
