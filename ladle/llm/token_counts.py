"""Token counts without ids: pieces of each distinct pre-token, joined to per-document pre-token frequencies."""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import answered, dealt, partitions, rows_table, texts_of

#: A pre-token: spaces with what follows them up to the next space or line break, or a run of line breaks.
_PRE_TOKEN = re.compile(r"\n+| *[^ \n]+| +")

@lru_cache(maxsize=2)
def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def _splits_at_spaces(path: str) -> bool:
    """Whether no piece holds a space after another character or a line break, and texts are taken as they are."""
    m = _model(path)
    pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
    plain = all("▁" not in p.lstrip("▁") and "\n" not in p for p in pieces)
    return plain and m.encode(" a  b ", out_type=str)[0].startswith("▁") and m.decode(m.encode("a  b ")) == "a  b "


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text, after the space that the model sets before it. An empty text has none.

    The model writes spaces as U+2581, so that sign in a text is a space to it and joins with its neighbours.
    """
    return _PRE_TOKEN.findall(" " + text.replace("\u2581", " ")) if text else []


def piece_counts(words: list[str], path: str) -> list[int]:
    """The number of pieces of each pre-token. The model sets a space before what it encodes: a pre-token that begins
    with one loses it; another is encoded after a line break, whose pieces are taken off."""
    m = _model(path)
    lead = len(m.encode("\n"))
    asked = [w[1:] if w[0] == " " else "\n" + w for w in words]
    found = m.encode(asked, num_threads=1)
    return [1 if w == " " else len(p) - (0 if w[0] == " " else lead) for w, p in zip(words, found, strict=True)]


def _distinct(texts: list[str], buckets: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pre-tokens in order of bucket and text, their buckets, and the frequencies of each text's pre-tokens,
    keyed by text ordinal * number of distinct pre-tokens + place among them."""
    known: dict[str, int] = {}
    ids = []
    for text in texts:
        words = pre_tokens(text)
        for w in words:
            if w not in known:
                known[w] = len(known)
        ids.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    raw = [w.encode() for w in known]
    bucket = np.fromiter(map(zlib.crc32, raw), np.int64, len(raw)) * buckets >> 32
    order = np.array(sorted(range(len(raw)), key=raw.__getitem__), dtype=np.int64)
    order = order[np.argsort(bucket[order], kind="stable")]
    place = np.empty(len(raw), dtype=np.int64)
    place[order] = np.arange(len(raw))
    sizes = np.array([len(i) for i in ids], dtype=np.int64)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    pairs, counts = np.unique(np.repeat(np.arange(len(ids)), sizes) * max(1, len(raw)) + place[flat], return_counts=True)
    return [raw[i] for i in order], bucket[order], pairs, counts


_SENT = "bucket int, block int, keys binary, c0 binary"
_ANSWER = "bucket int, block int, answer binary"


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row of docs, for a SentencePiece BPE vocabulary.

    Documents are dealt into as many hash blocks as there are shuffle partitions. A block sends each of its distinct
    pre-tokens once to the bucket of its hash, where the pieces of each distinct pre-token are counted once; the counts
    come back to the block and are joined to the pre-token frequencies of its documents. A pre-token that all documents
    hold costs one entry per block. No ids are made. Null and empty texts have 0 tokens; repeated rows and null ids keep
    a row each; further columns are left behind.
    """
    n = partitions(docs.sparkSession)
    blocked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"),
                          dealt(n, "doc_id", text).alias("block"))

    def send(table: pa.Table) -> pa.Table:
        words, bucket, _, _ = _distinct(texts_of(table), n)
        block, bounds = table.column("block")[0].as_py(), np.searchsorted(bucket, np.arange(n + 1))
        return rows_table([{"bucket": b, "block": block, "keys": zlib.compress(b"".join(words[i:j]), 1),
                            "c0": zlib.compress(np.array([len(w) for w in words[i:j]], np.uint32).tobytes(), 1)}
                           for b, (i, j) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)) if i < j], _SENT)

    def judge(table: pa.Table) -> pa.Table:
        if not _splits_at_spaces(path):
            raise ValueError("this vocabulary has pieces across spaces; pre-tokens can't be counted apart")
        parts = []
        for body, sizes in zip(table.column("keys").to_pylist(), table.column("c0").to_pylist(), strict=True):
            body, sizes = zlib.decompress(body), zlib.decompress(sizes)
            ends = np.cumsum(np.frombuffer(sizes, dtype=np.uint32)).tolist()
            parts.append([body[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)])
        distinct = list({w for p in parts for w in p})
        pieces = dict(zip(distinct, piece_counts([w.decode() for w in distinct], path), strict=True))
        bucket = table.column("bucket")[0].as_py()
        return rows_table([{"bucket": bucket, "block": b, "answer": np.fromiter(map(pieces.__getitem__, p), np.uint32, len(p)).tobytes()}
                           for b, p in zip(table.column("block").to_pylist(), parts, strict=True)], _ANSWER)

    def close(table: pa.Table, replies: pa.Table) -> pa.Table:
        words, _, pairs, counts = _distinct(texts_of(table), n)
        pieces = answered(replies, np.uint32).astype(np.int64) if replies.num_rows else np.zeros(0, np.int64)
        doc, word = np.divmod(pairs, max(1, len(words)))
        total = np.bincount(doc, weights=pieces[word] * counts, minlength=table.num_rows).astype(np.int64)
        sizes = pa.compute.binary_length(table.column("text").cast(pa.binary())).fill_null(0).cast(pa.int64())
        return pa.table([table.column("doc_id"), sizes, pa.array(total)], names=["doc_id", "n_bytes", "n_tokens"])

    by_block = blocked.groupBy("block")
    counted = by_block.applyInArrow(send, _SENT).groupBy("bucket").applyInArrow(judge, _ANSWER)
    return by_block.cogroup(counted.groupBy("block")).applyInArrow(close, "doc_id long, n_bytes long, n_tokens long")
