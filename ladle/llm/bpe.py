"""Byte-level BPE with a pair occurrence index, and its inverse."""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ladle.llm.common import text_blocks, texts_of

# fixed value: the public pre-token pattern of byte-level BPE vocabularies of this kind
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Distinct pre-tokens whose ids a task keeps between blocks; beyond it the memory starts anew, with the same results.
KEPT_PRE_TOKENS = 300_000


def byte_letters() -> dict[str, int]:
    """The vocabulary's letter of each byte: printable Latin-1 stands for itself, the rest for 256 and up in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + n): b for n, b in enumerate(hidden)}}


class PairIndex:
    """Symbols of many words in one array, with the positions of every mergeable pair, by the pair's rank.

    Ranks are applied in ascending order to all positions of their pair at once. A merged symbol was made later than
    its parts, so the pairs that it forms have higher ranks, and one ascending sweep gives what merging each word on
    its own gives. A position that an earlier merge has used up is skipped when its list is read.
    """

    def __init__(self, symbols: np.ndarray, last: np.ndarray, keys: np.ndarray, ranks: np.ndarray, made: np.ndarray, width: int):
        n = len(symbols)
        self.symbols, self.keys, self.ranks, self.made, self.width = symbols, keys, ranks, made, width
        self.next = np.arange(1, n + 1, dtype=np.int32)
        self.next[last] = -1
        self.before = np.arange(-1, n - 1, dtype=np.int32)
        self.before[last[:-1] + 1] = -1
        self.alive = np.ones(n, dtype=bool)
        self.positions: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._index(np.flatnonzero(self.next >= 0))

    def _index(self, at: np.ndarray) -> None:
        """Enter positions into the list of the pair that stands there now."""
        if not len(at):
            return
        pair = self.symbols[at].astype(np.int64) * self.width + self.symbols[self.next[at]]
        found = np.searchsorted(self.keys, pair)
        found[found == len(self.keys)] = 0
        hit = self.keys[found] == pair
        if not hit.any():
            return
        at, rank = at[hit], self.ranks[found[hit]]
        if len(at) > 1:
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            parts, names = np.split(at, cuts), rank[np.concatenate([[0], cuts])].tolist()
        else:
            parts, names = [at], rank.tolist()
        for r, p in zip(names, parts, strict=True):
            if (held := self.positions.get(r)) is None:
                self.positions[r] = [p]
                heapq.heappush(self.active, r)
            else:
                held.append(p)

    def merge_all(self, left: np.ndarray, right: np.ndarray) -> None:
        symbols, nxt, before, alive = self.symbols, self.next, self.before, self.alive
        while self.active:
            r = heapq.heappop(self.active)
            parts = self.positions.pop(r)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            a, b = left[r], right[r]
            follow = nxt[at]
            good = alive[at] & (follow >= 0) & (symbols[at] == a)
            good &= symbols[np.maximum(follow, 0)] == b
            at = at[good]
            if not len(at):
                continue
            if a == b and len(at) > 1:
                at = self._apart(np.sort(at))
            gone = nxt[at]
            after = nxt[gone]
            symbols[at] = self.made[r]
            alive[gone] = False
            nxt[at] = after
            inner = after >= 0
            before[after[inner]] = at[inner]
            prior = before[at]
            prior = prior[prior >= 0]
            changed = np.concatenate([prior, at[inner]])
            self._index(np.unique(changed) if len(changed) > 1 else changed)

    def _apart(self, at: np.ndarray) -> np.ndarray:
        """Of overlapping positions of a pair of two equal symbols, every second from the left of each run."""
        follows = np.zeros(len(at), dtype=bool)
        follows[1:] = self.next[at[:-1]] == at[1:]
        begin = np.maximum.accumulate(np.where(~follows, np.arange(len(at)), 0))
        return at[(np.arange(len(at)) - begin) % 2 == 0]


class ByteBpe:
    """A byte-level vocabulary of the public JSON form."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        pieces = [b""] * size
        for piece, i in vocabulary.items():
            pieces[i] = bytes(letters[c] for c in piece)
        for piece, i in self.special.items():
            pieces[i] = piece.encode()
        self.pieces, self.lengths = np.frombuffer(b"".join(pieces), dtype=np.uint8), np.array([len(p) for p in pieces], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.of_byte = np.zeros(256, dtype=np.int32)
        for letter, b in letters.items():
            self.of_byte[b] = vocabulary[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([vocabulary[a] for a, _ in merges], dtype=np.int32)
        self.right = np.array([vocabulary[b] for _, b in merges], dtype=np.int32)
        made = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int32)
        keys = self.left.astype(np.int64) * size + self.right
        order = np.argsort(keys)
        self.made, self.keys, self.ranks, self.size = made, keys[order], order.astype(np.int32), size
        self.split = regex.compile(PRE_TOKEN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def pre_tokens(self, text: str) -> list[str]:
        """The text's pre-tokens; a special string is one by itself."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.split.findall(text)
        out: list[str] = []
        for n, part in enumerate(self.cut.split(text)):
            if n % 2:
                out.append(part)
            elif part:
                out += self.split.findall(part)
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after another, and each word's count of ids."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        special = np.array([w in self.special for w in words], dtype=bool)
        sizes = np.array([1 if s else len(r) for s, r in zip(special, raw, strict=True)], dtype=np.int64)
        if not len(words):
            return np.zeros(0, np.int32), sizes
        flat = np.frombuffer(b"".join(b"\0" if s else r for s, r in zip(special, raw, strict=True)), dtype=np.uint8)
        symbols = self.of_byte[flat]
        ends = np.cumsum(sizes)
        for i in np.flatnonzero(special):
            symbols[ends[i] - 1] = self.special[words[i]]
        index = PairIndex(symbols, ends - 1, self.keys, self.ranks, self.made, self.size)
        index.merge_all(self.left, self.right)
        kept = np.cumsum(index.alive)[ends - 1]
        return index.symbols[index.alive], np.diff(kept, prepend=0)

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        return ragged(self.pieces, self.starts[ids], self.lengths[ids])


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[starts[i]:starts[i] + lengths[i]] one after another."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    shift += np.arange(total)
    return values[shift]


@lru_cache(maxsize=2)
def vocabulary_of(path: str) -> ByteBpe:
    return ByteBpe(path)


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each block with the flat ids of its texts and their bounds."""
    bpe = vocabulary_of(path)
    known: defaultdict[str, int] = defaultdict()
    known.default_factory = known.__len__
    flat, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for block in text_blocks(batches):
        if len(known) > KEPT_PRE_TOKENS:
            known.clear()
            flat, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        had, order = len(known), []
        for text in texts_of(block):
            words = bpe.pre_tokens(text)
            order.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        if len(known) > had:
            new, sizes = bpe.encode_words(list(known)[had:])
            flat, counts = [np.concatenate([*flat, new])], [np.concatenate([*counts, sizes])]
        starts = np.cumsum(counts[0]) - counts[0]
        words_at = np.concatenate([[0], np.cumsum([len(o) for o in order])])
        words = np.concatenate(order) if order else np.zeros(0, np.int32)
        lengths = counts[0][words]
        ids_at = np.concatenate([[0], np.cumsum(lengths)])[words_at]
        yield block, ragged(flat[0], starts[words], lengths), ids_at


def encode_documents(docs: DataFrame, path: str, text: str = "text", decode: bool = False) -> DataFrame:
    """docs with ids (array of int): byte-level BPE of every whole text; with decode also decoded, the ids' text again.

    path: a public vocabulary in JSON. Per task and block, distinct pre-tokens are encoded once with the pair index;
    a block holds a bounded number of text bytes. A null or empty text has no ids and decodes to "". Special strings
    in a text become their own ids. Bytes that are not UTF-8 decode to the replacement character. An id column that
    exists is replaced; all other columns, repeated rows included, pass through.
    """
    kept = [f for f in docs.schema.fields if f.name not in {"ids", *(["decoded"] if decode else [])}]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", ids array<int>" + (", decoded string" if decode else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary_of(path)
        for block, ids, at in _encoded(batches, path):
            columns = [block.column(i) for i in range(block.num_columns)]
            columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())))
            names = [*block.schema.names, "ids"]
            if decode:
                columns.append(decoded_texts(bpe, ids, at))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, schema)


def decoded_texts(bpe: ByteBpe, ids: np.ndarray, at: np.ndarray) -> pa.Array:
    body = bpe.decode_bytes(ids)
    ends = np.concatenate([[0], np.cumsum(bpe.lengths[ids])])[at]
    texts = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(body.tobytes())])
    try:
        out = texts.cast(pa.string())
        out.validate(full=True)
        return out
    except pa.ArrowInvalid:
        return pa.array([b.decode("utf-8", "replace") for b in texts.to_pylist()], pa.string())


def decode_documents(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """rows with decoded: the text of their ids (null for null ids; ids outside the vocabulary decode to nothing)."""
    kept = [f for f in rows.schema.fields if f.name != "decoded"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary_of(path)
        for batch in batches:
            texts = []
            for some in batch.column(ids).to_pylist():
                if some is None:
                    texts.append(None)
                    continue
                known = np.array([i for i in some if i is not None and 0 <= i < bpe.size], dtype=np.int64)
                texts.append(bpe.decode_bytes(known).tobytes().decode("utf-8", "replace"))
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return rows.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, schema)
