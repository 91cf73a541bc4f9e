"""Conversation structure: damage, and the cheapest edits that repair it, with their audit.

The repair is a dynamic program over the rows of a conversation and four states of the role sequence. What it keeps is
persistent: an edit is a node that links to the edits before it, with binary-lifting ancestors and a rolling hash of
the whole prefix. Prefixes of equal cost are compared at their first difference, found by search over ancestors; equal
hashes of different nodes are followed letter by letter.

A long conversation isn't one task: rows (without texts) are range-partitioned by conversation and turn, every run of
rows becomes a 4 x 4 matrix of (cost, audit) from entry state to exit state, and matrices multiply.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import crc, partitions, stored

_BLANK = r"[^\x20\x09-\x0D]"
#: States of the role sequence: nothing yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_STATES = range(4)
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5
_INSERTED = {USER: b"user:", ASSISTANT: b"assistant:"}
#: Rows of one dynamic program; longer conversations multiply the matrices of their chunks.
CHUNK = 4096
_HASH, _BASE = (1 << 61) - 1, 1_000_003

Matrix = dict[tuple[int, int], tuple[int, bytes]]


# -- the persistent dynamic program -------------------------------------------
class EditPrefixes:
    """Edit sequences as linked nodes. Node 0 is the empty sequence."""

    def __init__(self, hashed: Callable[[int, int], int] | None = None):
        self.letter, self.depth, self.hash, self.up = [0], [0], [0], [[]]
        self._hashed = hashed or (lambda h, c: (h * _BASE + c) % _HASH)
        self.collisions = 0

    def add(self, node: int, letter: int) -> int:
        """The node of a sequence that has one more edit."""
        new = len(self.letter)
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append(self._hashed(self.hash[node], letter))
        up = [node]
        while len(far := self.up[up[-1]]) >= len(up):
            up.append(far[len(up) - 1])
        self.up.append(up)
        return new

    def ancestor(self, node: int, depth: int) -> int:
        """The node's prefix of that many edits."""
        rest = self.depth[node] - depth
        while rest:
            k = min(rest.bit_length(), len(self.up[node])) - 1
            node = self.up[node][k]
            rest -= 1 << k
        return node

    def _same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth spell the same edits; an equal hash alone doesn't prove it."""
        if a == b or self.hash[a] != self.hash[b]:
            return a == b
        while a != b:
            if self.letter[a] != self.letter[b]:
                self.collisions += 1
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether a's edits come before b's in ASCII order; a proper prefix comes first."""
        short = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, short), self.ancestor(b, short)
        if self._same(x, y):
            return self.depth[a] < self.depth[b]
        low, high = 0, short  # prefixes of low edits agree, those of high edits don't
        while high - low > 1:
            k = (high - low - 1).bit_length() - 1
            p, q = self.ancestor(x, high - (1 << k)), self.ancestor(y, high - (1 << k))
            if self._same(p, q):
                low = high - (1 << k)
            else:
                x, y, high = p, q, high - (1 << k)
        return self.letter[x] < self.letter[y]

    def text(self, node: int) -> bytes:
        out = bytearray()
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return bytes(out[::-1])


def _chunk(rows: list[tuple[str, bool, bool]], entries: range | list[int], make=EditPrefixes) -> Matrix:
    """Matrix of a run of rows (role initial, must go, truncated): edits before each row and of it, none after the last."""
    out: Matrix = {}
    k, r, d, i = b"KRDI"
    for entry in entries:
        nodes = make()
        cells: dict[int, tuple[int, int]] = {entry: (0, 0)}

        def offer(to: dict, state: int, cost: int, node: int, letter: int, nodes=nodes) -> None:
            known = to.get(state)
            if known is None or cost < known[0]:
                to[state] = (cost, nodes.add(node, letter))
            elif cost == known[0]:
                new = nodes.add(node, letter)
                if nodes.less(new, known[1]):
                    to[state] = (cost, new)

        for initial, gone, cut in rows:
            if gone:  # an insertion before a deletion can as well follow it, and D comes before I
                cells = {q: (c + DELETE, nodes.add(n, d)) for q, (c, n) in cells.items()}
                continue
            before = dict(cells)
            for state in (EMPTY, SYSTEM, ASSISTANT):
                if state in cells:
                    offer(before, USER, cells[state][0] + INSERT, cells[state][1], i)
            if USER in before:
                offer(before, ASSISTANT, before[USER][0] + INSERT, before[USER][1], i)
            after: dict[int, tuple[int, int]] = {}
            more = TRUNCATED if cut else 0
            for state, (cost, node) in before.items():
                offer(after, state, cost + DELETE, node, d)
                if state == EMPTY and initial == "s":
                    offer(after, SYSTEM, cost + KEEP + more, node, k)
                turn, letter = (ASSISTANT, "a") if state == USER else (USER, "u")
                offer(after, turn, cost + more + (KEEP if initial == letter else REROLE), node, k if initial == letter else r)
            cells = after
        for state, (cost, node) in cells.items():
            out[entry, state] = (cost, nodes.text(node))
    return out


def _product(a: Matrix, b: Matrix) -> Matrix:
    """Edits of one run of rows followed by those of the next; only ties in cost compare their audits."""
    out: Matrix = {}
    for p in {p for p, _ in a}:
        for q in _STATES:
            ways = [(a[p, r], b[r, q]) for r in _STATES if (p, r) in a and (r, q) in b]
            if ways:
                cost = min(x[0] + y[0] for x, y in ways)
                out[p, q] = (cost, min(x[1] + y[1] for x, y in ways if x[0] + y[0] == cost))
    return out


def _multiply(parts: list[Matrix]) -> Matrix:
    """Product of the matrices of consecutive runs, by halves."""
    while len(parts) > 1:
        parts = [_product(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _deletions(n: int) -> Matrix:
    return {(q, q): (DELETE * n, b"D" * n) for q in _STATES}


def run_matrix(rows: list[tuple[str, bool, bool, int]], entries: list[int] | range, chunk: int = CHUNK) -> Matrix:
    """Matrix of rows (role initial, must go, truncated, copies); copies after the first are deleted."""
    parts, open_ = [], []

    def close() -> None:
        if open_:
            parts.append(_chunk(open_, entries if not parts else _STATES))
            open_.clear()

    for initial, gone, cut, copies in rows:
        open_.append((initial, gone, cut))
        if copies > 1:
            if copies < chunk:
                open_.extend([(initial, True, False)] * (copies - 1))
            else:
                close()
                parts.append(_deletions(copies - 1))
        if len(open_) >= chunk:
            close()
    close()
    return _multiply(parts) if parts else {(q, q): (0, b"") for q in entries}


def finished(matrix: Matrix) -> tuple[int, bytes]:
    """The cheapest way from nothing to a finished sequence: what is open is closed by insertions."""
    ends = {EMPTY: b"", ASSISTANT: b"", USER: b"I", SYSTEM: b"II"}
    ways = [(c + INSERT * len(ends[q]), audit + ends[q]) for (p, q), (c, audit) in matrix.items() if p == EMPTY]
    return min(ways)


# -- Spark --------------------------------------------------------------------
def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, n): the rows after damage, equal ones counted; a dropped row leaves n = 0.

    Damage goes by crc32('conv_id:turn') % 20: 0 drops the row, 1 empties its text, 2 removes its sentence ends,
    3 repeats it, 4 makes it the user's. A null id or turn counts as one space in the checksum, a null role or text is
    one space.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    kind = crc(key) % 20
    body = F.coalesce(F.col(text), space)
    read = rows.select(
        F.col(conv).alias("conv_id"), F.when(kind != 0, F.col(turn)).alias("turn"),
        F.when(kind == 4, "user").when(kind != 0, F.coalesce(F.col(role), space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(body, "[.!?]", "")).when(kind != 0, body).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"))
    return read.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


_ORDER = ["conv_id", "turn", "role", "lead", "digest"]


def _sorted(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


_PIECE = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("matrix", pa.binary()), ("first_initial", pa.string()), ("last_initial", pa.string()),
    ("counts", pa.list_(pa.int64())), ("turns", pa.list_(pa.int64()))])
_PIECE_DDL = ("conv_id long, part int, matrix binary, first_initial string, last_initial string, counts array<long>, "
              "turns array<long>")


def _packed(m: Matrix) -> bytes:
    return b"\n".join(b"%d %d %d %s" % (p, q, c, audit) for (p, q), (c, audit) in sorted(m.items()))


def _unpacked(data: bytes) -> Matrix:
    return {(int(p), int(q)): (int(c), audit) for p, q, c, audit in (x.split(b" ") for x in data.split(b"\n") if x)}


class _Piece:
    """The rows of one conversation in one partition: counts of faults and what neighbours need to join theirs."""

    def __init__(self, conv, whole_start: bool):
        self.conv, self.whole_start, self.rows = conv, whole_start, []
        self.first = self.last = None
        self.faults, self.illegal, self.turns = [0, 0, 0], 0, []  # turns: least, greatest, distinct

    def take(self, turn, initial: str, n: int, blank: bool, seen: bool, cut: bool) -> None:
        if not n:
            return
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        if n > 1 and initial * 2 not in ("su", "ua", "au"):
            self.illegal += n - 1
        self.first = initial if self.first is None else self.first
        self.last = initial
        gone = blank or seen
        self.faults[0] += n if blank else 0
        self.faults[1] += 0 if blank else n if seen else n - 1
        self.faults[2] += 1 if cut and not gone else 0
        self.rows.append((initial, gone, cut and not gone, n))
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1], self.turns[2] = turn, self.turns[2] + 1

    def row(self, part: int) -> dict:
        matrix = run_matrix(self.rows, [EMPTY] if self.whole_start else _STATES)
        return {"conv_id": self.conv, "part": part, "matrix": _packed(matrix), "first_initial": self.first, "last_initial": self.last,
                "counts": [*self.faults, self.illegal], "turns": self.turns}


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation and partition, from rows in order."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    piece, started, out = None, False, []
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "turn", "initial", "n", "blank", "seen", "cut")]
        for conv, *rest in zip(*columns, strict=True):
            if piece is None or piece.conv != conv:
                if piece is not None:
                    out.append(piece.row(part))
                piece, started = _Piece(conv, started), True  # only the first may have begun in an earlier partition
            piece.take(*rest)
        if len(out) >= 5000:
            yield pa.RecordBatch.from_pylist(out, schema=_PIECE)
            out = []
    if piece is not None:
        out.append(piece.row(part))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_PIECE)


class _Conversation:
    """Pieces joined in order, then the repaired rows hashed as they stream by."""

    def __init__(self, conv):
        self.conv, self.matrices, self.audit = conv, [], None
        self.counts, self.last, self.turns = [0, 0, 0, 0], None, []
        self.sha, self.begun, self.at, self.state = hashlib.sha256(), False, 0, EMPTY

    def join(self, matrix: bytes, first: str | None, last: str | None, counts: list[int], turns: list[int]) -> None:
        if first is None:  # nothing but dropped rows
            return
        self.matrices.append(_unpacked(matrix))
        self.counts = [a + b for a, b in zip(self.counts, counts, strict=True)]
        if self.last is not None and self.last + first not in ("su", "ua", "au"):
            self.counts[3] += 1
        self.last = last
        if turns:
            same = bool(self.turns) and self.turns[1] == turns[0]
            self.turns = [self.turns[0], turns[1], self.turns[2] + turns[2] - same] if self.turns else list(turns)

    def solve(self) -> None:
        if self.audit is None:
            self.cost, self.audit = finished(_multiply(self.matrices)) if self.matrices else (0, b"")

    def _say(self, line: bytes) -> None:
        if self.begun:
            self.sha.update(b"\n")
        self.sha.update(line)
        self.begun = True

    def _insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == 73:  # I
            self.state = ASSISTANT if self.state == USER else USER
            self._say(_INSERTED[self.state])
            self.at += 1

    def take(self, role: str, text: str, n: int) -> None:
        self.solve()
        for copy in range(n):
            self._insertions()
            edit = self.audit[self.at]
            self.at += 1
            if edit == 68:  # D; further copies are deleted too, and nothing is inserted between them
                if copy:
                    self.at += n - 1 - copy
                    break
                continue
            if edit == 75:  # K
                self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                kept = role.encode()
            else:
                self.state = ASSISTANT if self.state == USER else USER
                kept = _INSERTED[self.state][:-1]
            self._say(kept + b":")
            self.sha.update(text.encode())

    def row(self) -> dict:
        self.solve()
        self._insertions()
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        blank, duplicate, truncated, illegal = self.counts
        return {"conv_id": self.conv, "gaps": gaps, "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal,
                "cost": self.cost, "audit": self.audit.decode(), "repaired_sha256": self.sha.hexdigest()}


_REPAIR = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                     ("audit", pa.string()), ("repaired_sha256", pa.string())])
_REPAIR_DDL = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
               "repaired_sha256 string")


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation; holds one conversation's audit and the state of its hash, never its texts."""
    now, out = None, []
    for batch in batches:
        cols = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in batch.schema.names}
        for i, conv in enumerate(cols["conv_id"]):
            if now is None or now.conv != conv:
                if now is not None:
                    out.append(now.row())
                now = _Conversation(conv)
            if cols["kind"][i] == 0:
                now.join(*(cols[c][i] for c in ("matrix", "first_initial", "last_initial", "counts", "turns")))
            else:
                now.take(cols["role"][i], cols["text"][i], cols["n"][i])
        if len(out) >= 5000:
            yield pa.RecordBatch.from_pylist(out, schema=_REPAIR)
            out = []
    if now is not None:
        out.append(now.row())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_REPAIR)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conv_id of rows (conv_id, turn, role, text, n): gaps, faults, cost, audit and hash of the repaired rows.

    Rows go by turn (nulls first); rows of one turn by role, then the first 32 characters and the digest of their text.
    n counts equal rows; n = 0 marks a conversation without taking part. A null conv_id is one conversation. Edits and
    costs: see the module's constants. The audit gives role initials (s?(ua)+)? at the least cost, the ASCII-least of
    those. Other columns are ignored, an empty table gives no rows.

    Three shuffles: digests to find rows seen earlier, rows without texts by range (a conversation may span partitions),
    and texts with the pieces' matrices by conversation, where they are only hashed as they stream by.
    """
    n = partitions(rows.sparkSession)
    there = F.col("n") > 0
    base = stored(rows.select("conv_id", "turn", "role", "text", "n", F.left("text", F.lit(32)).alias("lead"),
                              F.unhex(F.sha2("text", 256)).alias("digest")))
    small = base.select(
        "conv_id", "turn", "role", "lead", "digest", "n", F.left("role", F.lit(1)).alias("initial"),
        F.coalesce(~F.col("text").rlike(_BLANK), F.lit(False)).alias("blank"),
        F.coalesce(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), F.lit(False)).alias("cut"))
    turn_key = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    again = (small.filter(there & ~F.col("blank")).groupBy("conv_id", "role", "digest")
             .agg(F.min(turn_key).alias("earliest"), F.count("*").alias("times")).filter("times > 1")
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "earliest"))
    flagged = small.join(
        again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left",
    ).select(*small.columns, F.coalesce(F.col("earliest") < turn_key, F.lit(False)).alias("seen"))
    pieces = (flagged.repartitionByRange(n, *_sorted(_ORDER)).sortWithinPartitions(*_sorted(_ORDER))
              .select("conv_id", "turn", "initial", "n", "blank", "seen", "cut").mapInArrow(_pieces, _PIECE_DDL))
    texts = base.filter(there).select("conv_id", F.lit(1).alias("kind"), *_ORDER[1:], "text", "n")
    both = pieces.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    order = _sorted(["conv_id", "kind", "part", *_ORDER[1:]])
    return both.repartition(n, "conv_id").sortWithinPartitions(*order).mapInArrow(_repairs, _REPAIR_DDL)
