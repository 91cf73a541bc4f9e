"""Plain versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def kept_words(rows, window=20):
    """{(doc_id, text): (n_words, n_removed, kept)}; rows of one id are one document."""
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for s in range(len(w) - window + 1):
            key = (float("inf") if i is None else i, s)
            k = tuple(w[s:s + window])
            first[k] = min(first.get(k, key), key)
    out = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (float("inf") if i is None else i, s):
                gone[s:s + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[i, t] = (len(w), len(w) - len(kept), " ".join(kept))
    return out


def shingles(text, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def classes(rows, k=4, percent=85):
    """The least id of each row's class, in order of the rows."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (n, _) in enumerate(rows):
        if n is not None:
            least[root(i)] = min(least.get(root(i), n), n)
    return [(n, len(s), least.get(root(i)) if s else n) for i, ((n, _), s) in enumerate(zip(rows, sets, strict=True))]


KINDS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def personal(text):
    def good(kind, v):
        digits = [int(c) for c in v if c in "0123456789"]
        if kind == "ip":
            return all(int(p) < 256 for p in v.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in KINDS for m in re.finditer(p, text or "") if good(k, m.group())]


def letters(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def best_overlap(doc, item, penalty=2):
    """The best run over all diagonals."""
    best = 0
    for d in range(-len(item), len(doc)):
        run = 0
        for j in range(max(0, -d), min(len(item), len(doc) - d)):
            run = max(run, 0) + (1 if doc[j + d] == item[j] else -penalty)
            best = max(best, run)
    return best


def overlap_score(doc, item, penalty=2, enough=13, whole=80):
    """The best score of the diagonals that count; None if none does. Items under nine words count only if held whole."""
    if len(item) < 9:
        return len(item) if any(doc[i:i + len(item)] == item for i in range(len(doc))) else None
    best = None
    for d in range(-len(item), len(doc)):
        run = top = hits = 0
        for j in range(max(0, -d), min(len(item), len(doc) - d)):
            hit = doc[j + d] == item[j]
            hits += hit
            run = max(run, 0) + (1 if hit else -penalty)
            top = max(top, run)
        if (top >= min(enough, len(item)) or 100 * hits >= whole * len(item)) and (best is None or top > best):
            best = top
    return best
