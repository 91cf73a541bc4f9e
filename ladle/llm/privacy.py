"""Personal data: exact patterns, and terms that a corpus shows to give protected entities away.

The patterns find e-mail, IP, card and phone values; each distinct value is a protected entity, and so is each group of
values (a domain, a network, an issuer, an exchange), for most values occur once. A term in a document of an entity
discloses PMI(entity; term) / IC(entity) of it, estimated from document counts over the whole corpus: 1 if the term
never occurs without the entity, 0 if the two are independent. The estimate is shrunken towards 0 by the number of
different surroundings of the entity that show it, so that copies of one passage prove nothing. Terms above a threshold
are generalised to their class, those above a higher one removed, wherever they occur.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import free_name, stored, text_blocks, texts_of
from ladle.llm.jaccard import _row_key

KINDS = ("email", "ip", "card", "phone")
#: Terms to mask, and documents with some (about 1 kB each), up to which these are broadcast; beyond it, joined by shuffle.
BROADCAST_DOCUMENTS = 20_000
#: Bytes of text whose terms and places one batch holds.
TERM_BYTES = 1 << 20
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"\w+")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if n % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches around each @: the run of local characters before it, not into the match before, and a domain."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind, then start; matches that fail a kind's test are dropped."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


def joined_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def entity_of(kind: str, value: str) -> str:
    return f"{kind}:{value.lower()}" if kind == "email" else f"{kind}:{value}" if kind == "ip" else f"{kind}:{_NOT_DIGIT.sub('', value)}"


def group_of(entity: str) -> str:
    """What an entity shares with others of its kind: a domain, the first three parts of an IP, the first six digits of
    a card, all but the last four of a phone."""
    kind, value = entity.split(":", 1)
    part = value.rsplit("@", 1)[-1] if kind == "email" else value.rsplit(".", 1)[0] if kind == "ip" else value[:6] if kind == "card" else value[:-4]
    return f"{kind} group:{part}"


def entities_around(text: str, spans: list[tuple[str, int, int]]) -> dict[str, int]:
    """The entities of the spans and their groups, each with a hash of the two whole words before and after the first."""
    out: dict[str, int] = {}
    words = [m.span() for m in _TERM.finditer(text)] if spans else []
    starts, ends = [a for a, _ in words], [b for _, b in words]
    for kind, s, e in spans:
        entity = entity_of(kind, text[s:e])
        before, after = bisect_right(ends, s), bisect_left(starts, e)
        around = zlib.crc32(" ".join(text[a:b] for a, b in words[max(0, before - 2):before] + words[after:after + 2]).lower().encode("utf-8", "replace"))
        for x in (entity, group_of(entity)):
            out.setdefault(x, around)
    return out


def term_places(text: str, spans: list[tuple[str, int, int]]) -> dict[str, list[tuple[int, int]]]:
    """(start, end) of each term outside all spans. A term has a letter; it is looked up in lower case."""
    taken = sorted((s, e) for _, s, e in spans)
    out: dict[str, list[tuple[int, int]]] = {}
    at, reached = 0, 0
    for m in _TERM.finditer(text):
        a, b = m.span()
        while at < len(taken) and taken[at][0] < b:
            reached = max(reached, taken[at][1])
            at += 1
        if a >= reached and any(c.isalpha() for c in m.group()):
            out.setdefault(m.group().lower(), []).append((a, b))
    return out


_SCANNED = ("doc_id long, _key long, n_email long, n_ip long, n_card long, n_phone long, base string, "
            "entities array<struct<entity:string,around:long>>, words array<string>")
_ENTITIES = pa.list_(pa.struct([("entity", pa.string()), ("around", pa.int64())]))


def scan_documents(docs: DataFrame) -> DataFrame:
    """One stored row per document with its base spans, its entities and, if it has any, the terms of its whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("_key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            counts, base, entities, words = [], [], [], []
            for t in texts_of(block):
                spans = base_spans(t)
                n = Counter(k for k, _, _ in spans)
                counts.append([n[k] for k in KINDS])
                base.append(joined_spans(spans))
                entities.append([{"entity": x, "around": y} for x, y in entities_around(t, spans).items()])
                words.append(list(term_places(t, spans)) if spans else [])
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(1), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(4)],
                 pa.array(base, pa.string()), pa.array(entities, _ENTITIES), pa.array(words, pa.list_(pa.string()))],
                names=["doc_id", "_key", *[f"n_{k}" for k in KINDS], "base", "entities", "words"])

    return stored(rows.mapInArrow(run, _SCANNED))


def term_documents(docs: DataFrame) -> DataFrame:
    """(term, n_term): in how many documents each lower-case term occurs, over the whole corpus. A task sends each term
    once per 200,000 distinct terms it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["term", "n"])

        for block in text_blocks(batches):
            for t in texts_of(block):
                held.update({w.lower() for w in set(_TERM.findall(t))})
                if len(held) > 200_000:
                    yield out()
                    held.clear()
        yield out()

    return docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosing_terms(scanned: DataFrame, docs: DataFrame, threshold: float, doubt: float) -> DataFrame:
    """(entity, term, disclosure) of the pairs at or above the threshold. Joint, entity and term counts are all of whole
    documents. The estimate is shrunken: n different surroundings of the entity weigh n / (n + doubt)."""
    def weight(n: Column) -> Column:
        return n / (n + F.lit(doubt))

    n = float(scanned.count())
    held = scanned.filter(F.size("entities") > 0).withColumn("_row", F.monotonically_increasing_id())
    held = stored(held.select("_row", "entities", "words"))
    places = held.select("_row", F.explode("entities").alias("e")).select("_row", "e.entity", "e.around")
    # no pair of an entity weighs more than the entity itself
    entities = stored(places.groupBy("entity").agg(F.count("*").alias("n_entity"), F.count_distinct("around").alias("_n"))
                      .filter(weight(F.col("_n")) >= threshold).select("entity", "n_entity"))
    some = places.join(entities, "entity").groupBy("_row").agg(F.collect_list(F.struct("entity", "around")).alias("some"))
    pairs = (held.select("_row", "words").join(some, "_row").select("some", F.explode("words").alias("term"))
             .select("term", F.explode("some").alias("e")).select("e.entity", "term", "e.around"))
    joint = (pairs.groupBy("entity", "term", "around").agg(F.count("*").alias("n"))
             .groupBy("entity", "term").agg(F.sum("n").alias("n_joint"), F.count("*").alias("n_around"))
             .filter(weight(F.col("n_around")) >= threshold))
    counted = joint.join(entities, "entity").join(term_documents(docs), "term")
    pmi, ic = F.ln(F.col("n_joint") * n / (F.col("n_entity") * F.col("n_term"))), F.ln(n / F.col("n_entity"))
    disclosure = F.when(ic > 0, F.least(F.lit(1.0), pmi / ic)).otherwise(F.lit(0.0)) * weight(F.col("n_around"))
    return counted.select("entity", "term", disclosure.alias("disclosure")).filter(F.col("disclosure") >= threshold)


def _terms_to_mask(scanned: DataFrame, docs: DataFrame, threshold: float, removal: float, doubt: float) -> DataFrame:
    """Stored: _key, terms of each row with a flagged term, wherever it stands; broadcast while few."""
    flagged = stored(disclosing_terms(scanned, docs, threshold, doubt).groupBy("term").agg(F.max("disclosure").alias("disclosure")))
    few = flagged.count() <= BROADCAST_DOCUMENTS
    only = {r.term for r in flagged.select("term").collect()} if few else set()
    if few:
        flagged = F.broadcast(flagged)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, TERM_BYTES):
            keys, terms, places = [], [], []
            for key, t in zip(block.column("_key").to_pylist(), texts_of(block), strict=True):
                if few and only.isdisjoint(w.lower() for w in set(_TERM.findall(t))):
                    continue
                for term, found in term_places(t, base_spans(t)).items():
                    if not few or term in only:
                        keys.append(key)
                        terms.append(term)
                        places.append([{"start": a, "end": b} for a, b in found])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(terms, pa.string()), pa.array(places, kind)], names=["_key", "term", "places"])

    everywhere = docs.select(_row_key().alias("_key"), "text").mapInArrow(run, "_key long, term string, places array<struct<start:int,end:int>>")
    action = F.when(F.col("disclosure") >= removal, "remove").otherwise("generalise").alias("action")
    terms = stored(everywhere.join(flagged, "term").select("_key", action, F.explode("places").alias("p"))
                   .groupBy("_key").agg(F.array_sort(F.collect_set(F.struct("p.start", "p.end", "action"))).alias("terms")))
    return F.broadcast(terms) if terms.count() <= BROADCAST_DOCUMENTS else terms


def find_personal_data(docs: DataFrame, threshold: float = 0.8, removal: float = 0.95, doubt: float = 0.3) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base (base spans as text), terms (array of start, end, action) per row.

    Base spans are kept whatever the terms say. terms are all occurrences, in all documents and outside base spans, of
    the terms whose disclosure of some entity or group is at least threshold: to be generalised, or removed from
    `removal` on. By default a term needs two surroundings; those of a value seen once come from its group. Null and
    empty texts have no spans; repeated rows and null ids keep a row each; an entity in every document is no secret
    (disclosure 0); further columns are left behind. Spans count code points, ends exclusive.
    """
    scanned = scan_documents(docs)
    terms = _terms_to_mask(scanned, docs, threshold, removal, doubt)
    return scanned.drop("entities", "words").join(terms, "_key", "left").drop("_key")


def all_spans(base: str = "base", terms: str = "terms") -> Column:
    """Base and term spans as kind:start:end, joined by commas."""
    words = F.transform(F.coalesce(F.col(terms), F.array()), lambda t: F.concat_ws(":", F.lit("term"), t["start"], t["end"]))
    return F.array_join(F.filter(F.concat(F.array(base), words), lambda s: s != ""), ",")


def masked(text: str, base: list[tuple[str, int, int]], terms: list[tuple[int, int, str]]) -> str:
    """The text with its spans replaced: a base span by its kind, a term by its class or by nothing. Of spans that
    overlap, the later ones are joined to the first."""
    def label(s: int, e: int, action: str) -> str:
        word = text[s:e]
        return "" if action == "remove" else "[CODE]" if any(c.isdigit() for c in word) else "[NAME]" if word[:1].isupper() else "[WORD]"

    spans = sorted([(s, e, f"[{k.upper()}]") for k, s, e in base] + [(s, e, label(s, e, a)) for s, e, a in terms])
    out, at = [], 0
    for s, e, put in spans:
        if s >= at:
            out += [text[at:s], put]
        at = max(at, e)
    out.append(text[at:])
    return "".join(out)


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """docs with personal data masked in text (see find_personal_data); n_chars, if there, follows the new text. All
    columns and rows stay; a null text stays null. Terms belong to a row's id and text, so that rows of one id, or
    without an id, are each masked by their own text."""
    thresholds = {"threshold": 0.8, "removal": 0.95, "doubt": 0.3} | options
    own, same, found = (free_name(name, docs.columns) for name in ("_row_key", "_id", "_terms"))
    terms = _terms_to_mask(scan_documents(docs), docs, **thresholds).select(F.col("_key").alias(same), F.to_json("terms").alias(found))
    both = docs.withColumn(own, _row_key()).join(terms, F.col(own) == F.col(same), "left").drop(same, own)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        for batch in batches:
            for block in text_blocks(iter([batch])):
                texts = []
                for t, more in zip(block.column("text").to_pylist(), block.column(found).to_pylist(), strict=True):
                    if t is None:
                        texts.append(None)
                        continue
                    texts.append(masked(t, base_spans(t), [(x["start"], x["end"], x["action"]) for x in json.loads(more or "[]")]))
                columns = {n: block.column(n) for n in names}
                columns["text"] = pa.array(texts, pa.string())
                if "n_chars" in columns:
                    columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], columns["n_chars"].type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return both.mapInArrow(run, schema)
