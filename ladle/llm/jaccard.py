"""Links between documents by the Jaccard similarity of their word shingles, with a token-group matrix.

1. Documents with equal shingle sets are one node. Each block sends its nodes' tokens with their document counts; the
   answers tell how rare each is. A node needs so many tokens in common with any partner that too many tokens that
   occur nowhere else rule it out. The others keep their rarest tokens as a prefix: linked nodes share one.
2. Similar nodes form groups: each node goes to the most central of the nodes that lead its prefix tokens (the leader of
   a token holds the commonest tokens, as the original of a family of copies does). It is compared with it, exactly.
3. The token-group matrix holds the prefix tokens of each group. A node and another group that share a token qualify for
   the bound: the node's overlap with the union of the group's tokens must reach what a link needs. Only then is the
   group opened and its members compared. A node that isn't linked to its own leader asks its own group, too. Large
   groups are cut into parts by hash, each with its own union, and their queries likewise, so that a task compares about
   PART members with PART queries, however large a group is; each comparison answers with a spanning forest.
4. Connected components of all links give the classes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import (
    _P, Words, _powers, answered, ask_schema, bucket_bounds, dealt, free_name, grams, joined_hot, mix, partitions, rows_table, runs_of, stored,
)

#: Members of one part of a group in the token-group matrix, and queries compared with them at once, about.
PART = 512
_ANSWER = "bucket int, block int, answer binary"
_NODES = "doc_id long, row_key long, n long, node long, text string, prefix array<long>, center double"


@dataclass
class Sets:
    """Sorted distinct shingle hashes of each text, one after another."""

    tokens: np.ndarray
    doc: np.ndarray
    at: np.ndarray  # bounds per text

    def of(self, i: int) -> np.ndarray:
        return self.tokens[self.at[i]:self.at[i + 1]]


def sets_of(column: pa.ChunkedArray, k: int) -> Sets:
    """Texts' distinct k-word shingles, A-Z lower-cased; a text of fewer words is one shingle, one of none has none."""
    words = Words(column, lower=True)
    n = max(0, len(words.hash) - k + 1)
    at = np.flatnonzero(words.doc[:n] == words.doc[k - 1:k - 1 + n])
    tokens, doc = mix(grams(words.hash, k)[at] + np.uint64(k)), words.doc[at]
    sizes = np.diff(words.offsets)
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            has = sizes[short] > j
            whole[has] += words.hash[words.offsets[short[has]] + j] * _powers(_P, 1 << 16)[j]
        tokens = np.concatenate([tokens, mix(whole + sizes[short].astype(np.uint64))])
        doc = np.concatenate([doc, short.astype(np.int32)])
    order = np.lexsort((tokens, doc))
    tokens, doc = tokens[order], doc[order]
    keep = np.ones(len(tokens), dtype=bool)
    keep[1:] = (tokens[1:] != tokens[:-1]) | (doc[1:] != doc[:-1])
    tokens, doc = tokens[keep], doc[keep]
    return Sets(tokens, doc, np.searchsorted(doc, np.arange(words.docs + 1)))


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least overlap that a set of n tokens has with any set that it links to."""
    return -(-n * percent // 100)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _nodes(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """Each text's node (a 64-bit sum over its set; 0 for an empty set), and the first text of each node."""
    node = np.zeros(len(sets.at) - 1, dtype=np.uint64)
    full = np.flatnonzero(np.diff(sets.at))
    if len(full):
        node[full] = mix(np.add.reduceat(mix(sets.tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)), sets.at[full]) + np.diff(sets.at)[full].astype(np.uint64))
    lead = np.zeros(len(node), dtype=bool)
    lead[full[np.unique(node[full], return_index=True)[1]]] = True
    return node, lead


def _counted(sets: Sets, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of the block's nodes, the distinct values of their upper 48 bits ascending, the entry of each, and
    counts. Tokens that agree in these bits are counted as one: that only makes them look less rare, to all alike."""
    chosen = np.flatnonzero(lead[sets.doc])
    distinct, entry, counts = np.unique(sets.tokens[chosen] >> np.uint64(16), return_inverse=True, return_counts=True)
    return chosen, distinct, entry, counts


def _packed(keys: np.ndarray) -> bytes:
    """Ascending 48-bit keys: a first one and 4-byte steps where these suffice, else 8 bytes each."""
    steps = np.diff(keys)
    if len(keys) and int(steps.max(initial=0)) < 1 << 32:
        return b"4" + keys[:1].tobytes() + steps.astype(np.uint32).tobytes()
    return b"8" + keys.tobytes()


def _unpacked(body: bytes) -> np.ndarray:
    if body[:1] == b"8":
        return np.frombuffer(body, dtype=np.uint64, offset=1)
    keys = np.empty((len(body) - 9) // 4 + 1, dtype=np.uint64)
    keys[0] = np.frombuffer(body, dtype=np.uint64, count=1, offset=1)[0]
    keys[1:] = np.frombuffer(body, dtype=np.uint32, offset=9)
    return np.cumsum(keys, dtype=np.uint64)


def _judge_tokens(table: pa.Table) -> pa.Table:
    """For a bucket: in how many nodes each token occurs, at most 65,535."""
    blocks, parts = np.asarray(table.column("block")), [_unpacked(x) for x in table.column("keys").to_pylist()]
    bounds, keys = np.concatenate([[0], np.cumsum([len(x) for x in parts])]), np.concatenate(parts)
    counts = np.frombuffer(b"".join(table.column("c0").to_pylist()), dtype=np.uint8)
    order = np.argsort(keys, kind="stable")
    first = runs_of(keys[order])
    total = np.minimum(65_535, np.add.reduceat(counts[order].astype(np.int64), first)).astype(np.uint16)
    answer = np.empty(len(keys), dtype=np.uint16)
    answer[order] = np.repeat(total, np.diff(np.append(first, len(keys))))
    bucket = table.column("bucket")[0].as_py()
    return rows_table([{"bucket": bucket, "block": int(b), "answer": answer[i:j].tobytes()}
                       for b, i, j in zip(blocks, bounds[:-1], bounds[1:], strict=True)], _ANSWER)


def _row_key() -> Column:
    """One number for id and text; rows that share it are the same."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")


def document_nodes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Stored: doc_id, n (set size) and node of every document; text, prefix and center (mean logarithm of its tokens'
    counts) where a node may have a partner."""
    n = partitions(docs.sparkSession)
    blocked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row_key"), "text",
                          dealt(2 * n, "doc_id", "text").alias("block"))

    def send(table: pa.Table) -> pa.Table:
        sets = sets_of(table.column("text"), k)
        _, distinct, _, counts = _counted(sets, _nodes(sets)[1])
        at, counts = bucket_bounds(distinct << np.uint64(16), n), np.minimum(255, counts).astype(np.uint8)
        return rows_table([{"bucket": b, "block": table.column("block")[0].as_py(), "keys": _packed(distinct[i:j]), "c0": counts[i:j].tobytes()}
                           for b, (i, j) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)) if i < j], ask_schema(1))

    def close(table: pa.Table, replies: pa.Table) -> pa.Table:
        sets = sets_of(table.column("text"), k)
        node, lead = _nodes(sets)
        chosen, _, entry, _ = _counted(sets, lead)
        rarity = np.zeros(len(sets.tokens), dtype=np.int64)
        if len(chosen):
            rarity[chosen] = answered(replies, np.uint16)[entry]
        size = np.diff(sets.at)
        spare = size - needed(size, percent)
        alone = np.bincount(sets.doc[chosen], weights=rarity[chosen] == 1, minlength=len(size)).astype(np.int64)
        # a partner of another set lets one of the two lack a token: none of up to 5 tokens has one
        open_ = lead & (alone <= spare) & (100 * size >= percent * (size + 1))
        mine = np.flatnonzero(open_[sets.doc])
        mine = mine[np.lexsort((sets.tokens[mine], rarity[mine], sets.doc[mine]))]
        doc = sets.doc[mine]
        nth = np.arange(len(mine)) - np.searchsorted(doc, doc)
        prefix = mine[(nth <= spare[doc]) & (rarity[mine] != 1)]
        at = np.searchsorted(sets.doc[prefix], np.arange(len(size) + 1))
        center = np.bincount(sets.doc, weights=np.log(np.maximum(1, rarity)), minlength=len(size)) / np.maximum(1, size)
        texts = table.column("text").combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.chunk(0)
        return pa.table([
            table.column("doc_id"), table.column("row_key"), pa.array(size.astype(np.int64)), pa.array(node.view(np.int64)),
            pa.compute.if_else(pa.array(open_), texts, pa.scalar(None, texts.type)),
            pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(sets.tokens[prefix].view(np.int64))), pa.array(center)],
            names=["doc_id", "row_key", "n", "node", "text", "prefix", "center"])

    by_block = blocked.groupBy("block")
    counted = by_block.applyInArrow(send, ask_schema(1)).groupBy("bucket").applyInArrow(_judge_tokens, _ANSWER)
    return stored(by_block.cogroup(counted.groupBy("block")).applyInArrow(close, _NODES))


def verified(pairs: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that are linked."""
    a = sets.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = sets.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                x, y = sets_of(part.column("text_a"), k), sets_of(part.column("text_b"), k)
                good = [j for j in range(part.num_rows) if linked(x.of(j), y.of(j), percent)]
                yield pa.RecordBatch.from_arrays([part.column("a").take(pa.array(good, pa.int64())), part.column("b").take(pa.array(good, pa.int64()))], names=["a", "b"])

    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; the component is its least node. Each round takes the least label
    of the neighbours and then the label of that label; rounds are stored, and their number is that of a logarithm."""
    edges = stored(links.select("a", "b").union(links.select("b", "a")).distinct())
    degrees = stored(edges.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("degree")))
    labels = stored(degrees.select(F.col("a").alias("node"), F.least("least", "a").alias("component")))
    degrees = degrees.select(F.col("a").alias("node"), "degree")
    while True:
        # a node with many neighbours, or a label of many nodes, is hot
        told = joined_hot(edges.select("a", F.col("b").alias("node")), stored(labels.join(degrees, "node")), "node", "degree")
        told = told.groupBy("a").agg(F.min("component").alias("least"))
        lower = stored(labels.join(told, labels.node == told.a).select("node", F.col("component").alias("old"), F.least("component", "least").alias("via")))
        sizes = lower.groupBy("via").agg(F.count("*").alias("many"))
        up = stored(sizes.join(lower.select(F.col("node").alias("via"), F.col("via").alias("component")), "via"))
        new = stored(joined_hot(lower, up, "via", "many").select("node", "old", "component"))
        if new.filter("old <> component").isEmpty():
            return labels
        labels = new.select("node", "component")


def _groups(postings: DataFrame) -> DataFrame:
    """(node, grp): the group of each node that shares a prefix token, named by its leader."""
    order = F.struct((-F.col("center")).alias("c"), F.col("node").alias("leader"))
    leaders = stored(postings.groupBy("token").agg(F.min(order).alias("s"), F.count("*").alias("many")).filter("many > 1"))
    return joined_hot(postings.select("node", "token"), leaders, "token", "many").groupBy("node").agg(F.min("s").alias("s")).select("node", F.col("s.leader").alias("grp"))


def _group_links(postings: DataFrame, members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes and the groups that they qualify for: enough to connect all that are linked.

    members: (node, n, grp, settled), settled if the node is linked to its group's leader.
    """
    placed = postings.select("node", "token").join(members, "node")
    matrix = placed.select("token", F.col("grp").alias("other")).distinct()
    shared = matrix.groupBy("token").agg(F.count("*").alias("many")).filter("many > 1").select("token")
    abroad = (placed.join(shared, "token").join(matrix, "token").filter("grp < other")
              .select(F.col("node").alias("query"), F.col("n").alias("n_query"), F.col("other").alias("grp")).distinct())
    home = members.filter(~F.col("settled")).select(F.col("node").alias("query"), F.col("n").alias("n_query"), "grp")
    sizes = members.groupBy("grp").agg(
        F.ceil(F.count("*") / PART).cast("int").alias("parts"), F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.count("*").alias("many"))
    fits = (percent * F.col("n_min") <= 100 * F.col("n_query")) & (100 * F.col("n_max") >= percent * F.col("n_query"))
    asking = stored(abroad.union(home))
    asked = asking.groupBy("grp").agg(F.count("*").alias("asked"))
    asked_of = stored(joined_hot(asking, stored(sizes.join(asked, "grp")), "grp", "asked")
                      .filter(fits & ((F.col("many") > 1) | (F.col("query") != F.col("grp")))).select("grp", "parts", "many", "query"))
    cuts = stored(asked_of.groupBy("grp").agg(F.first("parts").alias("parts"), F.first("many").alias("many"), F.count("*").alias("asked"))
                  .withColumn("cuts", F.ceil(F.col("asked") / PART).cast("int")))
    queries = (joined_hot(asked_of.select("grp", "parts", "query"), cuts.select("grp", "cuts", "asked"), "grp", "asked")
               .select("grp", "query", F.pmod(F.xxhash64("query"), F.col("cuts")).cast("int").alias("cut"),
                       F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
               .join(texts.select(F.col("node").alias("query"), F.col("text").alias("asking")), "query").select("grp", "part", "cut", "query", "asking"))
    inside = (joined_hot(members, cuts.select("grp", "parts", "cuts", "many"), "grp", "many")
              .select("node", "settled", "grp", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"),
                      F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"))
              .join(texts, "node").select("grp", "part", "cut", "node", "settled", "text"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def open_group(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        own, names, settled = sets_of(left.column("text"), k), left.column("node").to_pylist(), left.column("settled").to_pylist()
        union, member_tokens = np.unique(own.tokens, return_inverse=True)
        size = np.diff(own.at)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        held = [x for x, s in zip(names, settled, strict=True) if s]
        for x in held:
            parent[x] = held[0]
        links = []
        for at in range(0, right.num_rows, 256):
            some = right.slice(at, 256)
            asking, ids = sets_of(some.column("asking"), k), some.column("query").to_pylist()
            place = np.minimum(np.searchsorted(union, asking.tokens), len(union) - 1)
            known = union[place] == asking.tokens
            overlap = np.bincount(asking.doc, weights=known, minlength=len(ids))
            n = np.diff(asking.at)
            for i in np.flatnonzero((overlap >= needed(n, percent)) & (n > 0)):
                mark = np.zeros(len(union), dtype=np.int64)
                span = slice(asking.at[i], asking.at[i + 1])
                mark[place[span][known[span]]] = 1
                both = np.add.reduceat(mark[member_tokens], own.at[:-1])
                for j in np.flatnonzero(100 * both >= percent * (size + n[i] - both)):
                    x, y = root(ids[i]), root(names[j])
                    if x != y:
                        parent[x] = y
                        links.append({"a": ids[i], "b": names[j]})
        return pa.Table.from_pylist(links, schema=out)

    keys = ["grp", "part", "cut"]
    return inside.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(open_group, "a long, b long")


def _classes(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, row_key, n and node of every row, and (node, component) of the nodes that have links."""
    nodes = document_nodes(docs, k, percent)
    sets = stored(nodes.filter("text is not null and size(prefix) > 0").select("node", "n", "text", "prefix", "center").dropDuplicates(["node"]))
    texts = sets.select("node", "text")
    postings = sets.select("node", "center", F.explode("prefix").alias("token"))
    groups = stored(_groups(postings).join(sets.select("node", "n"), "node"))
    first = stored(verified(groups.filter("node <> grp").select(F.col("node").alias("a"), F.col("grp").alias("b")), sets, k, percent))
    settled = first.select(F.col("a").alias("node"), F.lit(True).alias("linked"))
    members = stored(groups.join(settled, "node", "left").select(
        "node", "n", "grp", (F.coalesce("linked", F.lit(False)) | (F.col("node") == F.col("grp"))).alias("settled")))
    found = components(first.union(_group_links(postings, members, texts, k, percent)))
    return nodes.select("doc_id", "row_key", "n", "node"), found


def similar_classes(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the least doc_id reachable by links, its own included.

    Two documents link when 100 * intersection >= percent * union of their k-word shingle sets. Words are what white
    space divides, A-Z in lower case. Documents without words link with nothing and are their own component. Null ids
    have a component's least id, or null; repeated rows keep a row each; further columns are left behind. percent is
    above 50. Hashes have 64 bits; every link is checked on whole sets, computed from the texts.
    """
    rows, found = _classes(docs, k, percent)
    per_node = rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("own"), F.count("*").alias("many"))
    classed = stored(per_node.join(found, "node", "left").select("node", "own", "many", F.coalesce("component", "node").alias("class")))
    least = stored(classed.groupBy("class").agg(F.min("own").alias("component_id"), F.count("*").alias("nodes")))
    named = stored(joined_hot(classed, least, "class", "nodes").select("node", "many", "component_id"))
    return (joined_hot(rows.filter("n > 0"), named, "node", "many").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
            .union(rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each class: that of the least doc_id (a null one only where a class has no other), of these
    the least by a hash of the text; of repeated rows one. Rows without words all stay, once each."""
    (rows, found), key = _classes(docs, k, percent), free_name("_key", docs.columns)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("s")
    kept = (rows.filter("n > 0").groupBy("node").agg(first).join(found, "node", "left")
            .groupBy(F.coalesce("component", "node").alias("class")).agg(F.min("s").alias("s"))
            .select(F.col("s.row_key").alias(key)).union(rows.filter("n = 0").select(F.col("row_key").alias(key))))
    keyed = docs.withColumn(key, _row_key())
    return keyed.join(kept.distinct(), key, "left_semi").dropDuplicates([key]).drop(key)
