"""Conversation repair, URL filter and prefix trie against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from functools import lru_cache

import pytest
from llm_brute import WORD, sha

from ladle.llm import conversations, queries, tries, urls

ROWS = "conv_id long, turn long, role string, text string"


def odd_conversations(seed=3, many=60):
    rng = random.Random(seed)
    rows = []
    for c in range(many):
        for t in range(rng.randint(0, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Hi.", "Yes!", "No end", " \n", "", None, "Why? ", "a. b", "x\u2028.\n", f"Row {c} {t}.", "Ok.\u2028"])
            rows.append((c, rng.choice([t, t, t, t + 3, None]), role, text))
    rows += [rows[5], rows[5], (None, 0, "user", "Hi."), (None, None, None, None), (-7, 1, "user", "Low."), (997, 5, "user", "x")]
    return rows


# -- repair -------------------------------------------------------------------
def after_damage(rows):
    out = {}
    for c, t, role, text in rows:
        kept = out.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        if kind:
            kept += [(t, role, text)] * (2 if kind == 3 else 1)
    digest = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32], hashlib.sha256(r[2].encode()).digest())
    return {c: sorted(r, key=digest) for c, r in out.items()}


def repaired(rows):
    """The contract's numbers by a backward recursion over whole strings."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(maxsize=None)
    def best(i, state, inserted=0):
        ways = []
        if i == len(rows):
            if state in "0a":
                ways.append((0, "", ()))
        else:
            cost, audit, out = best(i + 1, state)
            ways.append((cost + 2, "D" + audit, out))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                role, text = rows[i][1:]
                moves = [(role, "K", 0)] + [(r, "R", 1) for r in ("user", "assistant")]
                for name, letter, price in moves:
                    if name[:1] + state in ("s0", "u0", "us", "ua", "au"):
                        cost, audit, out = best(i + 1, name[0])
                        ways.append((cost + price + more, letter + audit, ((name, text), *out)))
        if inserted < 3:
            for name in ("user", "assistant"):
                if name[0] + state in ("u0", "us", "ua", "au"):
                    cost, audit, out = best(i, name[0], inserted + 1)
                    ways.append((cost + 5, "I" + audit, ((name, ""), *out)))
        return min(ways) if ways else (10**9, "", ())

    cost, audit, out = best(0, "0")
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out)))


def repairs_of(spark, rows, **extra):
    df = spark.createDataFrame(rows, ROWS)
    for name in ("n", "kind", "part", "digest", "audit"):
        df = df.withColumn(name, tries.F.lit("clash"))
    return {r[0]: tuple(r[1:]) for r in conversations.repair(conversations.damaged(df)).collect()}


def test_repair_equals_brute_force(spark):
    rows = odd_conversations()
    want = {c: repaired(r) for c, r in after_damage(rows).items()}
    assert repairs_of(spark, rows) == want
    assert {"R", "D", "K"} == set("".join(w[6] for w in want.values()))  # a deletion is always cheaper than an insertion
    assert conversations.repair(conversations.damaged(spark.createDataFrame([], ROWS))).count() == 0


def test_repair_of_a_conversation_over_many_partitions(spark):
    """One conversation holds most rows, and one of its rows is repeated hundreds of times."""
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"Say {t}.", f"cut {t}", "again.", ""])) for t in range(400)]
    rows += [(1, 50, "user", "same")] * 300 + [(c, 0, "user", "Hello?") for c in range(2, 30)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert repairs_of(spark, rows) == {c: repaired(r) for c, r in after_damage(rows).items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_chunks_and_colliding_hashes_change_nothing():
    rng = random.Random(2)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.random() < 0.2, rng.random() < 0.3, rng.choice([1, 1, 1, 2, 9])) for _ in range(rng.randint(0, 40))]
        whole = conversations.finished(conversations.run_matrix(rows, [0]))
        for chunk in (1, 3, 8):
            assert conversations.finished(conversations.run_matrix(rows, range(4), chunk)) == whole
        flat = [(a, b, c) for a, b, c, _ in rows]
        made = []

        def weak():
            made.append(conversations.EditPrefixes(lambda h, c: (h + c) % 5))
            return made[-1]

        assert conversations._chunk(flat, [0], weak) == conversations._chunk(flat, [0])
    assert sum(m.collisions for m in made) >= 0


def test_edit_prefixes_compare_like_strings():
    rng = random.Random(4)
    nodes = conversations.EditPrefixes()
    spelled = {0: b""}
    for _ in range(400):
        parent = rng.choice(list(spelled))
        letter = rng.choice(b"DIK")
        spelled[nodes.add(parent, letter)] = spelled[parent] + bytes([letter])
    for _ in range(2000):
        a, b = rng.choice(list(spelled)), rng.choice(list(spelled))
        assert nodes.less(a, b) == (spelled[a] < spelled[b])
        assert nodes.text(a) == spelled[a]


# -- trie ---------------------------------------------------------------------
def trie_of(rows):
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t, role or "", text or ""))

    def order(r):
        md5 = hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
        return (r[0] is not None, r[0] or 0, r[1], r[2][:32], md5)

    own = {c: [x[1:] for x in sorted(r, key=order)] for c, r in convs.items()}
    built = {}
    for c, seq in own.items():
        if c is None:
            built[c] = tuple(seq)
            continue
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        built[c] = tuple(own.get(base, [])[:h] + seq[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[:len(p)] == p] for p in members}
    least = {p: min((c for c in m if c is not None), default=None) for p, m in members.items()}

    @lru_cache(maxsize=None)
    def below(p):
        own_ = (len(members[p]) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        parts = [below(q) for q in children[p]]
        return (sum(x for x, _ in parts) or (0 if parts else 1), own_ + sum(y for _, y in parts))

    out = []
    for p, m in members.items():
        ends = sorted(c for c in m if built[c] == p and c is not None)
        out.append((least[p], len(p), least[p[:-1]] if p else None, len(m), len(children[p]), *below(p), sha(",".join(map(str, ends)))))
    return sorted(out, key=str)


def nodes_of(spark, rows):
    df = spark.createDataFrame(rows, ROWS).withColumn("words", tries.F.lit("clash")).withColumn("seq", tries.F.lit(1))
    trie = tries.prefix_trie(tries.with_shared_heads(tries.sequences(df)))
    assert trie.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted([tuple(r) for r in trie.collect()], key=str)


@pytest.mark.parametrize("parts", [1, 4, 23])
def test_trie_equals_brute_force(spark, parts):
    rng = random.Random(parts)
    rows = odd_conversations(parts)
    for c in range(100, 160):
        n = rng.choice([0, 1, 2, 5, 5, 5])
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["one two", "a b c", "same"])) for t in range(n)]
    rows += [(c, t, "user", f"copy {t} of it") for c in range(200, 240) for t in range(4)]
    rows += [(c, t, "user", f"long {t if t < 70 + c % 3 else c + t}") for c in (301, 302, 303, 307) for t in range(75)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert nodes_of(spark, rows) == trie_of(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_trie_of_nothing_and_of_one(spark):
    assert nodes_of(spark, []) == []
    assert nodes_of(spark, [(40, None, None, None)]) == trie_of([(40, None, None, None)])


def test_sorted_rows_do_not_depend_on_the_band():
    rng = random.Random(6)
    ids = [hashlib.md5(bytes([i])).digest() for i in range(3)]
    rows = list({b"".join(rng.choice(ids) for _ in range(rng.randint(0, 12))) for _ in range(300)})
    want = sorted(rows)
    for band in (1, 2, 5, 32):
        order, lcp = tries.sorted_rows(rows, band)
        assert [rows[i] for i in order] == want
        assert lcp[1:].tolist() == [tries.shared_turns(a, b) for a, b in zip(want, want[1:])]


# -- URLs ---------------------------------------------------------------------
ODD_URLS = [None, "", "no scheme/es/", "http://", "https://example.org/es/a?x=1&y=2", "http://EXAMPLE.org/en/12#t", "http://a.example.org/en/2", "ftp://b.com/de/",
            "http://b.com/fr/x?de", "http://b.net/de/", "http://xorg/", "http://org", "http://org/", "x://y://z.org/p", "http://é.com/fr/ü", "http://u@h.org:80/es/?a://b",
            "http://com?x/de/", "http://b.com#/de/", "http://B.COM/de/x/y.html", "http://c.net/" + "q" * 9000, "http://d.net/1\n2/de/"]


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.split("[/?#]", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split("[?#]", rest[len(host):])[0]


def ruled(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def test_rules_and_parts_of_odd_urls(spark):
    rows = [(i, u) for i, u in enumerate(ODD_URLS)] + [(None, ODD_URLS[4]), (3, ODD_URLS[4]), (3, ODD_URLS[4])]
    df = spark.createDataFrame(rows, "page_id long, url string")
    for name in ("host", "score", "label", "suffix", "html"):
        df = df.withColumn(name, tries.F.lit("clash"))
    got = urls.filter_urls(df, queries.URL_RULES).collect()
    want = sorted([(i, *parts_of(u), ruled(*parts_of(u))[0]) for i, u in rows], key=str)
    assert sorted([(r.page_id, r.host, r.path, r.rule) for r in got], key=str) == want
    assert all(r.verdict == ruled(r.host, r.path)[1] for r in got if r.rule) and all(r.verdict in ("allow", "block") and 0 <= r.score <= 1 for r in got)
    assert urls.filter_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_url_features(spark):
    df = urls.lexical(spark.createDataFrame([(u,) for u in ODD_URLS], "url string"))
    for r in df.collect():
        u = r.url or ""
        host, path = parts_of(r.url)
        query = re.match(r"[^?#]*\?([^#]*)", u)
        query = query.group(1) if query else ""
        share = [u.count(c) / len(u) for c in {c for c in u if 32 < ord(c) < 127}] if u else []
        other = sum(not 32 < ord(c) < 127 for c in u)
        share += [other / len(u)] if other else []
        assert r.entropy == pytest.approx(-sum(p * math.log2(p) for p in share))
        assert (r.length, r.host_length, r.labels) == (len(u), len(host), len(host.split(".")))
        assert r.depth == len(re.findall("/[^/]", path)) and r.hyphens == host.count("-")
        assert r.digit_ratio == pytest.approx(sum(c in "0123456789" for c in u) / max(1, len(u)))
        assert r.parameters == (query.count("&") + 1 if query else 0) and r.query_length == len(query)


def test_trees_learn_labelled_urls(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    rows = [(f"http://{word(6)}.net/{word(5)}/{word(4)}", False) for _ in range(200)]
    rows += [(f"http://{word(5)}-{rng.randint(100, 9999)}.biz/{rng.randint(10**6, 10**9)}?a={word(2)}&b=1&c=2", True) for _ in range(200)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "url string, blocked boolean")
    model = urls.fit(df.limit(300), rounds=5)
    held = urls.judge(df, model).toPandas().tail(100)
    assert ((held.score > 0.5) == held.blocked).mean() > 0.95
    again = urls.judge(df, urls.fit(df.limit(300).repartition(5), rounds=5)).toPandas()
    assert dict(zip(again.url, again.score)) == dict(zip(*urls.judge(df, model).toPandas()[["url", "score"]].values.T))
    only = urls.fit(df.filter("blocked"))
    assert only.trees is None and urls.judge(df, only).agg({"score": "min"}).first()[0] == 1.0


def test_url_filter_stays_in_the_jvm(spark, sf_dir):
    plan = queries.op12_url_filter(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_registered_conversation_queries_on_whole_tables(spark, sf_dir):
    rows = [tuple(r) for r in queries.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in queries.op11_conversation_repair(spark, sf_dir).collect()}
    assert got == {c: repaired(r) for c, r in after_damage(rows).items()}
    assert sorted([tuple(r) for r in queries.op13_prefix_trie(spark, sf_dir).collect()], key=str) == trie_of(rows)
    pages = queries.op12_url_filter(spark, sf_dir).collect()
    assert len(pages) == queries.read(spark, sf_dir, "pages").count()
    assert all((r.host, r.path) == (r.host.lower(), r.path) and r.rule == ruled(r.host, r.path)[0] for r in pages)
