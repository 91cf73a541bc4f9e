from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_brute import classes, kept_words, letters, overlap_score, personal, sha, words

from ladle.llm import bpe, decontamination, jaccard, language, privacy, quality, queries, sharding, substrings, token_counts, vectors
from ladle.llm.common import Words, grams


def test_word_hashes_tell_words_and_runs_apart():
    import pyarrow as pa

    w = Words(pa.array(["ab cd  ab\ncd", None, "", "AB ab"]))
    assert w.offsets.tolist() == [0, 4, 4, 4, 6]
    assert w.hash[0] == w.hash[2] == w.hash[5] != w.hash[4] and w.hash[1] == w.hash[3] != w.hash[0]
    pairs = grams(w.hash, 2)
    assert pairs[0] == pairs[2] != pairs[1]
    assert len(grams(w.hash, 7)) == 0 and len(grams(w.hash, 5)) == 2
    low = Words(pa.array(["AB ab"]), lower=True)
    assert low.hash[0] == low.hash[1]


def test_top_k_with_ties_gaps_and_odd_vectors(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, rows[3][1]) for i in range(40)] + [(400, None), (401, [float("nan")] * 6), (402, [None] * 6), (403, [float("inf")] * 6),
                                                       (None, [0.5] * 6), (404, [1.0, 2.0]), (420, [0.5, 0.25]), (440, [1e30] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = vectors.integer_vectors(df, "vec_id", "embedding")
    got = {}
    for r in vectors.top_k(v, v.filter("vec_id % 20 = 0"), 20, query_block=7, vector_block=50).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    kept = {i: [max(-2**63, min(2**63 - 1, int(np.floor(64 * x)))) for x in e] for i, e in rows if i is not None and e and all(x is not None and np.isfinite(x) for x in e)}
    for q in [i for i in kept if i % 20 == 0]:
        best = sorted(((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(kept[q], e)))), i) for i, e in kept.items() if i != q and len(e) == len(kept[q])))[:20]
        want = [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
        assert sorted(got.get(q, [])) == want
    assert vectors.top_k(v.limit(0), v.limit(0)).count() == 0


def test_top_k_where_the_id_of_a_query_is_repeated(spark):
    rng = random.Random(11)

    def unit():
        x = np.array([rng.gauss(0, 1) for _ in range(16)])
        return [float(y) for y in x / np.linalg.norm(x)]

    hot = unit()
    rows = [(20, hot)] * 30 + [(20, unit()) for _ in range(20)] + [(i, unit()) for i in range(21, 321)]
    v = vectors.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    kept = [(i, [int(np.floor(64 * x)) for x in e]) for i, e in rows]
    for block in (8192, 40):
        got = {}
        for r in vectors.top_k(v, v.filter("vec_id % 20 = 0"), 20, vector_block=block).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        for q in range(20, 321, 20):
            asking = {tuple(e) for i, e in kept if i == q}
            best = sorted((-sum(a * b for a, b in zip(x, e)), i) for x in asking for i, e in kept if i != q)[:20]
            assert sorted(got.get(q, [])) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]


def test_repeated_spans(odd, odd_rows, none):
    rows = [(r[0], r[1]) for r in odd_rows]
    want = kept_words(rows)
    got = substrings.remove_repeats(odd).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == Counter((i, *want[i, t]) for i, t in rows)
    assert substrings.remove_repeats(none).count() == 0


def test_repeated_spans_in_random_texts(spark):
    rng = random.Random(3)
    for trial in range(3):
        pool = [words(rng, rng.choice((15, 25, 40))) for _ in range(6)]
        rows = [(i, " ".join(rng.choice((rng.choice(pool), words(rng, rng.randint(1, 12)), "a b " * 15)) for _ in range(6))) for i in range(60)]
        want = kept_words(rows)
        got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
        assert {(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got} == {(i, *want[i, t]) for i, t in rows}


def test_similar_classes(odd, odd_rows, none):
    rows = [(r[0], r[1]) for r in odd_rows]
    got = jaccard.similar_classes(odd).collect()
    assert Counter(tuple(r) for r in got) == Counter(classes(rows))
    assert jaccard.similar_classes(none).count() == 0
    kept = jaccard.one_of_each(odd, 4, 85)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c[2] for c in classes(rows) if c[2] is not None})
    assert kept.columns == odd.columns


def test_similar_classes_of_chains_and_families(spark):
    rng = random.Random(8)
    rows = []
    for family in range(6):
        base = words(rng, rng.choice((12, 40, 150))).split(" ")
        for _ in range(25):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                text[rng.randrange(len(text))] = words(rng, 1)
            rows.append((len(rows), " ".join(text)))
            if rng.random() < 0.3:
                base = text  # the family wanders, so that links form chains
    passage = words(rng, 40)
    rows += [(len(rows) + i, words(rng, 20) + " " + passage + " " + words(rng, 20)) for i in range(30)]
    got = jaccard.similar_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {tuple(r) for r in got} == set(classes(rows))


def test_queries_of_a_large_group_are_cut(spark, monkeypatch):
    """A third of all rows just under the threshold of their template: parts and cuts of two rows lose no link."""
    monkeypatch.setattr(jaccard, "PART", 2)
    rng = random.Random(12)
    base = words(rng, 60).split(" ")
    rows = []
    for i in range(40):
        text = list(base)
        for _ in range(rng.randint(1, 4)):
            text[rng.randrange(len(text))] = words(rng, 1)
        rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + i, words(rng, 30)) for i in range(80)]
    got = jaccard.similar_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == set(classes(rows))


def test_groups_are_opened_where_their_token_union_qualifies(spark):
    """Two groups that only the token-group matrix can join: their least nodes aren't linked, two members are."""
    rng = random.Random(2)
    base = words(rng, 100).split(" ")

    def changed(*at):
        return " ".join("q" + str(i) if i in at else w for i, w in enumerate(base))

    texts = [changed(*range(a, a + 2)) for a in range(0, 96, 3)] + [changed(a, a + 40) for a in range(0, 50, 7)]
    rows = list(enumerate(texts))
    got = jaccard.similar_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == set(classes(rows))


def test_token_counts_equal_the_library(odd, odd_rows, none):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    want = Counter((r[0], len((r[1] or "").encode()), len(m.encode(r[1] or ""))) for r in odd_rows)
    assert Counter(tuple(r) for r in token_counts.count_tokens(odd, path).collect()) == want
    assert token_counts.count_tokens(none, path).count() == 0


def test_bpe_equals_the_library(odd, odd_rows, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rows = bpe.encode_documents(odd, path, decode=True)
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows.collect())
    want = Counter()
    for r in odd_rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        want[r[0], tuple(ids), t.decode(ids, skip_special_tokens=False)] += 1
    assert got == want
    assert bpe.encode_documents(none, path).count() == 0
    again = bpe.decode_documents(rows.drop("decoded"), path)
    assert again.filter("decoded <> coalesce(text, '')").count() == 0


def test_pair_index_merges_runs_like_single_words():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    v, t = bpe.ByteBpe(path), Tokenizer.from_file(path)
    rng = random.Random(4)
    some = ["".join(rng.choice("aabehnt ='0é中") for _ in range(rng.randint(1, 40))) for _ in range(400)] + ["a" * n for n in range(1, 40)]
    for text in some:
        ids, _ = v.encode_words(v.pre_tokens(text))
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids


def test_broken_ids_decode_with_replacement(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    v = bpe.ByteBpe(path)
    half = int(v.of_byte[0xC3])
    df = spark.createDataFrame([(1, [half]), (2, None), (3, [-1, 99_999_999]), (4, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode_documents(df, path).collect()} == {1: "�", 2: None, 3: "", 4: ""}


def test_shards(odd, odd_rows, none):
    got = sharding.shard_documents(odd, 4).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = sorted(((r.doc_id is not None, r.doc_id or 0), r.shard) for r in got)
    assert [s for _, s in order] == sorted(s for _, s in order)
    assert sharding.shard_documents(none).count() == 0


def test_shards_are_near_equal(spark, sf_dir):
    rows = queries.op10_contiguous_shards(spark, sf_dir).collect()
    sums, most = Counter(), max(r["size"] for r in rows)
    for r in rows:
        sums[r.shard] += r["size"]
    assert len(sums) == 8 and max(sums.values()) - min(sums.values()) <= 2 * most


def test_personal_data_spans(odd, odd_rows, none):
    got = Counter((r.doc_id, r.base, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in privacy.find_personal_data(odd).collect())
    want = Counter()
    for r in odd_rows:
        spans = personal(r[1])
        n = Counter(k for k, _, _ in spans)
        want[r[0], ",".join(f"{k}:{s}:{e}" for k, s, e in spans), n["email"], n["ip"], n["card"], n["phone"]] += 1
    assert got == want
    assert privacy.find_personal_data(none).count() == 0 and privacy.sanitise(none).count() == 0


def test_base_patterns_on_random_strings():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice(" +-.@()0123456789ab1.") for _ in range(rng.randint(1, 60)))
        assert privacy.base_spans(text) == personal(text), text
    assert privacy.base_spans("a" * 200_000 + "@" + "1" * 200_000) == []


def test_terms_that_give_an_entity_away(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, 40)) for i in range(300)]
    rows += [(1000 + i, f"{words(rng, 9)} {words(rng, 3)} Quintana ask ann@site.org {words(rng, 12)}") for i in range(6)]
    rows += [(2000 + i, "same text Copycat mail bob@site.org every time") for i in range(6)]  # one surrounding: no evidence
    rows += [(3000 + i, f"{words(rng, 8)} ask {words(rng, 8)}") for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [(t.start, t.end, t.action) for t in r.terms or []] for r in privacy.find_personal_data(df).collect()}
    for i, text in rows:
        at = text.find("Quintana")
        assert found[i] == ([(at, at + 8, "remove")] if 1000 <= i < 2000 else [])
    clean = {r.doc_id: r.text for r in privacy.sanitise(df).collect()}
    assert all("Quintana" not in t and "@" not in t for t in clean.values()) and "[EMAIL]" in clean[1000]
    assert all(clean[i] == t for i, t in rows if i < 300)


def test_terms_of_values_seen_once_and_far_from_them(spark):
    rng = random.Random(12)
    rows = [(i, words(rng, 40)) for i in range(300)]
    rows += [(1000 + i, f"Quintana {words(rng, 30)} ask p{i}@site.org {words(rng, 12)}") for i in range(8)]  # each value once
    rows += [(1100, f"{words(rng, 9)} Quintana {words(rng, 9)} quintana")]  # no value at all
    rows += [(2000 + i, f"Tessaly {words(rng, 30)} 10.1.2.3 {words(rng, 12)}") for i in range(2)]  # a value in two documents
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [(t.start, t.end) for t in r.terms or []] for r in privacy.find_personal_data(df).collect()}
    for i, text in rows:
        for name in ("quintana", "tessaly"):
            places = [(n, n + len(name)) for n in range(len(text)) if text.lower().startswith(name, n)]
            assert set(places) <= set(found[i])
    assert all(not found[i] for i in range(300))


def test_rows_of_one_id_are_masked_by_their_own_text(spark):
    rng = random.Random(13)
    rows = [(i, words(rng, 40)) for i in range(300)]
    for key in (7000, None):
        rows += [(key, f"{words(rng, 8)} Quintana ask ann@site.org {words(rng, 12)}") for _ in range(6)]
    clean = privacy.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(clean) == len(rows) and all("Quintana" not in r.text and "@" not in r.text for r in clean)
    assert sum("[EMAIL]" in r.text for r in clean) == 12


def test_benchmark_overlaps(spark, none):
    rng = random.Random(7)
    items = [(i, words(rng, n)) for i, n in enumerate((9, 12, 15, 30, 60))] + [(9, None), (10, "too short"), (None, words(rng, 20))]
    docs = [(0, None), (1, ""), (2, words(rng, 100))]
    for i, text in items[:5]:
        docs.append((10 + i, f"{words(rng, 20)}, {text.upper()}. {words(rng, 20)}"))
    w = items[4][1].split(" ")
    docs.append((20, words(rng, 5) + " " + " ".join("zz" if n % 9 == 4 else x for n, x in enumerate(w))))
    docs += [docs[-1], (21, items[3][1][:60]), (None, items[3][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as words", "'y' as item_id")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.overlaps(d, b).collect()}
    want = {}
    for i, t in docs:
        for j, s in items:
            a, c = letters(t), letters(s)
            if c and (score := overlap_score(a, c)):
                want[i, j] = score
    assert got == want and (20, 4) in got
    kept = decontamination.clean_documents(d, b)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in want} and kept.columns == d.columns
    assert decontamination.overlaps(none, b).count() == 0 and decontamination.overlaps(d, b.limit(0)).count() == 0


def test_short_and_nameless_benchmark_items_with_substitutions(spark):
    rng = random.Random(15)
    sizes = ((15, (7,)), (16, (5, 10)), (21, (5, 10, 15)), (9, (1,)), (5, ()))
    items = [(i, words(rng, n)) for i, (n, _) in enumerate(sizes)] + [(None, words(rng, 20)), (None, words(rng, 18))]
    docs = [(100, words(rng, 80)), (101, words(rng, 10) + " " + " ".join(items[0][1].split(" ")[:10]))]
    for i, (_, changed) in enumerate(sizes):
        text = " ".join("zz" if n in changed else x for n, x in enumerate(items[i][1].split(" ")))
        docs.append((i, f"{words(rng, 20)} {text} {words(rng, 20)}"))
    docs += [(10 + i, f"{words(rng, 20)} {t}") for i, (_, t) in enumerate(items[5:])]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {r.doc_id for r in decontamination.clean_documents(d, b).collect()} == {100, 101}
    found = {(r.doc_id, r.item_id): r for r in decontamination.overlaps(d, b).collect()}
    assert {k: r.score for k, r in found.items() if k[1] is not None} == {(i, i): overlap_score(letters(docs[2 + i][1]), letters(items[i][1])) for i in range(5)}
    assert (found[4, 4].score, found[4, 4].doc_start, found[4, 4].item_start, found[4, 4].n_compared) == (5, 20, 0, 5)
    decontamination.BROADCAST_SEEDS, bound = 0, decontamination.BROADCAST_SEEDS  # the shuffled join gives the same
    try:
        assert {(r.doc_id, r.item_id): r for r in decontamination.overlaps(d, b).collect()} == found
    finally:
        decontamination.BROADCAST_SEEDS = bound


def test_language(spark, sf_dir, odd, none):
    rows = queries.op1_language(spark, sf_dir).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    model = language.fit(odd)
    got = language.identify(odd, model)
    assert got.count() == odd.count() and {r.lang_pred for r in got.filter("text is null or trim(text) = ''").collect()} == {"und"}
    empty = language.fit(none)
    assert {(r.lang_pred, r.score) for r in language.identify(odd, empty).collect()} == {("und", 0.0)}
    assert language.identify(none, model).count() == 0


def test_ftrl_is_sparse_and_temperature_calibrates():
    rng = np.random.default_rng(0)
    model = language.Ftrl(50, 2, l1=0.5)
    for _ in range(400):
        y = int(rng.integers(2))
        at = np.array([y, *(2 + rng.choice(48, 4, replace=False))])
        model.learn(at, np.ones(5) / 2, y)
    w = model.weights()
    assert (w == 0).mean() > 0.3 and w[0, 0] > w[0, 1] and w[1, 1] > w[1, 0]
    logits = rng.normal(size=(500, 3))
    p = language.softmax(logits / 4)
    labels = np.array([rng.choice(3, p=row) for row in p])
    assert language.temperature(logits, labels) == pytest.approx(4, rel=0.6)


def test_quality(spark, sf_dir, odd, none):
    rows = queries.op8_quality(spark, sf_dir).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    some = [r for r in rows if r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in some) >= 0.9 * len(some)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    labels = spark.createDataFrame([(5, 1), (6, 0), (7, 1), (7, None), (None, 1), (99, 0)], "doc_id long, quality int")
    model = quality.fit(odd, labels)
    assert quality.score_documents(odd, model).count() == odd.count()
    unlearned = quality.fit(none, labels)
    assert {r.score for r in quality.score_documents(odd, unlearned).select("score").collect()} == {0.5}
    assert quality.score_documents(none, model).count() == 0


def test_token_count_of_hash_queries(spark, sf_dir):
    """Digest columns of the registered queries follow the operators' outputs."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op9_byte_bpe(spark, sf_dir).collect():
        assert r.decoded_sha256 == sha(docs[r.doc_id])
