"""Contracts at their edges: letters, the space sign, clashing column names, and equal rows without an id."""

import random

import pytest
from llm_brute import words
from pyspark.sql import functions as F

from ladle.llm import bpe, common, decontamination, jaccard, language, privacy, sharding, substrings, token_counts
from ladle.llm.common import joined_hot, partitions, stored
from ladle.llm.queries import public_tokenizers


def test_numerals_are_no_letters(spark, sf_dir):
    taught = common.read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(taught, per_language=20, epochs=1)
    texts = ["\u00bd \u00b2 12", "\u2167 \u2460 _", "12 \u00b2a", "\u4e2d", None, "\u0663"]
    got = [(r.lang_pred, r.score) for r in language.identify(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), model)
           .orderBy("doc_id").collect()]
    assert [g[0] == "und" for g in got] == [not any(c.isalpha() for c in t or "") for t in texts]
    assert all((s == 0.0) == (n == "und") for n, s in got)


def fuzz(seed, signs, many=4000, longest=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, longest))) for _ in range(many)]


def test_token_counts_of_random_strings_equal_the_library(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = fuzz(1, ["a", "b", "the", " ", " ", "\n", "\u2581", "\u2581", "\u00e9", "<s>", "\t", "9", "\u4e2d"])
    rows = token_counts.count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(library.encode(t)) for i, t in enumerate(texts)}


def test_byte_bpe_of_random_strings_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    texts = fuzz(2, ["a", "in", "the", " ", "  ", "\n", "'s", "\u00e9", "<|endoftext|>", "\t", "19", "\u4e2d", "\U0001f600", "!"], longest=25)
    rows = bpe.encode_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, decode=True).collect()
    want = library.encode_batch(texts, add_special_tokens=False)
    assert {r.doc_id: list(r.ids) for r in rows} == {i: w.ids for i, w in enumerate(want)}
    assert {r.doc_id: r.decoded for r in rows} == {i: library.decode(w.ids, skip_special_tokens=False) for i, w in enumerate(want)}


CLASHES = ["_id", "_terms", "_row_key", "_bad", "_key", "_text", "shard", "slot", "_part", "part", "tie", "row", "order_0", "weight", "block", "node"]


@pytest.fixture(scope="module")
def clashing(spark):
    rng = random.Random(12)
    base = words(rng, 60)
    rows = [(i, t) for i, t in enumerate([None, "", base, base, "mail ann@site.org now", words(rng, 40)])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in CLASHES}), base


def test_clashing_names_stay(spark, clashing):
    df, base = clashing
    items = spark.createDataFrame([(1, " ".join(base.split(" ")[5:40]))], "item_id long, text string")

    def same(out, gone=()):
        kept = [c for c in df.columns if c not in gone]
        assert out.columns[:len(kept)] == kept
        assert all(r[c] == f"{c}{r.doc_id}" for r in out.collect() for c in CLASHES if c not in gone)
        return {r.doc_id for r in out.select("doc_id").collect()}

    assert same(privacy.sanitise(df)) == {0, 1, 2, 3, 4, 5}
    assert same(decontamination.clean_documents(df, items)) == {0, 1, 4, 5}
    assert same(jaccard.one_of_each(df)) == {0, 1, 2, 4, 5}
    sharded = sharding.contiguous_shards(df.withColumn("size", F.lit(2)), "size", ["doc_id", "part"], 3)
    assert sharded.columns.count("shard") == 1 and sharded.columns.count("slot") == 1
    assert same(sharded, ("shard", "slot")) == {0, 1, 2, 3, 4, 5}
    assert sorted((r.shard, r.slot) for r in sharded.select("shard", "slot").collect()) == [(s, i) for s in range(3) for i in range(2)]


def test_equal_rows_without_an_id_are_dealt_to_many_blocks(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.range(4000, numPartitions=16).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    assert df.select(common.dealt(64, "doc_id", "text").alias("b")).distinct().count() > 8
    rows = token_counts.count_tokens(df, public_tokenizers.path("piece_bpe_32k.model"))
    assert rows.count() == 4000 and rows.select("n_tokens").distinct().count() == 1
    kept = substrings.remove_repeats(df)
    assert kept.count() == 4000 and kept.select("n_removed", "kept_text").distinct().count() == 1
    assert jaccard.similar_classes(df).filter("n_shingles = 27").count() == 4000


def test_hot_keys_are_joined_where_their_rows_are(spark):
    """A key with a third of all rows joins by broadcast, the others by a shuffle; each row comes once, none of an unknown key."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 1000 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"), "id")
    counts = stored(rows.filter("k is not null and k <> 2").groupBy("k").agg(F.count("*").alias("many"), F.min("id").alias("least")))
    got = joined_hot(rows, counts, "k", "many")
    assert sorted(r.id for r in got.collect()) == [i for i in range(3000) if i % 3 == 0 or (i % 1000 != 1 and i != 2)]
    assert got.columns == ["k", "id", "least"] and got.filter("k = -1 and least = 0").count() == 1000
    assert got.filter("k <> -1 and least <> id").count() == 0
    hot = counts.filter(F.col("many") * (4 * partitions(spark)) > counts.agg(F.sum("many")).first()[0])
    assert hot.count() < 4 * partitions(spark)
