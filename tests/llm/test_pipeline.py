from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from llm_brute import best_overlap, classes, letters, personal
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_on_the_small_tables(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [letters(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for n, (name, f) in enumerate(corpus_pipeline.STAGES):
        out = f(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / str(n)))
        new = spark.read.parquet(str(tmp_path / str(n)))
        assert new.columns[:5] == COLUMNS if n == 4 else new.columns == COLUMNS
        a, b = docs.collect(), new.collect()
        before, after = {r.doc_id: r for r in a}, {r.doc_id: r for r in b}
        if n == 0:
            good = [i for i in before if label.get(i) == 1]
            assert sum(i in after for i in good) >= 0.98 * len(good)
        if n == 1:
            want = {c for _, _, c in classes([(r.doc_id, r.text) for r in a], 5, 80)}
            assert set(after) == want
        if n == 2:
            bad = {i for i, r in before.items() for item in bench if len(item) >= 9 and best_overlap(letters(r.text), item) >= 13}
            assert set(after) == set(before) - bad and bad
        if n == 3:
            assert set(after) == set(before) and not any(personal(r.text) for r in b)
            assert all(after[i].text == r.text for i, r in before.items() if not personal(r.text))
            assert all(r.n_chars == len(r.text) for r in b)
        if n == 4:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            assert all(list(r.ids) == t.encode(before[i].text, add_special_tokens=False).ids and r.text == before[i].text for i, r in after.items())
        docs = new


def test_stages_take_odd_rows(spark, sf_dir, odd):
    rows = odd.select(*COLUMNS)
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, rows, sf_dir).count() > 0
        assert f(spark, rows.limit(0), sf_dir).count() == 0
    kept = stage("personal data")(spark, rows, sf_dir)
    assert kept.count() == rows.count() and kept.filter(F.col("text").isNull()).count() == 2


def test_registered(sf_dir):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {x[:x.index("_") + 1] for x in names if x.startswith("op") and x[2].isdigit()}
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()
