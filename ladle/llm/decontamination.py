"""Benchmark decontamination by spaced seeds. Built-in column and SQL functions only.

A mask such as 110110101 names the places of a run of tokens that count; the others may hold any token, so a seed
survives a substitution there. Seeds of all masks are hashed at every position of benchmark items and documents and
joined. A hit fixes a diagonal (document position less item position), along which all tokens are then compared: a
match scores 1, a substitution costs a penalty, and the best run decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import free_name

#: Two masks of one span, each with six places that count; neither hides the other's substitutions.
MASKS = ("110110101", "101011011")

#: A benchmark with at most this many seeds (16 bytes each) is broadcast; a larger one is joined by shuffle.
BROADCAST_SEEDS = 1_000_000


def tokens(text: str | Column) -> Column:
    """Lower-cased runs of letters and digits; an empty array for null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(F.coalesce(col, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seeds(words: str, masks: tuple[str, ...]) -> Column:
    """Seed hashes of all masks at all positions, mask after mask; none for fewer words than the span.

    The words are bound as a lambda's argument: the optimiser would otherwise put the splitting of the text in place of
    every look-up.
    """
    span = len(masks[0])

    def of(n: int, mask: str, w: Column) -> Column:
        places = [j for j, bit in enumerate(mask) if bit == "1"]
        return F.transform(F.sequence(F.lit(0), F.size(w) - span), lambda i: F.xxhash64(F.lit(n), *[F.get(w, i + j) for j in places]))

    return F.get(F.transform(F.array(words), lambda w: F.when(
        F.size(w) >= span, F.concat(*[of(n, m, w) for n, m in enumerate(masks)]))), 0)


def seeds_of(rows: DataFrame, keys: list[str], masks: tuple[str, ...]) -> DataFrame:
    """keys, seed and position for every mask and position of the rows' column words."""
    span = len(masks[0])
    some = rows.select(*keys, (F.size("words") - (span - 1)).alias("_n"), _seeds("words", masks).alias("_seeds"))
    return (some.select(*keys, "_n", F.posexplode("_seeds").alias("_at", "seed"))
            .select(*keys, "seed", F.expr("cast(_at % _n as int)").alias("position")))


def _best_run(penalty: int) -> Column:
    """(score, matched, first, last) of the best run of an array of (j, hit), by one pass over it."""
    start = "named_struct('cur', 0, 'cm', 0, 'cs', 0, 'score', 0, 'matched', 0, 'first', 0, 'last', -1)"
    step = f"""
        (a, x) -> named_struct(
            'cur', greatest(a.cur, 0) + if(x.hit, 1, {-penalty}),
            'cm', if(a.cur <= 0, 0, a.cm) + if(x.hit, 1, 0),
            'cs', if(a.cur <= 0, x.j, a.cs),
            'score', if(greatest(a.cur, 0) + if(x.hit, 1, {-penalty}) > a.score, greatest(a.cur, 0) + if(x.hit, 1, {-penalty}), a.score),
            'matched', if(greatest(a.cur, 0) + if(x.hit, 1, {-penalty}) > a.score, if(a.cur <= 0, 0, a.cm) + if(x.hit, 1, 0), a.matched),
            'first', if(greatest(a.cur, 0) + if(x.hit, 1, {-penalty}) > a.score, if(a.cur <= 0, x.j, a.cs), a.first),
            'last', if(greatest(a.cur, 0) + if(x.hit, 1, {-penalty}) > a.score, x.j, a.last))
    """
    return F.expr(f"aggregate(_aligned, {start}, {step}, a -> a)")


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_score: int = 13,
             penalty: int = 2, whole: int = 80) -> DataFrame:
    """One row per document and benchmark item that overlap: doc_id, item_id, score, n_matched, n_compared, doc_start,
    item_start (in tokens) of the best run of all diagonals with a hit.

    An overlap has a score (matches less penalty times substitutions) of min_score, or of the whole item if that is
    shorter; or at least `whole` per cent of the whole item's tokens match on the diagonal, so that a short item may have
    substitutions; or it is an item of fewer tokens than a mask's span, which has no seeds, that the document holds
    whole. Null and empty texts and items never match. Items without an id are told apart by text and give one row
    together. Rows of one doc_id give one row per item, the best. Extra columns are left behind. Documents' seeds are not
    shuffled while the benchmark is within BROADCAST_SEEDS, which is counted first.
    """
    base = docs.select(F.col("doc_id"), F.col("text"))
    item = F.when(F.col("item_id").isNotNull(), F.xxhash64("item_id")).otherwise(F.xxhash64(F.lit("no id"), "text"))
    items = benchmark.select("item_id", item.alias("_item"), tokens("text").alias("item_words")).filter(F.size("item_words") >= len(masks[0]))
    item_seeds = seeds_of(items.withColumnRenamed("item_words", "words"), ["_item"], masks).withColumnRenamed("position", "item_position")
    if item_seeds.count() <= BROADCAST_SEEDS:
        item_seeds = F.broadcast(item_seeds)
    read = base.select("doc_id", F.xxhash64("text").alias("_text"), tokens("text").alias("words"))
    diagonals = (seeds_of(read, ["doc_id", "_text"], masks).join(item_seeds, "seed")
                 .groupBy("doc_id", "_text", "_item", (F.col("position") - F.col("item_position")).alias("diagonal"))
                 .agg(F.count("*").alias("n_hits")))
    places = diagonals.groupBy("doc_id", "_text").agg(F.collect_set(F.struct("_item", "diagonal")).alias("_places"))
    found = (
        base.withColumn("_text", F.xxhash64("text")).alias("d")
        .join(places.alias("p"), F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d._text") == F.col("p._text")))
        .select("d.doc_id", tokens("d.text").alias("words"), F.col("p._places").alias("_places"))
        .select("doc_id", "words", F.explode("_places").alias("_place"))
        .select("doc_id", "words", "_place._item", "_place.diagonal")
    )
    n = F.least(F.size("item_words"), F.size("words") - F.col("diagonal"))
    aligned = F.transform(F.sequence(F.greatest(F.lit(0), -F.col("diagonal")), n - 1), lambda j: F.struct(
        j.alias("j"), (F.get(F.col("words"), j + F.col("diagonal")) == F.get(F.col("item_words"), j)).alias("hit")))
    enough = (F.col("_run.score") >= F.least(F.lit(min_score), F.col("_size"))) | (100 * F.col("_hits") >= whole * F.col("_size"))
    best = (
        found.join(items, "_item").withColumn("_aligned", aligned)
        .select("doc_id", "item_id", "diagonal", F.size("item_words").alias("_size"), _best_run(penalty).alias("_run"),
                F.size(F.filter("_aligned", lambda x: x["hit"])).alias("_hits"))
        .filter(enough)
    )
    short = _short_items(base, benchmark, len(masks[0])).select(
        "doc_id", "item_id", "diagonal", F.expr("named_struct('cur', n, 'cm', n, 'cs', 0, 'score', n, 'matched', n, 'first', 0, 'last', n - 1)").alias("_run"))
    top = best.select("doc_id", "item_id", "diagonal", "_run").unionByName(short).groupBy("doc_id", "item_id").agg(F.max_by(
        F.struct("_run", "diagonal"), F.struct("_run.score", "_run.matched", -F.col("diagonal"))).alias("_top"))
    run = "_top._run"
    return top.select(
        "doc_id", "item_id", F.col(f"{run}.score").cast("long").alias("score"), F.col(f"{run}.matched").cast("long").alias("n_matched"),
        (F.col(f"{run}.last") - F.col(f"{run}.first") + 1).cast("long").alias("n_compared"),
        (F.col(f"{run}.first") + F.col("_top.diagonal")).cast("long").alias("doc_start"), F.col(f"{run}.first").cast("long").alias("item_start"))


def _short_items(docs: DataFrame, benchmark: DataFrame, below: int) -> DataFrame:
    """doc_id, item_id, diagonal and n (tokens) of whole items of fewer than `below` tokens, wherever a document holds them."""
    items = benchmark.select("item_id", tokens("text").alias("words")).filter((F.size("words") > 0) & (F.size("words") < below))
    sizes = sorted(r.n for r in items.select(F.size("words").alias("n")).distinct().collect())  # fewer than `below` numbers
    keys = items.select("item_id", F.xxhash64("words").alias("seed"), F.size("words").alias("n")).distinct()

    def runs(w: Column, n: int) -> Column:
        places = F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(i.alias("diagonal"), F.lit(n).alias("n"), F.xxhash64(F.slice(w, i + 1, F.lit(n))).alias("seed")))

    none = F.array().cast("array<struct<diagonal:int,n:int,seed:bigint>>")
    found = F.get(F.transform(F.array("words"), lambda w: F.concat(none, *[runs(w, n) for n in sizes])), 0)
    return (docs.filter(F.lit(bool(sizes))).select("doc_id", tokens("text").alias("words")).select("doc_id", F.explode(found).alias("s"))
            .select("doc_id", "s.*").join(keys, ["seed", "n"]).select("doc_id", "item_id", "diagonal", "n"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, **options) -> DataFrame:
    """docs without those that overlap a benchmark item (see overlaps); all their columns, whatever their names. A null
    doc_id is kept only if no row with a null doc_id overlaps. With substitutions an item is found if one of its seeds is
    free of them."""
    bad = free_name("_bad", docs.columns)
    found = overlaps(docs, benchmark, masks=masks, **options).select(F.col("doc_id").alias(bad)).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col(bad)), "left_anti")
