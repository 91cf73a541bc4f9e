"""URL filters: allow and block rules, and gradient-boosted trees on lexical features for what no rule decides.

Column functions and MLlib only: URLs are read once, features are expressions, and suffix statistics are one aggregate
over the labelled URLs that is joined back by suffix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import stored

ALLOW, BLOCK = "allow", "block"
FEATURES = ("length", "host_length", "depth", "labels", "digit_ratio", "entropy", "hyphens", "parameters", "query_length",
            "suffix_rate", "suffix_count", "site_rate", "site_count", "ending_rate", "ending_count")
#: Labelled URLs of which statistics shrink towards the rate of all.
PRIOR = 5.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PRINTABLE = "".join(chr(c) for c in range(33, 127))


# -- parts and rules ----------------------------------------------------------
def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null or without ://."""
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #."""
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def query_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct<rule, verdict> of the longest rule (verdict, host, path) that fits, null without one.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


# -- features -----------------------------------------------------------------
def entropy(text: Column) -> Column:
    """Bits per character; what isn't printable ASCII counts as one character."""
    size = F.length(text)
    plain = F.aggregate(
        F.array(*[F.lit(c) for c in _PRINTABLE]), F.struct(F.lit(0.0).alias("bits"), F.lit(0).alias("seen")),
        lambda acc, c: _counted(acc, size - F.length(F.replace(text, c)), size))
    return F.when(size == 0, 0.0).otherwise(_counted(plain, size - plain["seen"], size)["bits"])


def _counted(acc: Column, times: Column, size: Column) -> Column:
    share = times / size
    bits = F.when(times > 0, -share * F.log2(share)).otherwise(0.0)
    return F.struct((acc["bits"] + bits).alias("bits"), (acc["seen"] + times).alias("seen"))


def lexical(rows: DataFrame, url: str = "url") -> DataFrame:
    """The rows' url, host, path, its lexical features and three suffixes: last label, last two labels, path ending."""
    text = F.coalesce(F.col(url), F.lit(""))
    query = query_of(F.col(url))
    parts = rows.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    host, path = F.col("host"), F.col("path")
    return parts.withColumns({
        "length": F.length(text).cast("double"), "host_length": F.length(host).cast("double"),
        "depth": F.regexp_count(path, F.lit("/[^/]")).cast("double"), "labels": F.size(F.split(host, r"\.")).cast("double"),
        "digit_ratio": F.regexp_count(text, F.lit("[0-9]")) / F.greatest(F.length(text), F.lit(1)), "entropy": entropy(text),
        "hyphens": F.regexp_count(host, F.lit("-")).cast("double"),
        "parameters": F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("&")) + 1).cast("double"),
        "query_length": F.length(query).cast("double"),
        "suffix": F.substring_index(host, ".", -1), "site": F.substring_index(host, ".", -2),
        "ending": F.regexp_extract(path, r"(\.[A-Za-z0-9]{1,8})$", 1)})


_SUFFIXES = ("suffix", "site", "ending")


@dataclass
class UrlModel:
    """Statistics per suffix as stored tables, the rate of blocked URLs, and the trees (None while one class is all there is)."""

    statistics: dict[str, DataFrame]
    rate: float
    trees: GBTClassificationModel | None


def _with_statistics(rows: DataFrame, model: UrlModel) -> DataFrame:
    for name in _SUFFIXES:
        known = model.statistics[name].select(F.col(name).alias("_at"), "_n", "_blocked")
        count = F.coalesce("_n", F.lit(0))
        rows = rows.join(known, F.col(name) == F.col("_at"), "left").withColumns({
            f"{name}_rate": (F.coalesce("_blocked", F.lit(0)) + PRIOR * model.rate) / (count + PRIOR), f"{name}_count": F.log1p(count.cast("double")),
        }).drop("_at", "_n", "_blocked")
    return rows


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def fit(labelled: DataFrame, sample: int = 20_000, rounds: int = 20, depth: int = 4, seed: int = 7) -> UrlModel:
    """A model from labelled URLs (url, blocked boolean; rows with a null label are left out).

    Suffix statistics count all labelled rows. The trees learn from at most `sample` different URLs of each class, those
    of least hash: a documented bound. They are dealt by hash and sorted, so that a fit doesn't depend on partitions.
    """
    rows = labelled.filter(F.col("blocked").isNotNull()).select("url", F.col("blocked").cast("double").alias("label"))
    featured = lexical(rows)
    statistics = {name: stored(featured.groupBy(name).agg(F.count("*").alias("_n"), F.sum("label").alias("_blocked"))) for name in _SUFFIXES}
    n, blocked = statistics["suffix"].agg(F.sum("_n"), F.sum("_blocked")).first()
    model = UrlModel(statistics, (blocked or 0.0) / n if n else 0.0, None)
    if not n or not 0 < blocked < n:
        return model
    by = F.xxhash64("url")
    distinct = featured.groupBy("url").agg(F.max("label").alias("label"))
    picked = [distinct.filter(F.col("label") == c).orderBy(by, "url").limit(sample) for c in (0.0, 1.0)]
    taught = _vectors(_with_statistics(lexical(stored(picked[0].unionByName(picked[1]))), model))
    ready = taught.select("url", "label", "features").repartition(8, "url").sortWithinPartitions("url").persist()
    try:
        model.trees = GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed, maxMemoryInMB=64).fit(ready)
    finally:
        ready.unpersist()
    return model


def judge(rows: DataFrame, model: UrlModel, url: str = "url") -> DataFrame:
    """rows (any columns but the model's own) with score, the estimated chance that the URL is blocked.

    While the labelled URLs have one class only, the score is their rate; without any it is 0.
    """
    featured = _with_statistics(lexical(rows, url), model)
    if model.trees is None:
        return featured.withColumn("score", F.lit(model.rate))
    scored = model.trees.transform(_vectors(featured))
    return scored.withColumn("score", vector_to_array("probability")[1])


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict, score of every row: the longest rule's verdict, else the trees'.

    URLs that a rule decides are the labelled ones. A null URL, or one without ://, has an empty host and path and is
    judged by the trees. Repeated rows and null keys are judged each; other columns are ignored.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    ruled = rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)
    model = fit(rows.select("url", (ruled["verdict"] == BLOCK).alias("blocked")))
    judged = judge(rows.withColumn("ruled", ruled), model)
    return judged.select(
        F.col("key").alias(key), "host", "path", F.col("ruled.rule").alias("rule"),
        F.coalesce("ruled.verdict", F.when(F.col("score") > 0.5, BLOCK).otherwise(ALLOW)).alias("verdict"), "score")
