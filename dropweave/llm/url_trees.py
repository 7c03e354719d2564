"""URL filter: host rules, and gradient-boosted trees on lexical features for what no rule covers.

Urls that a rule judges are the labelled ones.  Features: length of url, host and path, depth of the path, labels of the
host, share of digits, entropy of the characters, number of parameters, hyphens, and for two host suffixes (last label,
last two) the share of blocked urls among the labelled ones, drawn towards the overall share.  The trees are Spark's
``GBTClassifier``; features, statistics, fitting and scoring are DataFrame operations in the JVM.

Suffix statistics come from all labelled urls: a count per suffix, added up before the shuffle and joined back by suffix, so
a suffix with a third of the rows is a skewed join that adaptive execution splits.  The trees are fitted on the
``TRAINING_ROWS`` labelled urls with the smallest hash of the url, or on all if there are fewer.

Null urls, and urls without ``://``, have an empty host and path and get the method's verdict.  If the labels are missing or
all the same, the method gives that label (allow if there is none).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropweave.llm._learning import HASHES, share
from dropweave.session import stage

TRAINING_ROWS = 20_000
TREES = 12
DEPTH = 4
PRIOR = 20.0
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
LEXICAL = ("url_chars", "host_chars", "path_chars", "depth", "labels", "digit_share", "entropy", "parameters", "hyphens")
FEATURES = (*LEXICAL, "suffix1_rate", "suffix2_rate")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @classmethod
    def of(cls, verdict: str, text: str) -> Rule:
        host, _, path = text.partition("/")
        return cls(verdict, host, f"/{path}")


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*(/[^?#]*)", 1)


def ruled(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does.  Of equally long ones the first counts."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _entropy(text: Column) -> Column:
    """Bits per character, from the runs of the sorted characters."""
    chars = F.array_sort(F.split(text, ""))
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def closed(state: Column) -> Column:
        return state["sum"] + F.when(state["run"] > 1, state["run"] * F.log2(state["run"])).otherwise(0.0)

    def step(state: Column, c: Column) -> Column:
        same = state["c"] == c
        return F.struct(c.alias("c"), F.when(same, state["run"] + 1).otherwise(1.0).alias("run"),
                        F.when(same, state["sum"]).otherwise(closed(state)).alias("sum"))

    size = F.char_length(text).cast("double")
    return F.when(size < 1, 0.0).otherwise(F.log2(size) - F.aggregate(chars, start, step, closed) / size)


def _count(text: Column, chars: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("double")


def features(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with host, path, both suffixes and the lexical features."""
    text, host, path = F.coalesce(F.col(url), F.lit("")), F.col("host"), F.col("path")
    size = F.char_length(text).cast("double")
    return urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).withColumns({
        "url_chars": size, "host_chars": F.char_length(host).cast("double"), "path_chars": F.char_length(path).cast("double"),
        "depth": _count(path, "/"), "labels": _count(host, ".") + F.when(host == "", 0.0).otherwise(1.0),
        "digit_share": _count(text, "0123456789") / F.greatest(size, F.lit(1.0)), "entropy": _entropy(text),
        "parameters": _count(F.substring_index(F.regexp_extract(text, r"(?s)\?(.*)", 1), "#", 1), "=")
        + _count(F.regexp_extract(text, r"(?s)\?([^#]*)", 1), "&"), "hyphens": _count(text, "-"),
        "suffix1": F.substring_index(host, ".", -1), "suffix2": F.substring_index(host, ".", -2)})


def with_suffix_rates(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Adds the share of blocked urls of either suffix; a suffix without labels gets the overall share."""
    total = labelled.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("label"), F.lit(0.0)).alias("rate")).first()
    for suffix in ("suffix1", "suffix2"):
        counts = labelled.groupBy(suffix).agg(
            ((F.sum("label") + PRIOR * total.rate) / (F.count(F.lit(1)) + PRIOR)).alias(f"{suffix}_rate"))
        rows = rows.join(counts, suffix, "left").fillna(float(total.rate), [f"{suffix}_rate"])
    return rows


def fit(labelled: DataFrame, url: str = "url", rows: int = TRAINING_ROWS) -> GBTClassificationModel | float:
    """Trees for ``label`` (1: block), or the one label there is."""
    place = F.pmod(F.xxhash64(url), F.lit(HASHES))
    # The sort sees only a share of the hash values that holds about twice the wanted rows.
    sample = labelled.filter(place < share(2 * rows, labelled.count())).orderBy(place, F.col(url), *FEATURES).limit(rows)
    sample = stage(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        sample.select(F.col("label").cast("double").alias("label"), *FEATURES)).select("label", "features").coalesce(4))
    found = sample.agg(F.min("label").alias("low"), F.max("label").alias("high")).first()
    if found.low is None or found.low == found.high:
        return float(found.low or 0.0)
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=7,
                         stepSize=0.3).fit(sample)


def judge(urls: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Every row with host, path, rule, score (chance of block by the trees) and verdict.

    Columns of ``urls`` with these names are replaced.
    """
    keep = [c for c in urls.columns if c not in {"host", "path", "rule", "score", "verdict"}]
    packed = urls.select(F.struct(*keep).alias("_row"), F.col(url).alias("_url"))
    rows = features(packed, "_url")
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_ruled": verdict})
    labelled = rows.filter("_ruled IS NOT NULL").withColumn("label", (F.col("_ruled") == "block").cast("double"))
    model = fit(with_suffix_rates(labelled, labelled), "_url")
    rows = with_suffix_rates(rows, labelled)
    if isinstance(model, float):
        scored = rows.withColumn("score", F.lit(model))
    else:
        scored = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)).withColumn(
            "score", vector_to_array("probability")[1])
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("_row.*", "host", "path", "rule", "score", F.coalesce("_ruled", own).alias("verdict"))
