"""Operator 9, URL filters; DataFrame operations only.

Rules by host and path come first. URLs without a rule are judged by two
character language models, of the URLs that rules allow and of those that rules
block: smoothed Markov models whose order varies from position to position, up to
``ORDER`` - 1 characters of context, as far as the n-gram has been seen often
enough. The mean over all positions of the log-likelihood difference is the
score, and a threshold calibrated on held-out ruled URLs turns it into a verdict.

An n-gram seen ``MIN_GRAMS`` times enters a model, at every size. So the models grow
with the input: they are joined with the distinct n-grams of the URLs, and these with
the positions. N-grams that a thousandth of all positions have, such as those every
URL begins with, are under a thousand and are joined by broadcast, the others by
a shuffle.

Null and empty URLs without a rule are blocked. A URL without ``://`` has empty
host and path, fits no rule, and is judged by its characters. Without ruled URLs
of both kinds all others score 0 and are allowed. Repeated URLs get the same
verdict and count once in the models. An empty table gives no rows, and columns
other than the key and the URL are not read. A URL makes a row for each of its
characters, so a very long one is work of its length, dealt out by n-gram.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.stages import Shared

ORDER = 5
MIN_GRAMS = 2
# n-grams with more than this part of all positions are broadcast: fewer than its inverse.
HEAVY = 1e-3
# Weight of the next lower order, in observations.
SMOOTHING = 2.0
# Characters that the lowest order gives a share to.
ALPHABET = 256.0
# Log-likelihoods are summed as whole millionths, so that sums have no order.
MICRO = 1_000_000
# Scores are compared in steps of 0.02 from -4 to 4.
BIN = 20_000
BINS = 200
_START, _END = "\u0001", "\u0002"
# First hex digits of a URL's MD5 that hold it out for calibration.
HELD_OUT = ("0", "1", "2")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def ascii_lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _positions(urls: DataFrame) -> DataFrame:
    """A row for each character of each URL, and for its end, with its context."""
    padded = F.concat(F.lit(_START * (ORDER - 1)), ascii_lower(F.col("url")), F.lit(_END))
    grams = F.transform(
        F.sequence(F.lit(1), F.length("url") + 1), lambda i: F.substring(F.col("padded"), i, F.lit(ORDER))
    )
    return urls.withColumn("padded", padded).withColumn("gram", F.explode(grams)).drop("padded")


def train_models(ruled: DataFrame, shared: Shared) -> list[DataFrame]:
    """For each order a table (gram, llr): the log-likelihood difference of its last
    character after the others, in millionths. ``ruled`` has url and verdict."""
    allowed = (F.col("verdict") == "allow").cast("long")
    counts = shared.write(
        _positions(ruled).groupBy("gram").agg(F.sum(allowed).alias("a"), F.sum(1 - allowed).alias("b")),
        "grams",
    )
    models: list[DataFrame] = []
    lower = None
    for order in range(1, ORDER + 1):
        grams = counts.groupBy(F.right("gram", F.lit(order)).alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        contexts = counts.groupBy(
            F.left(F.right("gram", F.lit(order)), F.lit(order - 1)).alias("context")
        ).agg(F.sum("a").alias("all_a"), F.sum("b").alias("all_b"))
        known = (
            grams.filter(F.col("a") + F.col("b") >= MIN_GRAMS)
            .withColumn("context", F.left("gram", F.lit(order - 1)))
            .join(contexts, "context")
        )
        if lower is None:
            known = known.withColumn("pa_lower", F.lit(1 / ALPHABET)).withColumn("pb_lower", F.lit(1 / ALPHABET))
        else:
            below = lower.select(F.col("gram").alias("shorter"), F.col("pa").alias("pa_lower"), F.col("pb").alias("pb_lower"))
            known = known.withColumn("shorter", F.right("gram", F.lit(order - 1))).join(below, "shorter")

        def probability(side: str) -> Column:
            return (F.col(side) + SMOOTHING * F.col(f"p{side}_lower")) / (F.col(f"all_{side}") + SMOOTHING)

        lower = shared.write(
            known.withColumn("pa", probability("a"))
            .withColumn("pb", probability("b"))
            .select("gram", "pa", "pb", F.round(F.log(F.col("pa") / F.col("pb")) * MICRO).cast("long").alias("llr")),
            f"order-{order}",
        )
        models.append(lower.select("gram", "llr"))
    return models


def score_urls(urls: DataFrame, models: list[DataFrame], shared: Shared) -> DataFrame:
    """(url, bin) of distinct URLs: the mean difference by position, in bins."""
    # Dealt out first: the distinct URLs may lie in one small file.
    rows = _positions(urls.select("url").repartition("url"))
    grams = shared.write(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n_gram")), "distinct")
    often = F.col("n_gram") > HEAVY * (grams.agg(F.sum("n_gram")).first()[0] or 0)
    for order, model in enumerate(models, 1):
        own = model.select(F.col("gram").alias(f"gram_{order}"), F.col("llr").alias(f"llr_{order}"))
        grams = grams.withColumn(f"gram_{order}", F.right("gram", F.lit(order))).join(own, f"gram_{order}", "left")
    longest = F.coalesce(*(F.col(f"llr_{order}") for order in range(len(models), 0, -1)), F.lit(0))
    judged = shared.write(grams.select("gram", longest.alias("llr"), often.alias("often")), "judged")
    heavy, light = (judged.filter(c).drop("often") for c in ("often", "not often"))
    of_heavy = rows.join(F.broadcast(heavy), "gram")
    others = rows.join(F.broadcast(heavy.select("gram")), "gram", "left_anti")
    found = of_heavy.unionByName(others.join(light, "gram"))
    summed = found.groupBy("url").agg(F.sum("llr").alias("total"), F.count(F.lit(1)).alias("n"))
    step = F.floor(F.col("total") / (F.col("n") * float(BIN))).cast("int")
    return summed.select("url", F.greatest(F.lit(-BINS), F.least(F.lit(BINS), step)).alias("bin"))


def calibrate(scored: DataFrame) -> int:
    """The least bin to allow: best balanced accuracy on (bin, verdict), lowest of equals.

    At most 2 * BINS + 1 rows are ranked. Without both verdicts it is bin 0.
    """
    allowed = (F.col("verdict") == "allow").cast("long")
    bins = scored.groupBy("bin").agg(F.sum(allowed).alias("a"), F.sum(1 - allowed).alias("b"))
    everything = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        bins.withColumn("all_a", F.sum("a").over(everything))
        .withColumn("all_b", F.sum("b").over(everything))
        .withColumn("a_below", F.coalesce(F.sum("a").over(below), F.lit(0)))
        .withColumn("b_below", F.coalesce(F.sum("b").over(below), F.lit(0)))
        .filter("all_a > 0 and all_b > 0")
        .withColumn("balance", (F.col("all_a") - F.col("a_below")) * F.col("all_b") + F.col("b_below") * F.col("all_a"))
    )
    best = ranked.orderBy(F.col("balance").desc(), "bin").first()
    return best["bin"] if best else 0


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """For each row: ``key``, ``host``, ``path``, ``rule``, ``verdict``."""
    shared = Shared(pages.sparkSession, "urls")
    host, path = host_and_path(F.col("url"))
    name, verdict = best_rule(F.col("host"), F.col("path"), rules)
    ruled = (
        pages.select(F.col(key), F.col(url).alias("url"))
        .withColumn("host", host)
        .withColumn("path", path)
        .withColumn("rule", name)
        .withColumn("ruled", verdict)
    )
    urls = shared.write(
        ruled.filter("url <> ''").select("url", F.col("ruled").alias("verdict")).distinct(), "urls"
    )
    held_out = F.left(F.md5("url"), F.lit(1)).isin(*HELD_OUT)
    models = train_models(urls.filter(F.col("verdict").isNotNull() & ~held_out), shared)
    scored = shared.write(score_urls(urls, models, shared), "scores")
    least = calibrate(urls.filter(F.col("verdict").isNotNull() & held_out).join(scored, "url"))
    judged = F.when(F.col("bin") >= least, "allow").otherwise("block")
    return ruled.join(scored, "url", "left").select(
        F.col(key), "host", "path", "rule", F.coalesce("ruled", judged).alias("verdict")
    )
