"""Rules for hosts and paths, and two Markov models of characters for all other URLs.

URLs that a rule allows or blocks are the examples. For each verdict a Markov model of
variable order is counted: the probability of a character after its longest known context,
smoothed towards that of the next shorter context. A URL without a rule is allowed when the
difference of its log-likelihoods per character reaches a threshold calibrated on examples
kept out of the counts.

Rows: a NULL url, or one without ``://``, has an empty host and path, fits no rule and is
judged by the models (NULL as the empty text). Repeated urls are scored once. Without
examples of both verdicts the difference is 0 and the threshold 0, so all are allowed.
Columns of the input pass through, those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textstyle.llm.common import fresh, settle

# Verdict, host, path of each rule.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
PARTS = r"://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START, END = "\x02", "\x03"
RESULTS = ("host", "path", "rule", "verdict")
# Of the examples one part in FOLDS, by the digests of their urls, calibrates the threshold.
FOLDS = 5


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(whole, PARTS, 1), UPPER, LOWER)
    return host, F.regexp_extract(whole, PARTS, 2)


def kept_out(url: str = "url") -> Column:
    digits = F.substring(F.md5(F.col(url).cast("binary")), 1, 7)
    return F.conv(digits, 16, 10).cast("long") % FOLDS == 0


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else NULL; of equal ones, a block."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r))
    cases = [
        F.when(
            ((host == name) | host.endswith(f".{name}")) & path.startswith(start),
            F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, name, start in order
    ]
    return F.coalesce(*cases)


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """One row per character of a url, with the ``order`` characters before it."""
    padded = F.concat(F.lit(START * order), F.col("url"), F.lit(END))
    place = F.sequence(F.lit(1), F.char_length("url") + 1)
    gram = F.transform(place, lambda i: padded.substr(i, F.lit(order + 1)))
    return urls.withColumn("gram", F.explode(gram))


def _models(examples: DataFrame, order: int) -> DataFrame:
    """(gram, allowed, blocked): how often each string of 1 to order + 1 characters ended
    at a character of an allowed and of a blocked example."""
    full = _grams(examples, order).groupBy("gram").agg(
        F.sum(F.when(F.col("verdict") == "allow", 1).otherwise(0)).alias("allowed"),
        F.sum(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("blocked"),
    )
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(order + 1)),
        lambda n: F.col("gram").substr(F.lit(order + 2) - n, n),
    )
    return full.select(F.explode(ends).alias("gram"), "allowed", "blocked").groupBy("gram").agg(
        F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")
    )


def _gram_scores(needed: DataFrame, models: DataFrame, order: int, pull: float) -> DataFrame:
    """(gram, gain): difference of the two log-probabilities of a gram's last character.

    Grams grow from their ends: the probability after a context is that after the next
    shorter one, pulled towards the context's own counts. Each step joins distinct grams,
    of which none has more partners than there are letters.
    """
    contexts = models.groupBy(F.expr("left(gram, char_length(gram) - 1)").alias("context")).agg(
        F.sum("allowed").alias("allowed_before"), F.sum("blocked").alias("blocked_before")
    )
    letters = models.filter(F.char_length("gram") == 1).count()
    shorter = None
    for n in range(1, order + 2):
        grams = needed.select(F.expr(f"right(gram, {n})").alias("gram")).distinct()
        if shorter is None:
            start = F.lit(1.0 / (letters + 1))
            grown = grams.withColumn("allowed_less", start).withColumn("blocked_less", start)
        else:
            grown = grams.join(
                shorter, F.expr(f"right(gram, {n - 1})") == F.col("end")
            ).drop("end")
        grown = grown.join(models, "gram", "left").join(
            contexts, F.expr(f"left(gram, {n - 1})") == F.col("context"), "left"
        )
        chances = [
            ((F.coalesce(kind, F.lit(0)) + pull * F.col(f"{kind}_less"))
             / (F.coalesce(f"{kind}_before", F.lit(0)) + pull)).alias(f"{kind}_less")
            for kind in ("allowed", "blocked")
        ]
        shorter = grown.select(F.col("gram").alias("end"), *chances)
    return shorter.select(
        F.col("end").alias("gram"), (F.ln("allowed_less") - F.ln("blocked_less")).alias("gain")
    )


def url_scores(urls: DataFrame, order: int = 4, pull: float = 2.0) -> DataFrame:
    """(url, score) of distinct urls with the verdict of their rule, NULL without one.

    Grams are counted before they are joined; only the last join has a row per character,
    and Spark splits its frequent grams. The models are written once and read twice.
    """
    examples = urls.filter(F.col("verdict").isNotNull() & ~kept_out())
    models = settle(_models(examples, order), "url-models")
    grams = _grams(urls.select("url"), order)
    gains = settle(
        _gram_scores(grams.select("gram").distinct(), models, order, pull), "url-gains"
    )
    total = F.round(F.sum("gain") / F.count("*"), 6)
    return grams.join(gains, "gram").groupBy("url").agg(total.alias("score"))


def threshold(scored: DataFrame) -> float:
    """The score from which on urls are allowed: where allowed examples among those kept out
    lead blocked ones most, by scores of two digits, halfway down to the next lower score; of
    equal leads the one at the lowest score.

    Two-digit scores bound the rows by the range of the scores, not by the examples.
    """
    calibrating = scored.filter(F.col("verdict").isNotNull() & kept_out())
    bins = calibrating.groupBy(F.round("score", 2).alias("at")).agg(
        F.count(F.when(F.col("verdict") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked"),
    )
    above = Window.orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lead = (
        F.sum("allowed").over(above) * F.sum("blocked").over(everything)
        - F.sum("blocked").over(above) * F.sum("allowed").over(everything)
    )
    lower = F.lead("at").over(Window.orderBy(F.desc("at")))
    best = (
        bins.select("at", lower.alias("lower"), lead.alias("lead"), F.sum("allowed").over(everything).alias("a"),
                    F.sum("blocked").over(everything).alias("b"))
        .filter("a > 0 and b > 0").orderBy(F.desc("lead"), "at").first()
    )
    if not best:
        return 0.0
    return best["at"] if best["lower"] is None else (best["at"] + best["lower"]) / 2


def judge(pages: DataFrame, rules=RULES, order: int = 4, pull: float = 2.0) -> DataFrame:
    """Every page with host, path, rule and verdict, and the score that decided."""
    own = pages.drop(*RESULTS, "score")
    host, path = host_and_path(F.col("url"))
    found = rule_of(F.col("host"), F.col("path"), rules)
    urls = (
        own.select(F.coalesce("url", F.lit("")).alias("url"))
        .distinct()
        .withColumn("host", host).withColumn("path", path)
        .withColumn("verdict", found["verdict"])
        .select("url", "verdict")
    )
    urls = settle(urls, "urls")
    scored = settle(
        url_scores(urls, order, pull).join(urls, "url"), "url-scores"
    )
    limit = threshold(scored)
    scored_url, ruled = fresh(own, "scored_url", "ruled")
    scores = scored.select(F.col("url").alias(scored_url), "score")
    return (
        own.withColumn("host", host).withColumn("path", path)
        .withColumn(ruled, found)
        .join(scores, F.coalesce("url", F.lit("")) == F.col(scored_url), "left")
        .select(
            *own.columns, "host", "path", F.col(ruled)["rule"].alias("rule"),
            F.coalesce(
                F.col(ruled)["verdict"],
                F.when(F.col("score") >= limit, "allow").otherwise("block"),
            ).alias("verdict"),
            "score",
        )
    )
