"""URL filter: host and path rules, and for the rest a ratio of two character language models.

The models are smoothed Markov models of variable order, one of the URLs that a rule accepts, one of those it
rejects. A character is predicted from its longest context that is frequent enough to be kept (up to
`ORDER` characters); the probability of each order is smoothed by that of the next shorter one. The
difference of the log-likelihoods, divided by the URL's length, is compared with a threshold calibrated on
the ruled URLs. All steps are DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexledger.llm.frames import counted, shuffled
from hexledger.session import materialize

# Characters of context at most; n-grams have one more.
ORDER = 4
# An n-gram is kept if it occurs so often, whatever the corpus: the models grow with the ruled URLs.
MIN_COUNT = 4
# The kept n-grams of a length are broadcast up to this many; more are joined by shuffling.
MAX_GRAMS = 1 << 15
# Weight of the next shorter context, in occurrences.
SMOOTHING = 2.0
ALPHABET = 256
# Scores and the threshold are rounded, so that the order in which a sum is built can't turn a verdict.
DIGITS = 6

_BEGIN, _END = "\x02", "\x03"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        """The host or a subdomain of it, and a path that starts with the rule's."""
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def with_parts(pages: DataFrame) -> DataFrame:
    """`pages` with host and path; both are empty for a null url and one without `://`."""
    after = F.expr("CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END")
    host = F.regexp_extract("after", r"^[^/?#]*", 0)
    path = F.regexp_extract("after", r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return (
        pages.drop("host", "path", "after")
        .withColumn("after", F.coalesce(after, F.lit("")))
        .withColumn("host", F.translate(host, upper, lower))
        .withColumn("path", path)
        .drop("after")
    )


def with_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`pages` with host, path, rule and ruled: the longest rule that fits and its verdict, else null.

    `rules` is a parameter of a few rows; of equally long rules the last in order of their text wins.
    """
    parts = with_parts(pages.drop("rule", "ruled"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, str(r)).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return parts.withColumn("rule", rule).withColumn("ruled", verdict)


def _positions(urls: DataFrame) -> DataFrame:
    """One row per character of `u` and one for its end: the n-gram that ends there, with its begin padded."""
    chars = F.split(F.concat(F.lit(_BEGIN * ORDER), "u", F.lit(_END)), "")
    placed = urls.withColumn("chars", chars).withColumn("at", F.explode(F.expr("sequence(0, char_length(u))")))
    gram = F.concat(*(F.get("chars", F.col("at") + k) for k in range(ORDER + 1)))
    return placed.withColumn("gram", gram).drop("chars")


def language_models(ruled: DataFrame) -> DataFrame:
    """(gram, gain): log of the accepting model's probability of the last character over the rejecting one's.

    `ruled` has u (no nulls), ruled, and rows: how often the url occurs.
    """
    counts = materialize(
        _positions(ruled)
        .groupBy("gram")
        .agg(
            F.sum(F.when(F.col("ruled") == "allow", F.col("rows")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("ruled") == "block", F.col("rows")).otherwise(0)).alias("r"),
        ),
        "url-grams",
    )
    # The counts of all lengths follow from those of the longest n-grams.
    lengths = F.explode(F.sequence(F.lit(1), F.lit(ORDER + 1)))
    grams = (
        counts.withColumn("k", lengths)
        .select(F.expr("right(gram, k)").alias("gram"), "k", "a", "r")
        .groupBy("gram", "k")
        .agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        .withColumn("context", F.expr("left(gram, k - 1)"))
    )
    contexts = grams.groupBy("context", "k").agg(F.sum("a").alias("all_a"), F.sum("r").alias("all_r"))
    kept = materialize(
        grams.where(F.col("a") + F.col("r") >= MIN_COUNT).join(shuffled(contexts), ["context", "k"]), "url-kept"
    )
    # An n-gram's probability is built up from its shorter endings, which are all at least as frequent.
    endings = kept.select(F.col("gram").alias("whole"), F.explode(F.sequence(F.lit(1), F.col("k"))).alias("j"))
    endings = endings.withColumn("gram", F.expr("right(whole, j)"))
    steps = endings.join(shuffled(kept), "gram").groupBy("whole").agg(
        F.array_sort(F.collect_list(F.struct("j", "a", "all_a", "r", "all_r"))).alias("steps")
    )

    def probability(n: str, of: str) -> Column:
        return F.aggregate(
            "steps",
            F.lit(1.0 / ALPHABET),
            lambda p, x: (x[n] + F.lit(SMOOTHING) * p) / (x[of] + F.lit(SMOOTHING)),
        )

    gain = F.log(probability("a", "all_a")) - F.log(probability("r", "all_r"))
    return materialize(steps.select(F.col("whole").alias("gram"), gain.alias("gain")), "url-model")


def scores(urls: DataFrame, model: DataFrame) -> DataFrame:
    """(u, score) for the different `u`: the mean gain over its characters and its end.

    Each position takes the longest n-gram that the model has; one it knows nothing of gains 0.
    """
    rows = _positions(urls.select("u").distinct())
    length = F.char_length("gram").alias("k")
    sizes = {r["k"]: r["count"] for r in model.groupBy(length).count().collect()}
    if max(sizes.values(), default=0) > MAX_GRAMS:
        # Different n-grams are looked up once, so that positions are shuffled once and not for each length.
        rows = rows.join(shuffled(_gains(rows.select("gram").distinct(), model, sizes)), "gram")
    else:
        rows = _gains(rows, model, sizes)
    return rows.groupBy("u").agg(F.round(F.sum("gain") / F.count("*"), DIGITS).alias("score"))


def _gains(rows: DataFrame, model: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """`rows` with gain, that of the longest ending of `gram` in the model; `sizes` are its n-grams by length."""
    gains = []
    for k in range(ORDER + 1, 0, -1):
        named = model.where(F.char_length("gram") == k)
        named = named.select(F.col("gram").alias(f"gram{k}"), F.col("gain").alias(f"gain{k}"))
        rows = rows.withColumn(f"gram{k}", F.expr(f"right(gram, {k})"))
        rows = rows.join(counted(named, sizes.get(k, 0), MAX_GRAMS), f"gram{k}", "left")
        gains.append(f"gain{k}")
    return rows.withColumn("gain", F.coalesce(*gains, F.lit(0.0))).drop(*gains, *(f"gram{k}" for k in range(1, ORDER + 2)))


def calibrate(scored: DataFrame) -> float:
    """The threshold that lies equally many standard deviations from the mean of both classes.

    `scored` has ruled and score. With only one class nothing can be told apart: the threshold is such that
    the model's verdict is that class; without any it is 0.
    """
    rows = {
        r["ruled"]: r
        for r in scored.groupBy("ruled")
        .agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("spread"))
        .collect()
    }
    allow, block = rows.get("allow"), rows.get("block")
    if allow is None or block is None:
        return 0.0 if block is None else float("inf")
    both = allow["spread"] + block["spread"]
    if both == 0:
        return round((allow["mean"] + block["mean"]) / 2, DIGITS)
    return round((allow["mean"] * block["spread"] + block["mean"] * allow["spread"]) / both, DIGITS)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`pages` with host, path, rule, score and verdict (allow or block), one row per row.

    A url decided by a rule has a null score. Null and empty URLs are scored by the end of the URL alone.
    Repeated rows are judged alike. Columns that clash with the new names are replaced.
    """
    # Own columns of the input with the names of working columns are set aside meanwhile.
    aside = {c: f"_kept_{c}" for c in pages.columns if c.lower() in ("u", "ruled", "after")}
    ruled = with_rules(pages.drop("score", "verdict").withColumnsRenamed(aside), rules).withColumn(
        "u", F.coalesce("url", F.lit(""))
    )
    known = materialize(
        ruled.where("rule IS NOT NULL").groupBy("u", "ruled").agg(F.count("*").alias("rows")), "ruled-urls"
    )
    model = language_models(known)
    threshold = calibrate(known.join(shuffled(scores(known, model)), "u").select("ruled", "score"))
    of_rest = scores(ruled.where("rule IS NULL"), model)
    by_model = F.when(F.col("score") >= F.lit(threshold), "allow").otherwise("block")
    return (
        ruled.join(shuffled(of_rest), "u", "left")
        .withColumn("score", F.when(F.col("rule").isNull(), F.col("score")))
        .withColumn("verdict", F.coalesce("ruled", by_model))
        .drop("u", "ruled")
        .withColumnsRenamed({kept: c for c, kept in aside.items()})
    )
