"""URL filter: host and path rules, and a character language-model ratio.

Addresses that a rule decides are the examples: one variable-order Markov model
of characters is counted on allowed, one on blocked ones. The probability of a
character after up to four others is smoothed towards the shorter context by the
number of different characters seen (Witten-Bell), down to a uniform share. The
score of an address is the mean over its characters of the log ratio of the two
models. A fifth of the examples is left out of the counts and sets the cut where
both kinds are told apart best.

Everything is a join or an aggregate over grams with DataFrame functions; counts
are combined map-side, and all examples count. Rules outrank the model.

The rules see host and path, the model the whole address with its scheme, query
and fragment. A null address, or one without `://`, has an empty host and path. A
null counts as the empty address, which scores 0 and is allowed if the cut is at or
below 0. Without examples of both kinds every address without a rule is allowed.
Repeated rows get equal verdicts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.scale import spread_join, stage

# (host, path, verdict): the host and its subdomains, paths that start alike.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
ORDER = 4
ALPHABET = 256
# Scores per cut step; the cut is found on counts per step.
STEPS_PER_UNIT = 100
SCORE_DIGITS = 9

_PAD = "\u0002"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    address = F.coalesce(url, F.lit(""))
    place = F.instr(address, "://")
    rest = F.when(place > 0, F.substr(address, place + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"(?s)^[^?#]*", 0)
    return F.translate(host, _LOWER.upper(), _LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, outcome in sorted(rules, key=lambda rule: len(rule[0]) + len(rule[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        text = F.when(fits, F.lit(name + start)).otherwise(text)
        verdict = F.when(fits, F.lit(outcome)).otherwise(verdict)
    return text, verdict


def grams_of(text: Column) -> Column:
    """For each character, the character with the ORDER before it."""
    padded = F.concat(F.lit(_PAD * ORDER), text)
    return F.transform(
        F.sequence(F.lit(1), F.length(text)), lambda place: F.substr(padded, place, F.lit(ORDER + 1))
    )


def model_counts(examples: DataFrame) -> DataFrame:
    """(gram, allow, block) for grams of 1 to ORDER + 1 characters.

    `examples` has rows of (text, allow, block) with the examples of each kind.
    """
    grams = examples.filter(F.length("text") > 0).select(
        F.explode(grams_of(F.col("text"))).alias("full"), "allow", "block"
    )
    # Full grams are counted first; shorter ones are sums of those.
    full = grams.groupBy("full").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    return (
        full.select(
            F.explode(F.transform(F.sequence(F.lit(1), F.lit(ORDER + 1)), lambda size: F.substr(F.col("full"), F.lit(ORDER + 2) - size, size))).alias("gram"),
            "allow",
            "block",
        )
        .groupBy("gram")
        .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    )


def gram_scores(full: DataFrame, counts: DataFrame) -> DataFrame:
    """(full, ratio): log ratio of the last character after the others.

    `full` has distinct full grams. Unseen ones fall back to shorter contexts.
    """
    kinds = ("allow", "block")
    sums = [F.sum(kind).alias(f"{kind}_total") for kind in kinds]
    sums += [F.sum((F.col(kind) > 0).cast("long")).alias(f"{kind}_kinds") for kind in kinds]
    contexts = (
        counts.filter(F.length("gram") > 1)
        .groupBy(F.substr("gram", F.lit(1), F.length("gram") - 1).alias("context"))
        .agg(*sums)
    )
    # Single characters share the empty context: one row of totals, no join.
    empty = counts.filter(F.length("gram") == 1).agg(*sums).first().asDict()
    levels = full.select(
        "full",
        F.explode(F.sequence(F.lit(1), F.lit(ORDER + 1))).alias("size"),
    ).withColumn("gram", F.substr("full", F.lit(ORDER + 2) - F.col("size"), F.col("size")))
    # Their key, the full gram, is longer than any context, so it meets none.
    single = F.col("size") == 1
    levels = levels.withColumn(
        "context", F.when(single, F.col("full")).otherwise(F.substr("gram", F.lit(1), F.col("size") - 1))
    )
    # Grams grow with the addresses, and a few MB of files are many times that in a
    # driver which builds a broadcast of them: they are always merged.
    facts = levels.join(counts.hint("merge"), "gram", "left").join(contexts.hint("merge"), "context", "left")
    for name, total in empty.items():
        facts = facts.withColumn(name, F.when(single, F.lit(total or 0)).otherwise(F.col(name)))
    names = [*kinds, *empty]
    folded = facts.groupBy("full").agg(
        F.sort_array(
            F.collect_list(F.struct("size", *[F.coalesce(name, F.lit(0)).cast("double").alias(name) for name in names]))
        ).alias("levels")
    )

    def probability(kind: str) -> Column:
        return F.aggregate(
            "levels",
            F.lit(1.0 / ALPHABET),
            lambda lower, level: F.when(
                level[f"{kind}_total"] > 0,
                (level[kind] + level[f"{kind}_kinds"] * lower) / (level[f"{kind}_total"] + level[f"{kind}_kinds"]),
            ).otherwise(lower),
        )

    return folded.select("full", (F.log(probability("allow")) - F.log(probability("block"))).alias("ratio"))


def best_cut(scored: DataFrame) -> float:
    """The cut that keeps most of the allowed and drops most of the blocked share.

    `scored` has (score, allow, block). Scores are counted per step first, so the
    driver gets one row per step; of equal cuts the lowest is taken.
    """
    steps = (
        scored.groupBy(F.floor(F.col("score") * STEPS_PER_UNIT).alias("step"))
        .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        .orderBy("step")
        .collect()
    )
    allow, block = sum(row["allow"] for row in steps), sum(row["block"] for row in steps)
    if not allow or not block:
        return 0.0
    best, cut, kept, dropped = 1.0, None, allow, 0
    for row in steps:
        if cut is None or kept / allow + dropped / block > best:
            best, cut = kept / allow + dropped / block, row["step"] / STEPS_PER_UNIT
        kept, dropped = kept - row["allow"], dropped + row["block"]
    return float(cut)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row; rules, then the model."""
    host, path = host_and_path(F.col("url"))
    addresses = pages.select(
        F.col("page_id").alias("page_id"),
        host.alias("host"),
        path.alias("path"),
        F.coalesce(F.col("url"), F.lit("")).alias("text"),
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    addresses = addresses.select("page_id", "host", "path", "text", rule.alias("rule"), verdict.alias("_verdict"))
    # Equal addresses are scored once. The staged file may be a single one: its grams
    # are spread over all tasks.
    texts = stage(
        addresses.groupBy("text")
        .agg(
            F.sum((F.col("_verdict") == "allow").cast("long")).alias("allow"),
            F.sum((F.col("_verdict") == "block").cast("long")).alias("block"),
            F.count("*").alias("rows"),
        )
        .select(
            "text", F.coalesce("allow", F.lit(0)).alias("allow"), F.coalesce("block", F.lit(0)).alias("block"), "rows"
        ),
        "addresses",
    ).repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), "text")
    left_out = F.pmod(F.xxhash64("text", F.lit("held")), F.lit(5)) == 0
    examples = texts.filter(~left_out & (F.col("allow") + F.col("block") > 0))
    places = texts.filter(F.length("text") > 0).select("text", F.explode(grams_of(F.col("text"))).alias("full"))
    # A gram counts as often as the text has it, so few rows meet a common gram.
    held = places.groupBy("text", "full").agg(F.count("*").alias("times"))
    ratios = gram_scores(places.select("full").distinct(), stage(model_counts(examples), "grams"))
    scores = stage(
        held.join(ratios.hint("merge"), "full")
        .groupBy("text")
        # Rounded: the order of a sum depends on the shuffle.
        .agg(F.round(F.sum(F.col("ratio") * F.col("times")) / F.sum("times"), SCORE_DIGITS).alias("score")),
        "scores",
    )
    known = texts.join(scores.hint("merge"), "text", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    kinds = examples.agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).first()
    if kinds["allow"] and kinds["block"]:
        cut = best_cut(known.filter(left_out & (F.col("allow") + F.col("block") > 0)))
        judged = known.select("text", F.when(F.col("score") >= cut, "allow").otherwise("block").alias("_model"), "rows")
    else:
        judged = known.select("text", F.lit("allow").alias("_model"), "rows")
    return (
        spread_join(addresses, judged, ["text"], size="rows", how="left")
        .select("page_id", "host", "path", "rule", F.coalesce("_verdict", "_model").alias("verdict"))
    )
