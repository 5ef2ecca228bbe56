"""URL verdicts from given rules and from association rules mined out of labels.

A URL is a basket of tokens: scheme, host parts, path parts and query names,
numbers as one token. FP-growth finds token combinations that come often with
the label `bad`. Rules are kept by support, confidence and lift, and dropped
where a shorter one is as sure. They match by an inverted index from token to
rule: a rule fits when as many of its tokens are found as it has.
"""

from __future__ import annotations

from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import checkpointed

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first :// to the next /, ? or #, with A to Z in lower case; empty where there is no ://."""
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host to the next ? or #; empty where there is no ://."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL, sorted; numbers are told apart from words but not from each other."""
    scheme = F.translate(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1), _UPPER, _LOWER)
    query = F.regexp_extract(_after(url), r"\?([^#]*)", 1)

    def named(kind: str, parts: Column) -> Column:
        plain = F.filter(parts, lambda p: p != "")
        return F.transform(plain, lambda p: F.concat(F.lit(f"{kind}="), F.regexp_replace(p, r"[0-9]+", "0")))

    names = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    return F.array_sort(
        F.array_distinct(
            F.concat(
                named("scheme", F.array(scheme)),
                named("host", F.split(host_of(url), r"\.")),
                named("path", F.split(path_of(url), "/")),
                named("query", names),
            )
        )
    )


def given_rule(pages: DataFrame, rules: DataFrame, url: str) -> DataFrame:
    """(host, fits): for each distinct host the rules that fit it by host, as an array of structs.

    `rules` has host, path, verdict. A host meets the rules of its suffixes at
    dots by an equality join; the pages themselves aren't multiplied.
    """
    hosts = pages.select(host_of(F.col(url)).alias("host")).distinct()
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )
    listed = rules.select(
        F.col("host").alias("suffix"), F.struct("host", "path", "verdict").alias("listed")
    )
    return (
        hosts.select("host", F.explode(suffixes).alias("suffix"))
        .join(listed, "suffix")
        .groupBy("host")
        .agg(F.collect_list("listed").alias("fits"))
    )


RULE = "rule_id long, tokens array<string>, members array<array<string>>, confidence double"


def mined_rules(
    baskets: DataFrame,
    min_support: float = 0.002,
    min_count: int = 20,
    min_confidence: float = 0.6,
    min_lift: float = 2.0,
) -> DataFrame:
    """(rule_id, tokens, members, confidence) from labelled baskets (tokens, bad).

    Support counts a rule's tokens together with the label; a rule needs the
    share `min_support` of all baskets, and `min_count` of them. A rule is
    dropped if another one with a part of its tokens is at least as sure.

    Tokens that are in the same baskets, told by count and two sums of hashes,
    are one item: the first of them stands in `tokens` for all of its
    `members`, each of which would make a rule as sure. A token that only bad
    baskets have is a rule that no longer one can beat. Both are settled before
    FP-growth, which sees bad baskets alone, so a URL with very many names of
    its own, however often it comes, doesn't multiply; the counts in all
    baskets, for the confidence, come from an inverted index.
    """
    spark = baskets.sparkSession
    sets = checkpointed(
        baskets.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"))
        .filter("size(tokens) > 0 or bad > 0")
        .withColumns({"h": F.xxhash64("tokens"), "g": F.xxhash64(F.lit(1), F.col("tokens"))})
    )
    total, bad = (x or 0 for x in sets.agg(F.sum("n"), F.sum("bad")).first())
    least = max(1, ceil(max(min_support * total, min_count) - 1e-9))
    if bad < least:
        return spark.createDataFrame([], RULE)
    token = sets.select(F.explode("tokens").alias("token"), "n", "bad", "h", "g").groupBy("token")
    wide = "decimal(38,0)"
    token = token.agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("h").cast(wide)).alias("h"), F.sum(F.col("g").cast(wide)).alias("g")
    )
    items = checkpointed(
        token.filter(F.col("bad") >= least)
        .groupBy("n", "bad", "h", "g")
        .agg(F.array_sort(F.collect_list("token")).alias("members"))  # all of them in one URL
        .select("members", F.col("members")[0].alias("item"), "n", "bad")
    )
    found = items.select(F.array("item").alias("tokens"), F.col("bad").alias("freq"), "n")
    mixed = items.filter("bad < n").select(F.col("item").alias("token"))
    seen = sets.filter("bad > 0").select("h", "g", "bad", F.explode("tokens").alias("token")).join(mixed, "token")
    mined = seen.groupBy("h", "g", "bad").agg(F.collect_list("token").alias("items"))
    mined = checkpointed(mined.select("items", F.explode(F.expr("sequence(1L, bad)")).alias("copy")))
    rows = mined.count()
    if rows >= least:
        miner = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / rows, minConfidence=1.0)
        long = miner.fit(mined).freqItemsets.filter("size(items) > 1")
        long = checkpointed(long.select(F.array_sort("items").alias("tokens"), "freq"))
        index = long.select("tokens", F.size("tokens").alias("size"), F.explode("tokens").alias("token"))
        held = (
            sets.select("h", "g", "n", F.explode("tokens").alias("token"))
            .join(index, "token")
            .groupBy("h", "g", "n", "tokens", "size")
            .count()
            .filter("count = size")
            .groupBy("tokens")
            .agg(F.sum("n").alias("n"))
        )
        found = found.unionByName(long.join(held, "tokens").select("tokens", "freq", "n"))
    rules = found.select("tokens", (F.col("freq") / F.col("n")).alias("confidence"))
    rules = rules.filter((F.col("confidence") >= min_confidence) & (F.col("confidence") * total / bad >= min_lift))
    rules = checkpointed(rules.withColumn("rule_id", F.xxhash64("tokens")))
    # Rules with a token in common meet by that token; a shorter one that is as sure makes the longer one idle.
    index = rules.select("rule_id", F.size("tokens").alias("n"), "confidence", F.explode("tokens").alias("token"))
    short = index.select("token", F.col("rule_id").alias("short_id"), F.col("n").alias("short_n"), F.col("confidence").alias("short_confidence"))
    idle = (
        index.filter("n > 1")
        .join(short, "token")
        .filter("short_n < n and short_confidence >= confidence")
        .groupBy("rule_id", "short_id", "short_n")
        .count()
        .filter("count = short_n")
        .select("rule_id")
        .distinct()
    )
    left = rules.join(idle, "rule_id", "left_anti")
    named = left.select("rule_id", F.posexplode("tokens").alias("place", "item")).join(items.select("item", "members"), "item")
    named = named.groupBy("rule_id").agg(F.array_sort(F.collect_list(F.struct("place", "members"))).alias("m"))
    return left.join(named, "rule_id").select("rule_id", "tokens", F.col("m.members").alias("members"), "confidence")


def matched(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, confidence): of each distinct basket that a mined rule fits, the surest rule's confidence.

    A rule fits a basket that has one of the members of each of its items.
    """
    index = rules.select("rule_id", F.size("tokens").alias("n"), "confidence", F.posexplode("members").alias("place", "m"))
    index = index.select("rule_id", "n", "confidence", "place", F.explode("m").alias("token"))
    distinct = baskets.select("tokens").distinct()
    return (
        distinct.select("tokens", F.explode("tokens").alias("token"))
        .join(index, "token")
        .groupBy("tokens", "rule_id", "n", "confidence")
        .agg(F.count_distinct("place").alias("places"))
        .filter("places = n")
        .groupBy("tokens")
        .agg(F.max("confidence").alias("confidence"))
    )


def url_verdicts(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    labelled: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    **options,
) -> DataFrame:
    """Per row of `pages`: id, host, path, rule, verdict, confidence.

    `rules` are (verdict, host, path); one fits a URL whose host is the
    rule's or under it and whose path starts with the rule's. The longest host
    and path together win, then the longer host. `rule` is its text, host and
    path, or null; the verdict is the rule's, else `block` if a mined rule
    fits and `allow` if none does. `confidence` is the surest fitting mined
    rule's, also where a given rule decides.

    `labelled` has url and bad (boolean); rows with nulls aren't used. URLs
    that are null or have no :// have an empty host and path, and no given
    rule fits them. Repeated rows and null ids give their own rows; other
    columns aren't read.
    """
    spark = pages.sparkSession
    rows = pages.select(
        pages[id_col].alias("id"),
        F.coalesce(host_of(pages[url_col]), F.lit("")).alias("host"),
        F.coalesce(path_of(pages[url_col]), F.lit("")).alias("path"),
        F.coalesce(tokens_of(pages[url_col]), F.expr("cast(array() as array<string>)")).alias("tokens"),
    )
    listed = spark.createDataFrame([(h, p, v) for v, h, p in rules], "host string, path string, verdict string")
    fits = given_rule(pages.select(pages[url_col].alias("url")), listed, "url")
    baskets = labelled.filter("url is not null and bad is not null").select(
        tokens_of(F.col("url")).alias("tokens"), "bad"
    )
    sure = matched(rows, mined_rules(baskets, **options))
    starting = F.filter("fits", lambda r: F.startswith(F.col("path"), r["path"]))
    ranked = F.transform(
        starting,
        lambda r: F.struct(
            (F.length(r["host"]) + F.length(r["path"])).alias("size"),
            F.length(r["host"]).alias("host_size"),
            F.concat(r["host"], r["path"]).alias("rule"),
            r["verdict"].alias("verdict"),
        ),
    )
    best = F.array_max(ranked)
    return (
        rows.join(fits, "host", "left")
        .join(sure, "tokens", "left")
        .select(
            F.col("id").alias(id_col),
            "host",
            "path",
            best["rule"].alias("rule"),
            F.coalesce(
                best["verdict"], F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
            ).alias("verdict"),
            "confidence",
        )
    )
