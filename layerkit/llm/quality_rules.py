"""Quality rules whose cutoffs come with a guarantee, in DataFrame functions only.

For every rule the cutoffs are tried from the loosest to the tightest. Over all
labelled documents of a stratum, a cutoff that rejects k of n good ones is
certified if a false rejection rate of `alpha` would give k or fewer with a
probability of at most delta / (strata x rules), by the exact binomial sum; the
first cutoff that fails ends the sequence of its rule. A rule with a wrong
cutoff among its certified ones has passed the first wrong one, so this one
test bounds them all: with probability 1 - delta no stratum loses more than
rules x alpha of its good documents, whichever certified cutoffs are chosen.
So the same documents choose the one that pays most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerkit.llm.common import SEPARATORS, checkpointed

#: Rules: name, value, and cutoffs from the loosest to the tightest; a larger value is worse.
RULES = {
    "symbols": ("n_symbols / n_words", [1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1]),
    "repeats": ("n_repeat_words / n_words", [0.45, 0.4, 0.35, 0.3, 0.25, 0.2]),
    "lines": ("n_dup_lines / n_lines", [0.6, 0.5, 0.4, 0.3, 0.2]),
    "long_words": ("word_chars / n_words", [20.0, 16.0, 14.0, 12.0, 10.0]),
    "short_words": ("- word_chars / n_words", [-1.5, -2.0, -2.5, -3.0, -3.5]),
}
FEW = 10_000
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_counts(df: DataFrame, text: str) -> DataFrame:
    """`df` with the counts of its column `text`, n_lines, text_hash, and base_failed; a null text is empty.

    A word is in a repeat if a window of three words over it occurs twice in
    its text. The windows are compared as 64-bit hashes: they are sorted with
    their places, and neighbours that are equal give the places that repeat.
    """
    keep = df.columns
    solid = F.translate("_t", " \t\n\x0b\x0c\r", "")
    df = df.withColumn("_t", F.coalesce(text, F.lit(""))).withColumns(
        {
            "_w": F.filter(F.split("_t", SEPARATORS), lambda w: w != ""),
            "_l": F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != ""),
            "_s": solid,
        }
    )
    df = df.select(
        *keep,
        "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.char_length("_s").cast("long").alias("word_chars"),
        (F.char_length("_s") - F.char_length(F.translate("_s", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.xxhash64("_t").alias("text_hash"),
    )
    counted = [c for c in df.columns if c not in [*keep, "_w"]]
    window = F.expr(
        "if(n_words < 3, array(), transform(sequence(0, cast(n_words as int) - 3), "
        "i -> xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2))))"
    )
    df = df.select(*keep, *counted, window.alias("_g"))
    ordered = F.expr(
        "if(size(array_distinct(_g)) = size(_g), array(), "
        "sort_array(transform(_g, (h, i) -> struct(h as h, i as i))))"
    )
    df = df.select(*keep, *counted, ordered.alias("_o"))
    places = F.expr(
        "sort_array(transform(filter(transform(_o, (x, j) -> struct(x.i as i, "
        "x.h <=> get(_o, j - 1).h or x.h <=> get(_o, j + 1).h as twice)), y -> y.twice), y -> y.i))"
    )
    df = df.select(*keep, *counted, places.alias("_p"))
    covered = F.expr(
        "if(size(_p) = 0, 0L, aggregate(_p, struct(0L as n, -3 as last), "
        "(a, p) -> struct(a.n + least(3, p - a.last) as n, p as last), a -> a.n))"
    )
    df = df.select(*keep, *counted, covered.alias("n_repeat_words"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def _value(rule: str) -> Column:
    """A rule's value; null where there is nothing to divide by."""
    above, _, below = RULES[rule][0].partition(" / ")
    return F.expr(f"try_divide(cast({above} as double), {below})")


def _log_factorial(x: Column) -> Column:
    """ln(x!), from the product up to 20 and from Stirling's series beyond, good to 1e-10."""
    x = x.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * F.pi() * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    small = F.log(F.factorial(F.least(x, F.lit(20.0)).cast("int")).cast("double"))
    return F.when(x <= 20, small).otherwise(F.when(x > 0, series))


def binomial_at_most(k: Column, n: Column, p: float, most: int = 100_000) -> Column:
    """P(X <= k) for X of n draws with chance p; 1 where k is at or over n * p.

    Terms are summed from k down. Past `most` terms the rest is bounded from
    above by a geometric series, so that the value is never too small.
    """
    k, n = k.cast("double"), n.cast("double")
    odds = p / (1 - p)
    top = F.exp(
        _log_factorial(n)
        - _log_factorial(k)
        - _log_factorial(n - k)
        + k * F.log(F.lit(p))
        + (n - k) * F.log(F.lit(1 - p))
    )
    steps = F.least(k, F.lit(float(most))).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def grow(acc, i):
        term = acc["term"] * (k - i + 1) / ((n - k + i) * F.lit(odds))
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    def finish(acc):
        ratio = (k - steps) / ((n - k + steps + 1) * F.lit(odds))
        return acc["total"] + F.when(k > steps, acc["term"] * ratio / (1 - ratio)).otherwise(0.0)

    each = F.when(steps > 0, F.sequence(F.lit(1), F.greatest(steps, F.lit(1)))).otherwise(F.expr("cast(array() as array<int>)"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(top * F.aggregate(each, start, grow, finish))


def fitted(
    counts: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    stratum: str = "lang",
    good: str = "quality",
    alpha: float = 0.01,
    delta: float = 0.05,
    price: float = 20.0,
    least_pay: float = 5.0,
) -> DataFrame:
    """(stratum, cutoffs): for each stratum a map from rule to chosen cutoff.

    `counts` is as from `with_counts`; `labels` has the id and `good` (1 or
    0). Rows that failed the base rules, or have no id or label, aren't used.
    Equal texts of a stratum are one observation, however many documents hold
    them or labels they have, and a good one if any label says so: copies would
    make a cutoff look surer than it is. Falsely rejecting one
    good document costs as much as missing `price` bad ones, and a cutoff has to
    pay `least_pay` at least. A null stratum is a stratum. Rules without a paying certified cutoff are left out, so a
    stratum with few labels loses nothing.
    """
    known = labels.select(labels[id_col].alias(id_col), labels[good].alias("_good")).filter("_good is not null")
    rows = counts.join(known, id_col)
    each = [c for c in [*COUNTS, "n_lines", "base_failed"] if c in rows.columns]
    rows = rows.groupBy(F.col(stratum).alias("_stratum"), "text_hash").agg(
        F.max(F.when(F.col("_good") == 1, 1).otherwise(0)).alias("_good"), *[F.min(c).alias(c) for c in each]
    )
    # Not a filter: pushed below the counts it would make each of them several times.
    open_ = ~F.col("base_failed")
    is_good = F.col("_good") == 1
    sums = [F.count_if(open_ & is_good).alias("n")]
    tries = []
    for rule, (_, cutoffs) in RULES.items():
        for place, cutoff in enumerate(cutoffs):
            out = open_ & (_value(rule) > cutoff)
            name = f"{rule}_{place}"
            sums += [
                F.count_if(out & is_good).alias(f"{name}_k"),
                (F.count_if(out & ~is_good) - price * F.count_if(out & is_good)).alias(f"{name}_pay"),
            ]
            tries.append(
                F.struct(
                    F.lit(rule).alias("rule"),
                    F.lit(place).alias("place"),
                    F.lit(cutoff).alias("cutoff"),
                    F.col(f"{name}_k").alias("k"),
                    F.col(f"{name}_pay").alias("pay"),
                )
            )
    tally = rows.groupBy(F.col("_stratum").alias("stratum")).agg(*sums).select("stratum", "n", F.inline(F.array(*tries)))
    tests = checkpointed(tally)  # a row per stratum and cutoff
    strata = tests.agg(F.count_distinct(F.struct("stratum")).alias("strata")).scalar()
    sure = binomial_at_most(F.col("k"), F.col("n"), alpha) <= delta / (F.greatest(strata, F.lit(1)) * len(RULES))
    so_far = Window.partitionBy("stratum", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    best = (
        tests.withColumn("sure", sure)
        .withColumn("certified", F.bool_and("sure").over(so_far))
        .filter(F.col("certified") & (F.col("pay") >= least_pay))
        .groupBy("stratum", "rule")
        .agg(F.max_by("cutoff", F.struct("pay", -F.col("place"))).alias("cutoff"))
    )
    return best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def judged(counts: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """`counts` with the column kept: not failed by the base rules nor by a rule of its stratum.

    A stratum has cutoffs only if it has about 1 / alpha labelled documents or
    more, so there are few; up to `FEW` of them are broadcast, else Spark picks
    the join.
    """
    if cutoffs.count() <= FEW:
        cutoffs = F.broadcast(cutoffs)
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(_value(rule) > F.col("cutoffs")[rule], F.lit(False))
    joined = counts.join(cutoffs, counts[stratum].eqNullSafe(cutoffs["stratum"]), "left")
    # One expression over both sides, so that a filter on it stays above the join.
    return joined.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(~rejected)).drop(
        "stratum", "cutoffs"
    )


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    **options,
) -> DataFrame:
    """Per row of `docs`: id, the five counts, base_failed and kept.

    Counts are made once and written to the checkpoint folder; both the fit
    and the verdicts read them from there. An empty table gives no rows.
    Repeated rows and null ids are judged like any other; other columns are
    not read.
    """
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[stratum_col].alias("lang"))
    counts = checkpointed(with_counts(source, "text").drop("text"))
    known = labels.withColumnRenamed(id_col, "doc_id")
    rows = judged(counts, checkpointed(fitted(counts, known, **options)))
    return rows.select(F.col("doc_id").alias(id_col), *COUNTS, "base_failed", "kept")


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    **options,
) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns.

    The cutoffs are fitted on counts alone; then every text is counted again
    where it is read, so that no text is shuffled.
    """
    source = docs.select(
        docs[id_col].alias("doc_id"),
        docs[text_col].alias("text"),
        docs[stratum_col].alias("lang"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
    )
    known = labels.withColumnRenamed(id_col, "doc_id")
    cutoffs = checkpointed(fitted(with_counts(source.drop("row"), "text").drop("text"), known, **options))
    return judged(with_counts(source, "text"), cutoffs).filter("kept").select(*[F.col(f"row.`{c}`") for c in docs.columns])
