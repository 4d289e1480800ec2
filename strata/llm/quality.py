"""Quality rules with adaptive thresholds, in DataFrame functions only.

Every document gets a few ratios as whole thousandths. Their distribution is
kept per language and source in a mergeable quantile sketch: a log-linear
histogram whose bin of a value is exact integer arithmetic (128 bins for each
power of two, so a quantile is off by 1/128 at most). Sketches merge by adding
counts, which makes them independent of partitioning and order: groups, whole
languages and the corpus are merges of the same bins. Limits come from the
quartiles of a document's own group and replace fixed cutoffs; documents meet
their limits in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import BLANKS, materialise, words_of

SYMBOLS = "#*$%&|<>"
#: Ratio: (numerator, denominator, least spread in thousandths). The spread
#: keeps limits open where a group hardly varies.
RATIOS = {
    "word_length": ("word_chars", "n_words", 1000),
    "symbols": ("n_symbols", "n_words", 40),
    "dup_lines": ("n_dup_lines", "n_lines", 100),
    "repeats": ("n_repeat_words", "n_words", 80),
}
#: Groups of fewer documents use the sketch of their language, then of all.
LEAST_GROUP = 100
#: A limit lies so many spreads beyond the quartile.
REACH = 4


def features(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` and the counts of every whole text.

    A null text counts as empty. Words are ``[^\\x20\\x09-\\x0D]+``; a word is
    repeated if it lies in a three-word window found twice or more in the text
    (windows are compared by a 64-bit hash of their words); lines are split at
    newlines and count as duplicates when they hold a word and equal an earlier
    line. Rows stay one to one, repeats included.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.length(F.translate(text, BLANKS, ""))
    counted = docs.select(
        F.col("doc_id").alias("doc_id"), F.col("lang").alias("lang"), F.col("source").alias("source"),
        words_of(F.col("text")).alias("w"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines"),
        bare.cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    windows = F.when(F.size("w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("w") - 3),
        lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))))
    counted = counted.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols", F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"))
    # only texts with a repeated window pay for locating it
    counted = counted.withColumn("located", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    found = F.array_sort(F.transform(F.filter("located", lambda x, i: _same(i - 1, x) | _same(i + 1, x)), lambda x: x["i"]))
    counted = counted.withColumn("found", F.when(F.col("located").isNotNull(), found))
    covered = F.aggregate(
        "found", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"])
    return counted.select("doc_id", "lang", "source", "n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines",
                          F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _same(i: Column, x: Column) -> Column:
    """Whether the located window at ``i`` (if there is one) has ``x``'s hash."""
    return F.coalesce(F.get("located", i)["h"] == x["h"], F.lit(False))


def base_failed(n_words: str = "n_words", n_repeat_words: str = "n_repeat_words") -> Column:
    return (F.col(n_words) < 50) | (100 * F.col(n_repeat_words) > 50 * F.col(n_words))


def bin_of(value: Column) -> Column:
    """Lower end of the value's bin: its seven leading binary digits after the first."""
    drop = F.greatest(F.length(F.bin(value)) - 8, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def _ratio(name: str) -> Column:
    over, under, _ = RATIOS[name]
    return F.expr(f"1000 * {over} div greatest({under}, 1)")


def sketches(counted: DataFrame) -> DataFrame:
    """Bins with counts per (lang, source, ratio): what is merged. Documents
    that fail the base rules teach nothing."""
    named = F.array(*[F.struct(F.lit(k).alias("ratio"), bin_of(_ratio(k)).alias("bin")) for k in RATIOS])
    return (counted.where(~base_failed()).select("lang", "source", F.explode(named).alias("x"))
            .groupBy("lang", "source", F.col("x.ratio").alias("ratio"), F.col("x.bin").alias("bin"))
            .agg(F.count("*").alias("n")))


def _quartiles(bins: DataFrame, keys: list[str]) -> DataFrame:
    """First and third quartile of each sketch (the bin that holds the row of
    that rank), after merging the bins of equal ``keys``."""
    merged = bins.groupBy(*keys, "ratio", "bin").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys, "ratio")
    ranked = (merged.withColumn("upto", F.sum("n").over(by.orderBy("bin")))
              .withColumn("total", F.sum("n").over(by)))
    low = F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bin")))
    high = F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bin")))
    return ranked.groupBy(*keys, "ratio").agg(low.alias("low"), high.alias("high"), F.max("total").alias("total"))


def limits(bins: DataFrame) -> DataFrame:
    """One row per (lang, source) with the least and most allowed thousandths of
    every ratio, from the group's own sketch, or its language's or the corpus's
    where the group (the language) has fewer than ``LEAST_GROUP`` documents."""
    own = _quartiles(bins, ["lang", "source"])
    wide = _quartiles(bins, ["lang"]).select(
        F.col("lang").alias("l"), F.col("ratio").alias("r"), F.col("low").alias("low_l"),
        F.col("high").alias("high_l"), F.col("total").alias("total_l"))
    every = _quartiles(bins, []).select(F.col("ratio").alias("r2"), F.col("low").alias("low_c"),
                                        F.col("high").alias("high_c"))
    rows = (own.join(wide, F.col("lang").eqNullSafe(F.col("l")) & (F.col("ratio") == F.col("r")))
            .join(every, F.col("ratio") == F.col("r2")))

    def pick(name: str) -> Column:
        return (F.when(F.col("total") >= LEAST_GROUP, F.col(name))
                .when(F.col("total_l") >= LEAST_GROUP, F.col(f"{name}_l")).otherwise(F.col(f"{name}_c")))

    rows = rows.select("lang", "source", "ratio", pick("low").alias("low"), pick("high").alias("high"))
    least = F.create_map(*[F.lit(x) for k, v in RATIOS.items() for x in (k, v[2])])
    rows = rows.withColumn("spread", F.greatest(F.col("high") - F.col("low"), least[F.col("ratio")]))
    return rows.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("ratio") == k, x)).alias(f"{k}_{end}")
        for k in RATIOS
        for end, x in (("most", F.col("high") + REACH * F.col("spread")), ("least", F.col("low") - REACH * F.col("spread")))])


def judge(docs: DataFrame) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` per row of ``docs``.

    Kept are documents that pass the base rules and lie within the limits of
    their language and source for every ratio (only long words, and too few
    letters a word, have a lower limit as well). Null languages and sources are
    groups like any other; no documents give no rows.
    """
    counted = materialise(features(docs), "quality")
    bounds = limits(sketches(counted))
    names = [c for c in bounds.columns if c not in ("lang", "source")]
    bounds = bounds.select(F.col("lang").alias("lang_b"), F.col("source").alias("source_b"), *names)
    met = counted.join(bounds, F.col("lang").eqNullSafe(F.col("lang_b")) & F.col("source").eqNullSafe(F.col("source_b")), "left")
    fits = F.lit(True)
    for k in RATIOS:
        fits = fits & (_ratio(k) <= F.col(f"{k}_most"))
    fits = fits & (_ratio("word_length") >= F.col("word_length_least"))
    return met.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base_failed().alias("base_failed"), (~base_failed() & F.coalesce(fits, F.lit(False))).alias("kept"))
