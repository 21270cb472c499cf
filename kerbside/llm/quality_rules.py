"""Quality rules whose thresholds adapt to each language and source.

Every document gets ratios in ten-thousandths (symbols, repeated lines, words in repeated windows, upper
case, mean word length). Per (language, source) and rule a log-bucket sketch holds their distribution:
values below 64 have a bucket each, then 32 buckets per power of two, so a quantile is off by 1/32 at
most. A sketch is a set of (bucket, count) rows; sketches merge by adding counts, which a plain
aggregation does, exactly and in any order. The upper fence of a rule is the group's median plus ``spread`` times
the distance from there to the ninth decile; where nine tenths of the group are alike, as with symbols that most
texts do without, it is half-way between the median and the 99th percentile. The lower fence (word length) mirrors the first
by the first decile. A group with fewer than ``least`` documents, or whose 99th percentile is its median, takes the
merged sketch of its language, then that of all; a rule in which even these show no tail rejects nothing. No constant
decides: every fence is made of quantiles. Thresholds are joined back and a document outside any fence is rejected;
one that stands exactly on a fence stays.

Edge cases: a null or blank text has no words, fails the base and takes no part in a sketch; null
language or source form their own group; repeated rows count as often as they come; an empty table
gives an empty result; further columns are ignored. Windows are compared by a 64-bit hash within one text.

Scale: one pass over the texts, in which a document's words never leave its row; then only a handful of
numbers per document is shuffled, and sketches are combined before their shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import count_of, let, stored, words_of

SYMBOLS = "#*$%&|<>"
#: rule: whether it has a lower fence too
RULES = {"symbols": False, "dup_lines": False, "repeats": False, "uppers": False, "word_length": True}
PERCENTS = (10, 50, 90, 99)
RATIO = 10_000


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice; ``hashes`` has one per window of three words."""
    def of_sorted(pairs: Column) -> Column:
        same = lambda e, j: F.coalesce(F.get(pairs, j - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(
            F.get(pairs, j + 1)["h"] == e["h"], F.lit(False))
        places = F.sort_array(F.transform(F.filter(pairs, same), lambda e: e["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            places, start,
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
            lambda a: a["n"])

    paired = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(paired, of_sorted))


def _word_counts(words: Column) -> Column:
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                          lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.when(F.size(words) > 3, let(windows, _covered)).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"))


def measured(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, source and the counts that the base and the rules are made of."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    frame = docs.select("doc_id", "lang", "source", let(words_of(text), _word_counts).alias("w"),
                        count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
                        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                        let(lines, F.size).cast("long").alias("n_lines"),
                        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"))
    return frame.select("doc_id", "lang", "source", "w.*", "n_symbols", "n_dup_lines", "n_lines", "n_upper")


def ratios() -> dict[str, Column]:
    share = lambda a, b: F.floor(F.lit(RATIO) * F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("long")
    return {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"),
            "repeats": share("n_repeat_words", "n_words"), "uppers": share("n_upper", "word_chars"),
            "word_length": share("word_chars", "n_words")}


def bucket_of(value: Column) -> Column:
    """Bucket of a count: itself below 64, then 32 per power of two."""
    octave = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(
        (octave + 1) * 32 + F.floor(value / F.pow(F.lit(2.0), octave)) - 32).cast("long")


def value_of(bucket: Column) -> Column:
    """Lower end of a bucket."""
    octave = F.floor(bucket / 32) - 1
    return F.when(bucket < 64, bucket).otherwise((bucket % 32 + 32) * F.pow(F.lit(2.0), octave)).cast("long")


def sketches(measures: DataFrame) -> DataFrame:
    """(lang, source, rule, bucket, count): one sketch per language, source and rule."""
    return (
        measures.filter("n_words > 0")
        .select("lang", "source", F.explode(F.array(*[
            F.struct(F.lit(k).alias("rule"), bucket_of(v).alias("bucket")) for k, v in ratios().items()])).alias("x"))
        .groupBy("lang", "source", "x.rule", "x.bucket").agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches added up to coarser keys."""
    return sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """The values below which ``PERCENTS`` of each sketch lie, and its size."""
    group = Window.partitionBy(*keys, "rule")
    run = sketch.withColumn("_run", F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    run = run.withColumn("_all", F.sum("n").over(group))
    at = lambda p: F.min(F.when(F.col("_run") * 100 >= F.col("_all") * p, F.col("bucket")))
    return run.groupBy(*keys, "rule").agg(*[value_of(at(p)).alias(f"p{p}") for p in PERCENTS], F.first("_all").alias("seen"))


def fences(sketch: DataFrame, least: int, spread: int) -> DataFrame:
    """(lang, source, bounds by rule), from the group's own sketch or the merged one it falls back on."""
    own = quantiles(sketch, "lang", "source")
    by_lang = quantiles(merged(sketch, "lang"), "lang")
    overall = quantiles(merged(sketch))
    tells = lambda side: (F.col(f"{side}.seen") >= least) & (F.col(f"{side}.p99") > F.col(f"{side}.p50"))
    chosen = (
        own.alias("o").join(by_lang.alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.rule") == F.col("l.rule")))
        .join(overall.alias("a"), F.col("o.rule") == F.col("a.rule"))
        .select("o.lang", "o.source", "o.rule", *[
            F.when(tells("o"), F.col(f"o.p{p}")).when(tells("l"), F.col(f"l.p{p}")).otherwise(F.col(f"a.p{p}")).alias(f"p{p}") for p in PERCENTS])
    )
    two_sided = F.col("rule").isin([k for k, both in RULES.items() if both])
    bounds = chosen.select(
        "lang", "source", "rule",
        F.when(F.col("p90") > F.col("p50"), F.col("p50") + spread * (F.col("p90") - F.col("p50")))
        .when(F.col("p99") > F.col("p50"), F.floor((F.col("p50") + F.col("p99")) / 2).cast("long")).alias("high"),
        F.when(two_sided & (F.col("p50") > F.col("p10")), F.col("p50") - spread * (F.col("p50") - F.col("p10"))).alias("low"))
    return bounds.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("rule") == k, F.struct("low", "high"))).alias(f"_{k}") for k in RULES])


def quality_rules(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, least: int = 100,
                  spread: int = 5) -> DataFrame:
    """Counts, ratios, the base's and the adaptive verdict per row of ``docs``."""
    measures = stored(measured(docs), "quality-measures")
    bounds = fences(sketches(measures), least, spread)
    joined = measures.alias("m").join(
        bounds.alias("b"), F.col("m.lang").eqNullSafe(F.col("b.lang")) & F.col("m.source").eqNullSafe(F.col("b.source")), "left")
    outside = F.lit(False)
    for rule, value in ratios().items():
        outside = outside | F.coalesce(value > F.col(f"_{rule}.high"), F.lit(False)) | F.coalesce(
            value < F.col(f"_{rule}.low"), F.lit(False))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return joined.select(
        "m.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~outside).alias("kept"), *[v.alias(f"ratio_{k}") for k, v in ratios().items()])
