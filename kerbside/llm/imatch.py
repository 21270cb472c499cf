"""I-Match fingerprints: distinct terms of an inverse-document-frequency band, hashed per random lexicon.

Terms are a text's words with A-Z lower-cased. The lexicon holds the terms found in at least ``rare``
and at most ``common`` of all documents, counted over all of them. A seeded hash spreads the lexicon
over ``subsets`` disjoint random lexicons. For each of them that holds a term of the document, the document's distinct
terms in it are sorted and hashed; the fingerprint lists these hashes by lexicon. The likeness of two
fingerprints is the share of lexicons with the same hash among those that either of them has. A text
without a term in the band is fingerprinted over all its terms, so short texts stay apart.

Edge cases: null texts are empty; texts without words have an empty fingerprint, and two empty
fingerprints are alike (1.0); rows with the same id are ordered by a hash of their text; the next
document of a single one is itself; an empty table gives an empty result; further columns are ignored.

Scale: the lexicon has at most (mean distinct terms per document) / ``rare`` terms whatever the number of
documents, because each of its terms stands in ``rare`` of all documents; that bound lets it travel
with the plan. Texts are shuffled once, to pass each document's beginning to its predecessor; the
predecessor is found from (id, hash) rows in range partitions, not in one task. Rows equal in id and text
are joined once for all, combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import let, stored, words_of

BUCKETS = 1 << 15
#: An entry of a fingerprint: the lexicon's number above so many bits of the hash of its terms.
HASH_BITS = 24
HASHES = 1 << HASH_BITS


def terms_of(text: Column) -> Column:
    """Distinct words, A-Z lower-cased, in order of their code points."""
    return F.sort_array(F.array_distinct(words_of(ascii_lower(text))))


def ascii_lower(text: Column) -> Column:
    """Lower-case; outside ASCII only A-Z change."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def _bucket(term: Column) -> Column:
    return F.pmod(F.hash(term), F.lit(BUCKETS))


def lexicon(docs: DataFrame, rare: float, common: float) -> Column:
    """The band's terms as a constant: an array with a text for each hash bucket, its terms between blanks.

    What the driver holds is bounded by the mean number of distinct terms over ``rare``, not by the input.
    """
    n_docs = docs.count()
    terms = docs.select(F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    band = stored(
        terms.filter((F.col("df") >= rare * n_docs) & (F.col("df") <= common * n_docs))
        .groupBy(_bucket(F.col("term")).alias("bucket")).agg(F.array_join(F.sort_array(F.collect_list("term")), " ").alias("terms")),
        "imatch-lexicon")
    buckets = [""] * BUCKETS
    for r in band.toLocalIterator():
        buckets[r.bucket] = f" {r.terms} "
    return F.split(F.lit("\n".join(buckets)), "\n", -1)


def fingerprint_of(text: Column, lexicon: Column, subsets: int, seed: int) -> Column:
    """Array with an entry (number and hash) for each random lexicon that the text has terms of, in order."""
    def of_terms(terms: Column) -> Column:
        inside = F.filter(terms, lambda t: F.contains(F.get(lexicon, _bucket(t)), F.concat(F.lit(" "), t, F.lit(" "))))
        return let(inside, lambda band: F.when(F.size(band) > 0, let(spread(band), hashed)).otherwise(
            let(spread(terms), hashed)))

    def spread(terms: Column) -> Column:
        return F.sort_array(F.transform(terms, lambda t: F.struct(
            F.pmod(F.xxhash64(F.lit(seed), t), F.lit(subsets)).cast("int").alias("subset"), t.alias("term"))))

    def hashed(pairs: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(pairs)), lambda i: (i < F.size(pairs)) & (
            (i == 0) | (F.get(pairs, i)["subset"] != F.get(pairs, i - 1)["subset"])))
        return let(places, lambda at: F.transform(at, lambda i, n: (
            F.get(pairs, i)["subset"] * HASHES
            + F.pmod(F.xxhash64(F.slice(pairs, i + 1, F.coalesce(F.get(at, n + 1), F.size(pairs)) - i)), F.lit(HASHES)).cast("int"))))

    return let(terms_of(text), of_terms)


def likeness(a: Column, b: Column) -> Column:
    numbers = lambda x: F.transform(x, lambda e: F.shiftright(e, HASH_BITS))
    either = F.size(F.array_union(numbers(a), numbers(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either).cast("double")


def shown(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda e: F.lower(F.hex(e))), " ")


def followers(keys: DataFrame) -> DataFrame:
    """Each distinct key (key, mark) with the next one's, and the first after the last."""
    placed = stored(
        keys.distinct().repartitionByRange("key", "mark").withColumn("_part", F.spark_partition_id()), "imatch-order")
    order = Window.partitionBy("_part").orderBy("key", "mark")
    parts = Window.partitionBy(F.lit(0))  # a row per partition
    firsts = (
        placed.groupBy("_part").agg(F.min(F.struct("key", "mark")).alias("_first"))
        .withColumn("_entry", F.coalesce(F.lead("_first").over(parts.orderBy("_part")), F.min("_first").over(parts)))
    )
    return (
        placed.withColumn("_next", F.lead(F.struct("key", "mark")).over(order)).join(firsts, "_part")
        .select("key", "mark", "n_chars", F.coalesce("_next", "_entry").alias("next"))
    )


def fingerprints(docs: DataFrame, rare: float = 0.002, common: float = 0.1, subsets: int = 128, seed: int = 29) -> DataFrame:
    """Per row: doc_id, n_chars, the edited text's SHA-256, both fingerprints and the next document's.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next
    document's, or all of them. ``subsets`` is 128 at most.
    """
    last = F.lit((1 << 63) - 1)
    texts = docs.select("doc_id", F.coalesce("doc_id", last).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("mark", F.xxhash64("text"))
    words = lexicon(texts, rare, common)
    own = stored(texts.select("doc_id", "key", "mark", F.length("text").alias("n_chars"),
                              fingerprint_of(F.col("text"), words, subsets, seed).alias("fingerprint")), "imatch-own")
    links = stored(followers(own.select("key", "mark", "n_chars")), "imatch-links")
    needed = links.select(F.col("next.key").alias("key"), F.col("next.mark").alias("mark"), F.col("key").alias("to_key"),
                          F.col("mark").alias("to_mark"), F.floor(F.col("n_chars") / 2).cast("int").alias("need"))
    moved = texts.select("key", "mark", "text").dropDuplicates(["key", "mark"])
    beginnings = moved.join(needed, ["key", "mark"]).select(
        F.col("to_key").alias("key"), F.col("to_mark").alias("mark"), F.expr("substring(text, 1, need)").alias("beginning"))
    head = F.expr("substring(text, 1, cast(length(text) - floor(length(text) / 2) as int))")
    edited = (
        moved.join(beginnings, ["key", "mark"]).select("key", "mark", F.concat(head, "beginning").alias("edited"))
        .select("key", "mark", F.sha2("edited", 256).alias("edited_sha256"),
                fingerprint_of(F.col("edited"), words, subsets, seed).alias("edited_fingerprint"))
    )
    of_next = (
        own.dropDuplicates(["key", "mark"])
        .select(F.col("key").alias("_key"), F.col("mark").alias("_mark"), F.col("fingerprint").alias("next_fingerprint"))
        .join(links.select("key", "mark", F.col("next.key").alias("_key"), F.col("next.mark").alias("_mark")), ["_key", "_mark"])
        .drop("_key", "_mark")
    )
    return own.join(edited, ["key", "mark"]).join(of_next, ["key", "mark"]).select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint",
        "next_fingerprint")
