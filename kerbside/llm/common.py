"""What the operators share: words, bound values in expressions, written tables."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.cuckoo import mixed
from kerbside.session import work_folder

#: Characters that separate words: space and the control characters 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once even where the body uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for a null or blank text.

    One plain separator lets the split run without a pattern, which is several times as fast.
    """
    for blank in BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), " "), "")


def count_of(text: Column, characters: str) -> Column:
    """How often any of ``characters`` (ASCII) occurs."""
    return sum((F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in characters), F.lit(0))


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written below ``spark.checkpoint.dir`` and read again: its lineage ends here."""
    spark = frame.sparkSession
    path = work_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Python tasks get so many texts at a time; the default of 10,000 is too much for long ones."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def release() -> None:
    """Give the memory that this process no longer uses back to the system, as far as its C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def lean(rows: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``rows``, for mapInPandas, such that a task's tables leave the Python worker with it: Spark keeps workers, takes them in turn,
    and so each would come to hold what one task needs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from rows(batches)
        release()

    return run


#: Stands for a null document id where ids are compared: after all others.
LAST_ID = (1 << 63) - 1


def filter_bits(n: int) -> int:
    """Bits of a Bloom filter for ``n`` ids: a power of two with 16 or more an id, from 2 MB up to 64 MB."""
    return 1 << min(29, max(24, (16 * n - 1).bit_length()))


#: log2 of the 64-bit words in a segment of a filter, and segments that the driver takes at a time (16 MB).
SEGMENT_WORDS, SEGMENTS = 13, 256


def filter_words(words: DataFrame, bits: int) -> np.ndarray:
    """The 64-bit words of a filter of ``bits`` bits, from the distinct (word, mask) that are not 0.

    Tasks lay them out in segments, which come to the driver in one collect per 16 MB, however many partitions there are.
    """
    def segment(rows: pd.DataFrame) -> pd.DataFrame:
        own = np.zeros(1 << SEGMENT_WORDS, np.int64)
        own[rows["word"].to_numpy() & (1 << SEGMENT_WORDS) - 1] = rows["mask"].to_numpy()
        return pd.DataFrame({"segment": rows["segment"].iloc[:1], "bytes": [own.tobytes()]})

    parts = words.select(F.shiftright("word", SEGMENT_WORDS).cast("int").alias("segment"), "word", "mask") \
        .groupBy("segment").applyInPandas(segment, "segment int, bytes binary")
    table, width = np.zeros(bits >> 6, np.int64), 1 << SEGMENT_WORDS
    many = len(table) > width * SEGMENTS
    if many:
        parts = stored(parts, "filter-segments")
    for first in range(0, -(-len(table) // width), SEGMENTS):
        for r in (parts.filter(F.col("segment").between(first, first + SEGMENTS - 1)) if many else parts).collect():  # at most SEGMENTS rows
            own = table[r.segment * width:(r.segment + 1) * width]
            own[:] = np.frombuffer(r.bytes, np.int64)[:len(own)]
    return table.view(np.uint64)


def bloom_filter(ids: DataFrame, bits: int = 1 << 24) -> Callable[[Column], Column]:
    """A test of whether an id (BIGINT) may be among ``ids`` (one column): no id that is in is missed.

    Rows that fail it need not be shuffled to a join with ``ids``. The filter takes ``bits`` / 8 bytes whatever the
    number of ids; when they are too many for it, it only lets more rows through.
    """
    name, seeds = ids.columns[0], (1, 2, 3)
    places = F.array(*[F.pmod(F.xxhash64(F.lit(s), F.col(name)), F.lit(bits)) for s in seeds])
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))
    words = (
        ids.select(F.explode(places).alias("p"))
        .groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(mask).alias("mask"))
    )
    packed = filter_words(words, bits)

    @F.pandas_udf("boolean")
    def inside(places: pd.Series) -> pd.Series:
        p = np.array(places.tolist(), np.int64).reshape(-1, len(seeds))
        return pd.Series(((packed[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1)).all(1))

    return lambda c: inside(F.array(*[F.pmod(F.xxhash64(F.lit(s), c), F.lit(bits)) for s in seeds]))


def hash_filter(hashes: DataFrame, bits: int) -> Callable[[np.ndarray], np.ndarray]:
    """A Bloom filter like ``bloom_filter`` for 64-bit hashes (one column), asked with arrays inside a Python task: no hash that is in
    is missed."""
    name, seeds = hashes.columns[0], [mixed(np.array([s], np.uint64))[0] for s in (1, 2, 3)]

    def places(values: np.ndarray) -> list[np.ndarray]:
        return [mixed(values.astype(np.int64).view(np.uint64) ^ s) & np.uint64(bits - 1) for s in seeds]

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p in places(batch[name].to_numpy()):
                p.sort()
                word, start = np.unique(p >> np.uint64(6), return_index=True)
                mask = np.bitwise_or.reduceat(np.uint64(1) << (p & np.uint64(63)), start) if len(p) else p
                yield pd.DataFrame({"word": word.view(np.int64), "mask": mask.view(np.int64)})

    packed = filter_words(hashes.mapInPandas(words, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")), bits)

    def inside(values: np.ndarray) -> np.ndarray:
        hit = np.ones(len(values), bool)
        for p in places(values):
            hit &= (packed[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return hit

    return inside
