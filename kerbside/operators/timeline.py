"""Per-key time-ordered computation that does not put a whole key into one task.

A window function ``PARTITION BY device ORDER BY time`` sorts all rows of a device in one task. Here a key with
more rows than ``rows_per_slice`` is cut into time slices first (split points come from a sample of its rows), windows
run per (key, slice), and what a slice needs from earlier slices is carried over in a summary of a few values per slice. Keys below the bound keep the plain window: one shuffle and nothing else.

Splitting needs statistics, so building a ``Timeline`` runs one count per key over the key column alone. At most
``rows / rows_per_slice`` keys can be above the bound, and together they get about as many slices: that is the size
bound of everything collected and broadcast here. A single order over all rows is no key; see ``numbered``.

A null key is no key: its rows never see each other, so each is a group of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.session import work_folder

ROWS_PER_SLICE = 8_000_000
SAMPLE = 20


def hot_keys(df: DataFrame, keys: Sequence[str], bound: int) -> list:
    """Keys with more than ``bound`` rows, with their counts; at most ``rows / bound`` of them.

    A compound key can only be hot if its first column is, so that is counted first: few groups, combined before the
    shuffle. Mostly that is all.
    """
    if len(keys) > 1:
        outer = hot_keys(df, keys[:1], bound)
        if not outer:
            return []
        values = df.sparkSession.createDataFrame([(r[keys[0]],) for r in outer], df.select(keys[0]).schema)
        df = df.join(F.broadcast(values), keys[0], "left_semi")
    named = df.na.drop(subset=list(keys))
    counts = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") > bound).collect()


def split_points(df: DataFrame, keys: Sequence[str], order: Sequence[str], bound: int) -> DataFrame | None:
    """Sorted inner split points (structs of the order columns) for every hot key, or None when no key is hot.

    They come from a sample of the hot keys' rows, ``SAMPLE`` per slice, so bursts and many rows at one instant are split
    as well as an even flow; only rows equal in all order columns stay together.
    """
    hot = hot_keys(df, keys, bound)
    if not hot:
        return None
    spark = df.sparkSession
    hot_df = spark.createDataFrame(
        [(*[r[k] for k in keys], -(-r["_rows"] // bound), r["_rows"]) for r in hot],
        schema=df.select(*keys).schema.simpleString()[7:-1] + ",_slices int,_rows long",
    )
    sampled = df.select(*keys, F.struct(*order).alias("_place")).join(F.broadcast(hot_df), list(keys)).where(
        F.rand(7) < F.lit(float(SAMPLE)) * F.col("_slices") / F.col("_rows")
    )
    step = F.greatest(F.lit(1), F.floor(F.size("_sample") / F.col("_slices"))).cast("int")
    points = (
        sampled.groupBy(*keys, "_slices")
        .agg(F.sort_array(F.collect_list("_place")).alias("_sample"))
        .withColumn("_step", step)
        .select(*keys, F.array_distinct(F.filter("_sample", lambda x, i: (i + 1) % F.col("_step") == 0)).alias("_points"))
    )
    return spark.createDataFrame(points.collect(), schema=points.schema)


def _slice_of(place: Column, most: int) -> Column:
    """How many of the up to ``most`` split points are at or before ``place``: a binary search as a fold over powers of two."""
    bits = F.array(*[F.lit(1 << b) for b in range(most.bit_length(), -1, -1)])

    def step(pos, bit):
        nxt = pos + bit
        inside = (nxt <= F.size("_points")) & (F.get(F.col("_points"), nxt - 1) <= place)
        return F.when(inside, nxt).otherwise(pos)

    return F.when(F.col("_points").isNull(), F.lit(0)).otherwise(F.aggregate(bits, F.lit(0), step))


class Timeline:
    """Rows of ``df`` ordered by (``at``, ``ties``) within ``keys``.

    ``at`` is a BIGINT column expression (epoch microseconds, negated to look forward in time). Methods add columns to
    ``self.rows`` and return the timeline, so several computations share one shuffle and one sort.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], at: Column, ties: Sequence[str] = (),
                 rows_per_slice: int | None = None):
        self.keys = list(keys)
        self.ties = list(ties)
        rows = df.withColumn("_at", at)
        points = split_points(rows, self.keys, self.order, rows_per_slice or ROWS_PER_SLICE)
        self.sliced = points is not None
        if self.sliced:
            most = points.agg(F.max(F.size("_points"))).first()[0]
            rows = (
                rows.join(F.broadcast(points), self.keys, "left")
                .withColumn("_slice", _slice_of(F.struct(*self.order), most))
                .withColumn("_hot", F.col("_points").isNotNull())
                .drop("_points")
            )
        nameless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        self.rows = rows.withColumn("_spread", F.when(
            nameless, F.xxhash64("_at", *self.ties)).otherwise(F.lit(0).cast("bigint")))

    @property
    def group(self) -> list[str]:
        """Columns that make one bounded group."""
        return [*self.keys, "_spread", "_slice"] if self.sliced else [*self.keys, "_spread"]

    @property
    def order(self) -> list[str]:
        return ["_at", *self.ties]

    def _window(self):
        return Window.partitionBy(*self.group).orderBy(*self.order)

    def _upto(self):
        return self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def _per_slice(self, *aggregates: Column) -> DataFrame:
        """One row per (hot key, slice): a few values each."""
        return self.rows.where("_hot").groupBy(*self.group).agg(*aggregates)

    def _earlier(self):
        return Window.partitionBy(*self.keys, "_spread").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)

    def _attach(self, carried: DataFrame) -> None:
        # bounded: one row per slice of a hot key
        self.rows = self.rows.join(F.broadcast(carried), self.group, "left")

    def last_known(self, **values: Column) -> Timeline:
        """Latest non-null value at or before each row, per name."""
        temp = {name: f"_v_{name}" for name in values}
        self.rows = self.rows.withColumns({temp[n]: v for n, v in values.items()})
        carry = None
        if self.sliced:
            when = F.struct(*self.order)
            summary = self._per_slice(
                *[F.max_by(t, F.when(F.col(t).isNotNull(), when)).alias(f"_s{t}") for t in temp.values()]
            )
            carry = summary.select(
                *self.group,
                *[F.last(f"_s{t}", ignorenulls=True).over(self._earlier()).alias(f"_c{t}") for t in temp.values()],
            )
        w = self._upto()
        self.rows = self.rows.withColumns({n: F.last(t, ignorenulls=True).over(w) for n, t in temp.items()})
        if carry is not None:
            self._attach(carry)
            self.rows = self.rows.withColumns({n: F.coalesce(n, f"_c{t}") for n, t in temp.items()})
            self.rows = self.rows.drop(*[f"_c{t}" for t in temp.values()])
        self.rows = self.rows.drop(*temp.values())
        return self

    def previous(self, name: str, value: Column, n: int = 1) -> Timeline:
        """Array of ``value`` of up to ``n`` rows before each row, oldest first."""
        self.rows = self.rows.withColumn("_v", value)
        local = F.collect_list("_v").over(self._window().rowsBetween(-n, -1))
        if not self.sliced:
            self.rows = self.rows.withColumn(name, local).drop("_v")
            return self
        newest = Window.partitionBy(*self.group).orderBy(*[F.desc(c) for c in self.order])
        tails = (
            self.rows.where("_hot")
            .withColumn("_rank", F.row_number().over(newest))
            .where(F.col("_rank") <= n)
            .groupBy(*self.group)
            .agg(F.sort_array(F.collect_list(F.struct(F.col("_rank").alias("r"), F.col("_v").alias("v"))), False)
                 .alias("_tail"))
            .select(*self.group, F.transform("_tail", lambda x: x["v"]).alias("_tail"))
        )
        # every slice present holds at least one row, so n earlier slices are enough
        w = Window.partitionBy(*self.keys, "_spread").orderBy("_slice").rowsBetween(-n, -1)
        carry = tails.select(*self.group, F.flatten(F.collect_list("_tail").over(w)).alias("_carry"))
        self.rows = self.rows.withColumn("_local", local)
        self._attach(carry)
        both = F.concat(F.coalesce("_carry", F.slice("_local", 1, 0)), "_local")
        self.rows = (
            self.rows.withColumn("_both", both)
            .withColumn(name, F.when(F.size("_both") > n, F.slice("_both", -n, n)).otherwise(F.col("_both")))
            .drop("_v", "_local", "_carry", "_both")
        )
        return self

    def running(self, totals: bool = False, **values: str) -> Timeline:
        """Running sum of SQL expressions up to and including each row; with ``totals`` also ``<name>_total`` of the key."""
        group, order = ", ".join(self.group), ", ".join(self.order)
        upto = f"OVER (PARTITION BY {group} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        self.rows = self.rows.selectExpr("*", *[f"{v} AS _v{n}" for n, v in values.items()])
        carry = whole = None
        if self.sliced:
            summary = self.rows.where("_hot").groupBy(*self.group).agg(*[F.sum(f"_v{n}").alias(f"_s{n}") for n in values])
            before = f"OVER (PARTITION BY {', '.join([*self.keys, '_spread'])} ORDER BY _slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
            carry = summary.selectExpr(*self.group, *[f"sum(_s{n}) {before} AS _c{n}" for n in values])
            whole = summary.groupBy(*self.keys).agg(*[F.sum(f"_s{n}").alias(f"_w{n}") for n in values])
        added = [f"coalesce(sum(_v{n}) {upto}, 0) AS {n}" for n in values]
        if totals:
            added += [f"coalesce(sum(_v{n}) OVER (PARTITION BY {group}), 0) AS {n}_total" for n in values]
        kept = [c for c in self.rows.columns if c not in {f"_v{n}" for n in values}]
        self.rows = self.rows.selectExpr(*kept, *added)
        if carry is not None:
            self._attach(carry)
            full = [f"{n} + coalesce(_c{n}, 0) AS {n}" for n in values]
            if totals:
                self.rows = self.rows.join(F.broadcast(whole), self.keys, "left")
                full += [f"coalesce(_w{n}, {n}_total) AS {n}_total" for n in values]
            self.rows = self.rows.selectExpr(*kept, *full)
        return self

    def row_number(self, name: str) -> Timeline:
        """1-based position of each row within its key."""
        local = F.row_number().over(self._window()).cast("long")
        if not self.sliced:
            self.rows = self.rows.withColumn(name, local)
            return self
        counts = self._per_slice(F.count(F.lit(1)).alias("_n"))
        carry = counts.select(*self.group, F.sum("_n").over(self._earlier()).alias("_before"))
        self.rows = self.rows.withColumn(name, local)
        self._attach(carry)
        self.rows = self.rows.withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0))).drop("_before")
        return self

    def then(self, step) -> Timeline:
        """Apply a DataFrame -> DataFrame step that keeps keys and order columns."""
        self.rows = step(self.rows)
        return self

    def done(self) -> DataFrame:
        return self.rows.drop("_at", "_slice", "_hot", "_spread")


def numbered(df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
    """``df`` with each row's 1-based position in one order over all rows.

    Rows are dealt into ranges of the order and written below ``spark.checkpoint.dir``, so that their range is fixed; positions inside a
    range are a window, and the ranges before it add up over one row per range. Rows equal in the whole order stay
    together, in any order.
    """
    spark = df.sparkSession
    columns = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    names = [f"_o{i}" for i in range(len(order))]
    path = work_folder(spark, "numbered")
    df.select("*", *columns).repartitionByRange(*names).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    before = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(ranges), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*names)).cast("long")
    return rows.withColumn("_local", local).join(F.broadcast(before), "_range").withColumn(
        name, F.col("_local") + F.col("_before")).drop("_range", "_local", "_before", *names)


def spread(left: DataFrame, right: DataFrame, keys: Sequence[str], spread_by: Sequence[str],
           bound: int | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Salt an equi-join: rows of a hot key on the left go to several tasks, the matching right rows to each of them.

    Returns both sides and the join columns. Without a hot key both sides come back unchanged.
    """
    bound = bound or ROWS_PER_SLICE
    hot = hot_keys(left, keys, bound)
    if not hot:
        return left, right, list(keys)
    schema = left.select(*keys).schema.simpleString()[7:-1] + ",_salts int"
    salts = F.broadcast(left.sparkSession.createDataFrame(
        [(*[r[k] for k in keys], -(-r["_rows"] // bound)) for r in hot], schema=schema
    ))
    salted = (
        left.join(salts, list(keys), "left")
        .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_salts")).cast("int"), F.lit(0)))
        .drop("_salts")
    )
    copies = (
        right.join(salts, list(keys), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return salted, copies, [*keys, "_salt"]


def micros(duration: str) -> int:
    """Microseconds of a duration such as ``5 minutes``."""
    amount, unit = duration.split()
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return round(float(amount) * seconds * 1_000_000)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
