"""Ranks, predecessors and moving frames without a one-task window.

A window over a whole table runs in one task.  The helpers here work in two
steps instead: windows inside buckets that follow the order, and a small table
with one row per bucket that carries what crosses from bucket to bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newslake.session import cut_lineage

BUCKET = "_bucket"


def number_rows(
    df: DataFrame, coarse: Sequence[Column], fine: Sequence[Column | str], name: str = "row_no", start: int = 1
) -> DataFrame:
    """Consecutive numbers in the order ``(*coarse, *fine)``.

    ``coarse`` cuts the table into buckets that are already in order; only the
    bucket sizes are summed up in one place.
    """
    bucketed = df.withColumn(BUCKET, F.struct(*[c.alias(f"c{n}") for n, c in enumerate(coarse)]))
    sizes = bucketed.groupBy(BUCKET).agg(F.count("*").alias("_size"))
    before = W.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(BUCKET, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(W.partitionBy(BUCKET).orderBy(*fine))
    return (
        bucketed.withColumn("_inside", inside)
        .join(offsets, BUCKET)
        .withColumn(name, F.col("_offset") + F.col("_inside") + F.lit(start - 1))
        .drop(BUCKET, "_inside", "_offset")
    )


def number_sorted(df: DataFrame, order: Sequence[Column], name: str = "row_no", start: int = 1) -> DataFrame:
    """Consecutive numbers in an order that has no natural buckets.

    Ranges of the order, of about even size whatever the values are, serve as buckets.
    They are sampled, so the table is cut off from its lineage: sizes and rows must
    see the same ones.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    return number_rows(cut_lineage(ranged), [F.col("_range")], order, name, start).drop("_range")


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str, weight: str, share: int = 1000) -> DataFrame:
    """Left join of rows with one row per key, in which no key is too much for a task.

    ``per_key`` is made from the rows, so adaptive execution cannot split a hot key of
    this join.  Keys with over one ``share``-th of the total ``weight`` are fewer than
    ``share``: their rows of ``per_key`` travel by broadcast, and the rows that found
    theirs are spread over the shuffle of the others.
    """
    total = per_key.agg(F.sum(weight)).scalar()
    values = F.struct(*[c for c in per_key.columns if c != key])
    heavy = F.col(weight) * share > total
    hot = F.broadcast(per_key.filter(heavy).select(key, values.alias("_hot")))
    found = F.col("_hot").isNotNull()
    spread = rows.join(hot, key, "left").withColumns({
        "_key": F.when(~found, F.col(key)),
        "_salt": F.when(found, F.monotonically_increasing_id() % share).otherwise(F.lit(-1)),
    })
    cold = per_key.filter(~heavy).select(
        F.col(key).alias("_key"), F.lit(-1).cast("long").alias("_salt"), values.alias("_cold")
    )
    both = spread.join(cold, ["_key", "_salt"], "left").withColumn("_value", F.coalesce("_hot", "_cold"))
    return both.select(*rows.columns, *[F.col(f"_value.{c}").alias(c) for c in per_key.columns if c != key])


def running_totals(
    df: DataFrame, coarse: Column, order: Column | str, sums: dict[str, str], keys: Sequence[str] = ()
) -> DataFrame:
    """Add running sums ``{new column: summed column}`` in time order, per series."""
    bucketed = df.withColumn(BUCKET, coarse)
    group = [*keys, BUCKET]
    per_bucket = bucketed.groupBy(*group).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    before = W.partitionBy(*keys).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *group, *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums]
    )
    upto = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    inside = bucketed.select("*", *[F.sum(c).over(upto).alias(f"_in_{n}") for n, c in sums.items()])
    joined = inside.join(offsets, group)
    return joined.select(
        *df.columns, *[(F.col(f"_{n}") + F.col(f"_in_{n}")).alias(n) for n in sums]
    )


def exact_medians(df: DataFrame, value: str, keys: Sequence[str] = (), width: int = 1000, name: str = "median") -> DataFrame:
    """The median of a whole-numbered column per key, by counts of equal values.

    Values are counted in map tasks, counts are summed up in ranges of ``width`` values and
    from range to range, and the one or two values in the middle are picked.  No task
    holds all values of a key.
    """
    named = df.filter(F.col(value).isNotNull()).withColumn("_all", F.lit(0))
    group = [*keys, "_all"]
    counts = named.groupBy(*group, value).agg(F.count("*").alias("_n"))
    upto = running_totals(counts, F.floor(F.col(value) / width), value, {"_upto": "_n"}, group)
    total = F.sum("_n").alias("_total")
    # Without keys there is one total: a join on the constant alone would be a cross join.
    known = upto.join(counts.groupBy(*group).agg(total), group) if keys else upto.withColumn("_total", counts.agg(total).scalar())

    def holds(place: Column) -> Column:
        return F.max(F.when((F.col("_upto") >= place) & (F.col("_upto") - F.col("_n") < place), F.col(value)))

    lower, upper = F.floor((F.col("_total") + 1) / 2), F.floor(F.col("_total") / 2) + 1
    middle = (holds(lower) + holds(upper)) / 2
    return known.groupBy(*group).agg(middle.alias(name)).drop("_all")


def with_previous(
    df: DataFrame, coarse: Column, order: str, columns: dict[str, str], keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``{new column: column}`` taken from the row before, per series."""
    bucketed = df.withColumn(BUCKET, coarse)
    group = [*keys, BUCKET]
    row = F.struct(*columns.values())
    lasts = bucketed.groupBy(*group).agg(F.max_by(row, F.col(order)).alias("_last"))
    earlier = F.lag("_last").over(W.partitionBy(*keys).orderBy(BUCKET))
    carried = lasts.select(*group, earlier.alias("_carried"))
    inside = bucketed.withColumn("_prev", F.lag(row).over(W.partitionBy(*group).orderBy(order)))
    joined = inside.join(carried, group).withColumn("_prev", F.coalesce("_prev", "_carried"))
    return joined.select(*df.columns, *[F.col(f"_prev.{c}").alias(n) for n, c in columns.items()])


def trailing_frames(
    df: DataFrame, ts: str, frames: dict[str, int], value: str, sums: dict[str, str], keys: Sequence[str] = ()
) -> DataFrame:
    """Add what the last so many seconds before each row hold, for ``frames {name: seconds}``.

    Each frame gives ``<name>_n``, the sums ``<name>_<new column>`` of ``sums {new column:
    column}``, and ``<name>_first`` and ``<name>_last`` of ``value``.  Frames exclude the row
    itself, rows of the same time, and any row exactly as old as the frame is long; of
    several rows of one time the smallest value is the first and the largest the last.

    A frame is the difference of two running totals.  The times of a series and the
    borders of all frames are sorted together into ranges of even size, so a series may
    hold all rows and a frame any number of them; one row per series and range carries
    totals from range to range.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    keyed = df.withColumn("_key", F.struct(*keys, F.lit(0).alias("_"))).withColumn("_at", micros)
    own = [F.count("*").alias("n"), *(F.sum(c).alias(f"s_{new}") for new, c in sums.items())]
    points = keyed.groupBy(F.col("_key").alias("key"), F.col("_at").alias("at")).agg(
        *own, F.min(value).alias("low"), F.max(value).alias("high")
    )
    totals = ["n", *(f"s_{new}" for new in sums)]
    none = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in (*totals, "low", "high")]
    borders = [F.struct(F.lit(name).alias("frame"), (F.col("at") - s * 1_000_000 + 1).alias("q")) for name, s in frames.items()]
    asked = points.select("key", F.col("at").alias("since"), F.explode(F.array(F.struct(F.lit("").alias("frame"), F.col("at").alias("q")), *borders)).alias("b"))
    asked = asked.select("key", F.col("b.q").alias("at"), F.lit(0).alias("kind"), "since", "b.frame", *none)
    held = points.select("key", "at", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("since"), F.lit(None).cast("string").alias("frame"), *totals, "low", "high")
    ranged = cut_lineage(asked.unionByName(held).repartitionByRange("key", "at", "kind").withColumn("range", F.spark_partition_id()))

    parts = ranged.groupBy("key", "range").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals],
        F.max_by("high", F.when(F.col("kind") == 1, F.col("at"))).alias("last"),
        F.min_by("low", F.when(F.col("kind") == 1, F.col("at"))).alias("first"),
    )
    series = W.partitionBy("key").orderBy("range")
    before, behind = series.rowsBetween(W.unboundedPreceding, -1), series.rowsBetween(1, W.unboundedFollowing)
    carried = parts.select(
        "key",
        "range",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in totals],
        F.last("last", ignorenulls=True).over(before).alias("before_last"),
        F.first("first", ignorenulls=True).over(behind).alias("behind_first"),
    )
    inside = W.partitionBy("key", "range").orderBy("at", "kind")
    upto, onward = inside.rowsBetween(W.unboundedPreceding, 0), inside.rowsBetween(0, W.unboundedFollowing)
    seen = ranged.select(
        "key", "range", "kind", "since", "frame",
        *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(c) for c in totals],
        F.last("high", ignorenulls=True).over(upto).alias("last"),
        F.first("low", ignorenulls=True).over(onward).alias("first"),
    )
    answers = seen.filter("kind = 0").join(carried, ["key", "range"]).select(
        "key",
        "since",
        "frame",
        *[(F.col(c) + F.col(f"before_{c}")).alias(c) for c in totals],
        F.coalesce("last", "before_last").alias("last"),
        F.coalesce("first", "behind_first").alias("first"),
    )

    def of(frame: str, column: str) -> Column:
        return F.max(F.when(F.col("frame") == frame, F.col(column)))

    found = []
    for name in frames:
        differences = {c: of("", c) - of(name, c) for c in totals}
        some = differences["n"] > 0
        found += [differences["n"].alias(f"{name}_n"), *(differences[f"s_{new}"].alias(f"{name}_{new}") for new in sums)]
        found += [F.when(some, of(name, "first")).alias(f"{name}_first"), F.when(some, of("", "last")).alias(f"{name}_last")]
    per_time = answers.groupBy(F.col("key").alias("_key"), F.col("since").alias("_at")).agg(*found)
    return keyed.join(per_time, ["_key", "_at"]).drop("_key", "_at")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key.

    Filtering a row number lets Spark cut every key down to one row in each map
    task, so a hot key is small before it is shuffled.
    """
    return top_per_key(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
