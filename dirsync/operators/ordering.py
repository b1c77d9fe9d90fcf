"""Sorts, first-and-last picks and numbering that hold up under skew.

Each of these would be a window over the whole table, or over one group that may
hold a third of it.  Here they are sorts with a unique tie-break, aggregates that
combine before the shuffle, or runs of a range-partitioned order, which are cut by
the number of rows, whatever the keys and however sparse the positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dirsync.session import materialise

from .lookups import lookup

# Why a run's copy is kept.
REASON_FIRST = "first sync of the day (UTC)"
REASON_CHANGED = "count changed: %d → %d (%s)"
REASON_ROUTINE = "routine sync (every backup committed for safety)"
REASON_LARGE = "significant change: %s (threshold: %s)"
REASON_SMALL = "routine sync, %s change (under %s threshold)"

#: Bins of one pass that looks for the n-th value.
BINS = 4096


def in_order(df: DataFrame, *order: Column | str) -> DataFrame:
    """The rows, sorted over range partitions and written, with ``__part`` and ``__row``, the place in the part.

    Parts follow one another in the order and have about the same number of rows;
    the order should end in a column that tells rows apart, as equal ones share a
    part.  The copy makes parts and places the same for every later step, also
    where a lost executor's work is done again.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(sorted_.withColumn("__id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__id", 33)
    return placed.withColumn("__part", part).withColumn("__row", F.col("__id") - F.shiftleft(part, 33)).drop("__id")


def _across_parts(*group: str):
    """A window over one row for each part (and group)."""
    return Window.partitionBy(*(group or [F.lit(0)])).orderBy("__part")


def numbered(df: DataFrame, out: str, *order: Column | str) -> DataFrame:
    """Number all rows 1, 2, … in the order, with a shift for each part of it."""
    rows = in_order(df, *order)
    before = _across_parts().rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    shifts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    # one row for each shuffle partition
    found = rows.join(F.broadcast(shifts), "__part").withColumn(out, F.col("__shift") + F.col("__row") + 1)
    return found.drop("__part", "__row", "__shift")


def nth_smallest(df: DataFrame, column: str, n: int) -> int | None:
    """The n-th smallest value of a whole-number column without sorting; null if there are fewer.

    Tasks count values in bins, the bin with the n-th value is cut again, until a
    bin is one value.  A pass brings at most ``BINS`` counts to the driver.
    """
    values = df.select(F.col(column).cast("decimal(20,0)").alias("v")).where("v IS NOT NULL")
    low, high, rows = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if n < 1 or rows < n:
        return None
    low, high, left = int(low), int(high), n
    while low < high:
        width = -(-(high - low + 1) // BINS)
        inside = values.where(F.col("v").between(low, high))
        bins = inside.groupBy(F.floor((F.col("v") - low) / width).cast("int").alias("bin")).count().orderBy("bin").collect()
        for b, count in bins:
            if left <= count:
                low, high = low + b * width, min(high, low + (b + 1) * width - 1)
                break
            left -= count
    return low


def first_rows(df: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    """The n rows with the smallest positions, which are unique; no task sees more of them than it read."""
    rows = materialise(df, "queue")
    last = nth_smallest(rows, pos, n)
    return rows if last is None else rows.where(F.col(pos) <= last)


def sort_name(df: DataFrame, photo_first: bool = False) -> DataFrame:
    """Order by lower-case name, ties by position (and by part, if there is one).

    The position makes the sort key unique, so one much repeated name is still
    split over many range partitions.
    """
    ties = [c for c in ("seq", "pos") if c in df.columns]
    first = [F.when(F.coalesce("photo", F.lit("")) != "", 0).otherwise(1)] if photo_first else []
    return df.orderBy(*first, F.lower("name"), *ties)


def sort_role(audit: DataFrame) -> DataFrame:
    return audit.orderBy("role", F.lower("name"), "pos")


def retain_n(snapshots: DataFrame, n: int, series: str = "series", ts: str = "ts", tie: str = "run_id") -> DataFrame:
    """Flag the newest ``n`` snapshots of every series as kept, the rest as to remove.

    ``row_number() <= n`` is cut to n rows per series in every task before the
    shuffle; the oldest row kept then gives a threshold per series, to which
    all rows are compared.
    """
    newest = Window.partitionBy(series).orderBy(F.desc(ts), F.desc(tie))
    top = snapshots.select(series, ts, tie).withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= n)
    floor = top.groupBy(F.col(series).alias("__s")).agg(F.min(F.struct(ts, tie)).alias("__floor"))
    return (
        lookup(snapshots, floor, F.col(series), "__s", pos=tie)
        .withColumn("keep", F.struct(ts, tie) >= F.col("__floor"))
        .drop("__floor")
    )


def first_of_day(runs: DataFrame, ts: str = "ts", tie: str = "run_id") -> DataFrame:
    """Flag the first run of every UTC day."""
    dated = runs.withColumn("day", F.to_date(ts))
    name = F.col("day").cast("string")
    first = dated.groupBy(name.alias("__day")).agg(F.min(F.struct(ts, tie)).alias("__first"))
    return (
        lookup(dated, first, name, "__day", pos=tie)
        .withColumn("first_of_day", F.coalesce(F.struct(ts, tie) == F.col("__first"), F.lit(False)))
        .drop("__first")
    )


def with_previous(runs: DataFrame, value: str, out: str, ts: str = "ts", tie: str = "run_id") -> DataFrame:
    """``lag`` over the whole history without one global window.

    The history is cut into parts of about equal size, so a day that holds all
    runs is cut as well.  Inside a part it is a plain ``lag``; the first row of a
    part takes the last value of the part before, one carried row for each part.
    """
    rows = in_order(runs, ts, tie)
    lagged = rows.withColumn("__lag", F.lag(value).over(Window.partitionBy("__part").orderBy("__row")))
    lasts = rows.groupBy("__part").agg(F.max_by(value, "__row").alias("__last"))
    before = lasts.select("__part", F.lag("__last").over(_across_parts()).alias("__before"))
    # one row for each shuffle partition
    return (
        lagged.join(F.broadcast(before), "__part")
        .withColumn(out, F.when(F.col("__row") == 0, F.col("__before")).otherwise(F.col("__lag")))
        .drop("__part", "__row", "__lag", "__before")
    )


def change_reason(runs: DataFrame, threshold: float | None = None) -> DataFrame:
    """Percent change of ``count`` against the run before, and why to keep a copy.

    With a ``threshold`` (0.05 is five percent) only larger changes count.
    """
    flagged = with_previous(first_of_day(runs), "count", "previous")
    prev = F.coalesce("previous", F.lit(0))
    change = F.try_divide(F.abs(F.col("count") - prev).cast("double"), F.nullif(prev, F.lit(0)).cast("double"))

    def percent(digits: int) -> Column:
        # format_number rounds the exact value, ties to even.
        return F.concat(F.replace(F.format_number(F.col("change") * 100, digits), F.lit(","), F.lit("")), F.lit("%"))

    if threshold is None:
        later = F.when(
            (prev > 0) & (F.col("count") != prev),
            F.format_string(REASON_CHANGED, prev, F.col("count"), percent(1)),
        ).otherwise(F.lit(REASON_ROUTINE))
        worthy = F.lit(True)
    else:
        large = (prev > 0) & (F.col("change") >= threshold)
        limit = F.lit(f"{threshold:.0%}")
        later = (
            F.when(large, F.format_string(REASON_LARGE, percent(0), limit))
            .when(prev > 0, F.format_string(REASON_SMALL, percent(1), limit))
            .otherwise(F.lit(""))
        )
        worthy = F.col("first_of_day") | large
    return flagged.withColumn("change", change).select(
        *flagged.columns,
        "change",
        F.when(F.col("first_of_day"), REASON_FIRST).otherwise(later).alias("reason"),
        worthy.alias("keep_copy"),
    )


def preview_k(df: DataFrame, k: int, *order: Column | str, columns: tuple[str, ...] = ("name", "email")) -> DataFrame:
    """First ``k`` rows in order, then one row that tells how many remain.

    A top-k and a count: no window sees more than ``k`` rows.
    """
    head = df.orderBy(*order).limit(k)
    ranked = head.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        *columns,
        F.lit(None).cast("bigint").alias("remaining"),
    )
    types = dict(df.dtypes)
    more = df.agg((F.count(F.lit(1)) - k).alias("remaining")).where(F.col("remaining") > 0)
    tail = more.select(
        F.lit(k + 1).alias("rank"),
        *[F.lit(None).cast(types[c]).alias(c) for c in columns],
        "remaining",
    )
    return ranked.unionByName(tail)


def distinct_reasons(flags: DataFrame) -> DataFrame:
    """The first row, by position, of every reason."""
    return flags.groupBy("reason").agg(F.min("pos").alias("pos"), F.min_by("name", "pos").alias("name"))


def number_rows(df: DataFrame, group: str, pos: str, out: str) -> DataFrame:
    """Number the rows of each group 1, 2, … in order of ``pos``.

    The order of group and position is cut into parts of about equal size, however
    sparse the positions; a group's rows in a part are shifted by its rows in the
    parts before.  There is one shift for each part and for each group.
    """
    rows = in_order(df, group, pos)
    key = F.coalesce(F.concat(F.lit("k"), F.col(group).cast("string")), F.lit("n"))
    rows = rows.withColumn("__key", key)
    sizes = rows.groupBy("__key", "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    before = _across_parts("__key").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1
    shifts = sizes.select("__key", "__part", shift.alias("__shift"))
    found = rows.join(shifts, ["__key", "__part"]).withColumn(out, F.col("__row") + F.col("__shift"))
    return found.drop("__key", "__part", "__row", "__shift")
