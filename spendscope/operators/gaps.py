"""Time between a user's successive transactions.

All users take the same way, however many rows they have. Counts group rows into cells of time
first, with partial aggregation on the map side. Gaps per row range-partition the rows by user
and time, and each partition takes over the last time of the user it continues.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendscope.functions import MICROS, epoch_micros, epoch_seconds, is_local
from spendscope.params import Params
from spendscope.session import stored

TIME = "trans_date_trans_time"


def _cell(t: Column, width: int) -> Column:
    return t - F.pmod(t, F.lit(width))


def short_gap_counts(df: DataFrame, params: Params = Params()) -> DataFrame:
    """How many gaps below ``gap_seconds`` the users have; users without any are absent.

    Times fall into cells as wide as the limit. All gaps within a cell are short, so a cell
    of n rows holds n - 1 of them. A gap across a border can only be short between adjacent
    cells, where it is the first time of one less the last time of the other. So each row
    counts in its own cell and shows its time to the next one, and grouping by cell is all
    it takes: nothing is sorted, and no task sees more of a user than some of the cells.
    """
    exact = params.gap == "exact"
    limit = params.gap_seconds * (MICROS if exact else 1)
    ts, local = F.col(TIME), is_local(df, TIME)
    own = F.col("side") == "own"
    cells = (
        df.where(ts.isNotNull())
        .select("cc_num", (epoch_micros(ts, local) if exact else epoch_seconds(ts, local)).alias("t"))
        .withColumn("own", _cell(F.col("t"), limit))
        .withColumn("next", F.col("own") + limit)
        .unpivot(["cc_num", "t"], ["own", "next"], "side", "cell")
        .groupBy("cc_num", "cell")
        .agg(
            F.count_if(own).alias("n"),
            F.min(F.when(own, F.col("t"))).alias("first"),
            F.max(F.when(~own, F.col("t"))).alias("last_before"),
        )
    )
    across = F.coalesce((F.col("first") - F.col("last_before") < limit).cast("int"), F.lit(0))
    return (
        cells.where(F.col("n") > 0)
        .withColumn("short", F.col("n") - 1 + across)
        .where(F.col("short") > 0)
        .groupBy("cc_num")
        .agg(F.sum("short").alias("short_gaps"))
    )


def burst_users(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Users with enough short gaps over their whole history."""
    return short_gap_counts(df, params).where(F.col("short_gaps") >= params.short_gaps).select("cc_num")


def window_burst_users(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Users with ``window_transactions`` or more within ``gap_seconds`` at some moment.

    A cell as wide as the limit that holds m rows settles its user at once. Any other such
    moment spans two adjacent cells, each with fewer rows, so single times are only looked at
    in adjacent cells that hold enough rows together: fewer than 2m rows, counted by instant.
    Cells are compared by adding each one's count to the next one, without ordering them.
    """
    m, limit = params.window_transactions, params.gap_seconds * MICROS
    ts, local = F.col(TIME), is_local(df, TIME)
    instants = (
        df.where(ts.isNotNull())
        .groupBy("cc_num", epoch_micros(ts, local).alias("t"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("cell", _cell(F.col("t"), limit))
    )
    cells = instants.groupBy("cc_num", "cell").agg(F.sum("n").alias("n"))
    full = cells.where(F.col("n") >= m).select("cc_num")
    side = F.col("side") == "own"
    pairs = (
        cells.select("cc_num", "n", F.col("cell").alias("own"), (F.col("cell") + limit).alias("next"))
        .unpivot(["cc_num", "n"], ["own", "next"], "side", "pair")
        .groupBy("cc_num", "pair")
        .agg(F.sum(F.when(side, F.col("n"))).alias("own"), F.sum(F.when(~side, F.col("n"))).alias("before"))
        .where((F.col("own") < m) & (F.col("before") < m) & (F.col("own") + F.col("before") >= m))
        .select("cc_num", "pair", F.explode(F.array(F.col("pair"), F.col("pair") - limit)).alias("cell"))
    )
    # An instant may belong to two pairs; a pair has an instant at most once.
    near = pairs.withColumnsRenamed({"cc_num": "__cc_num", "cell": "__cell"})
    times = instants.join(near, F.col("cc_num").eqNullSafe(F.col("__cc_num")) & (F.col("cell") == F.col("__cell")))
    within = Window.partitionBy("cc_num", "pair").orderBy("t").rangeBetween(-limit, 0)
    across = times.withColumn("close", F.sum("n").over(within)).where(F.col("close") >= m).select("cc_num")
    return full.union(across).distinct()


def user_time_ranges(df: DataFrame) -> DataFrame:
    """The rows range-partitioned by user, time and transaction, as a scratch table; this runs a job.

    ``__part`` numbers the partitions in that order, ``__row`` the rows in any order. As the row number
    takes part in the ranges, neither a heavy user, nor an instant, nor missing times, nor copies
    of one transaction fill a partition.
    """
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange("cc_num", TIME, "trans_num", "__row")
    return stored(ranged.withColumn("__part", F.spark_partition_id()), "user-time-ranges")


def carried_times(ranges: DataFrame) -> DataFrame:
    """Rows (cc_num, __part, carried): the user's last time before the partition, where there is one.

    Only the first user of a partition can have rows in an earlier one, so there are fewer rows
    than partitions, whatever the number of users.
    """
    ends = ranges.where(F.col(TIME).isNotNull()).groupBy("cc_num", "__part").agg(F.max(TIME).alias("end"))
    earlier = Window.partitionBy("cc_num").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return ends.select("cc_num", "__part", F.max("end").over(earlier).alias("carried")).where(F.col("carried").isNotNull())


def with_gaps(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Every row with ``time_diff``, the time since the user's previous transaction.

    Rows are ordered by time, then ``trans_num`` (NULL first), so of several rows at one
    instant exactly one shows the gap and the others 0; of copies of the first transaction it
    is any one of them. The first row of a user and rows without a time have NULL. Seconds are
    whole by default; ``gap='exact'`` gives a fraction.

    Rows are written in ranges of user and time. Within a range a row follows the one before;
    the first row of a range takes the time carried from earlier ranges.
    """
    ts, local, exact = F.col(TIME), is_local(df, TIME), params.gap == "exact"

    def since(previous: Column) -> Column:
        if exact:
            return (epoch_micros(ts, local) - epoch_micros(previous, local)) / F.lit(float(MICROS))
        return epoch_seconds(ts, local) - epoch_seconds(previous, local)

    ranges = user_time_ranges(df)
    order = Window.partitionBy("cc_num", "__part").orderBy(TIME, "trans_num", "__row")
    placed = ranges.withColumn("within", F.lag(TIME).over(order))
    # One row per partition at most: it goes to every task.
    carried = F.broadcast(carried_times(ranges).withColumnsRenamed({"cc_num": "__user", "__part": "__from"}))
    joined = placed.join(carried, F.col("cc_num").eqNullSafe(F.col("__user")) & (F.col("__part") == F.col("__from")), "left")
    gap = F.when(ts.isNotNull(), since(F.coalesce("within", "carried")))
    return joined.select(*df.columns, gap.alias("time_diff"))
