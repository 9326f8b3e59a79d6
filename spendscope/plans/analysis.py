"""The whole analysis: features, statistics, profiles, criteria, segments, comparison."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Literal

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscope.operators.criteria import interesting_summary, interesting_users, user_flags
from spendscope.operators.features import with_features
from spendscope.operators.profiles import FACETS, user_profiles, user_totals
from spendscope.operators.segments import DIMENSIONS, compare_totals, over_represented, row_share_of, split
from spendscope.operators.stats import busiest_hour, category_amounts, extend_category_stats, top_categories
from spendscope.operators.usertotals import dimension_stats, user_dimension_totals
from spendscope.params import Params
from spendscope.session import drop_scratch, scratch_mark, stored
from spendscope.sources.landing import Landed, land_once
from spendscope.sources.readers import read_csv, read_parquet, split_corrupt
from spendscope.sources.sinks import write_by_user, write_set


@dataclass
class Analysis:
    """Lazy results; write or read the ones you need, then call ``release``.

    ``category_stats`` has the median, deviation and mean distance, too.
    """

    transactions: DataFrame
    category_stats: DataFrame
    hourly_stats: DataFrame
    state_stats: DataFrame | None
    profiles: DataFrame
    flags: DataFrame
    users: DataFrame
    summary: DataFrame
    interesting: DataFrame
    normal: DataFrame
    row_share: DataFrame
    comparison: DataFrame
    top_categories: DataFrame
    peak_hour: DataFrame
    over_represented: DataFrame
    _cached: list[DataFrame] = field(default_factory=list)
    _mark: int | None = None
    _landed: Landed | None = None

    def release(self) -> None:
        """Drop cached rows and the tables in the scratch folder; results can't be read any more."""
        while self._cached:
            self._cached.pop().unpersist()
        if self._mark is not None:
            drop_scratch(self.transactions.sparkSession, self._mark)
            self._mark = None
        if self._landed is not None:
            self._landed.drop()
            self._landed = None

    def __enter__(self) -> Analysis:
        return self

    def __exit__(self, *_: object) -> None:
        self.release()

    def write(self, path: str) -> None:
        """Write each result table to its own folder below ``path``; all of them appear at once.

        A run that fails on the way leaves the set that was there before.
        """
        names = (
            "category_stats", "hourly_stats", "state_stats", "profiles", "flags", "users", "summary",
            "row_share", "comparison", "top_categories", "peak_hour", "over_represented",
        )
        tables = {name: getattr(self, name) for name in names}
        write_set({name: frame for name, frame in tables.items() if frame is not None}, path, optional=("state_stats",))


def load(
    spark: SparkSession, *paths: str, landing: str | None = None, lenient: bool = False, once: bool = True
) -> DataFrame:
    """Transactions from the first path that exists; CSV by its ending, else Parquet.

    Bad lines of CSV raise; with ``lenient`` they are left out (``read_csv`` can show them). CSV
    is parsed once, into a scratch table that later passes read by column; without ``once`` it
    is parsed anew in each pass.

    With ``landing`` the rows are written there as Parquet in the order of user and time: one
    shuffle, after which aggregates per user are combined before they are shuffled.
    """
    csv = all(p.endswith((".csv", ".csv.gz")) for p in paths)
    rows = read_csv(spark, *paths, lenient=lenient) if csv else read_parquet(spark, *paths)
    if csv and lenient:
        rows, _ = split_corrupt(rows)
    # Ranges are found on a sample of the rows, which is a pass of its own.
    if csv and once:
        rows = land_once(rows)
    if landing is None:
        return rows
    write_by_user(rows, landing)
    return read_parquet(spark, landing)


def analyse(
    df: DataFrame | Landed,
    params: Params = Params(),
    keep: Literal["table", "memory", "nothing"] = "table",
    cache_features: bool = False,
    partitions: int | None = None,
) -> Analysis:
    """Build every result of the analysis from four passes over the rows.

    The passes make the totals per user and value, the totals per user, the gaps, and the
    amounts per category, which the medians need. All other results, except the split rows
    themselves, come from those smaller tables.

    With ``keep='table'`` they are computed right here and written to the scratch folder, so
    nothing later repeats the work, joins know their sizes, and lost executors cost nothing.
    ``release`` drops them, and whatever else was stored in between.
    ``'memory'`` caches them on first use instead; with ``'nothing'`` each result starts over.

    Rows that were landed by user (``land_by_user``) give the users' totals without an exchange.

    Features are cheap to derive again from a columnar source. Caching them, and spreading
    the rows over ``partitions`` first, is for sources that are slow to read, such as CSV.
    """
    cached: list[DataFrame] = []
    mark = scratch_mark()

    def cache(frame: DataFrame) -> DataFrame:
        cached.append(frame.persist(StorageLevel.MEMORY_AND_DISK))
        return frame

    def kept(frame: DataFrame, name: str) -> DataFrame:
        if keep == "table":
            return stored(frame, name)
        return cache(frame) if keep == "memory" else frame

    landed = df if isinstance(df, Landed) else None
    rows = landed.rows if landed else df
    tx = with_features(rows.repartition(partitions) if partitions else rows, params)
    if cache_features:
        tx = cache(tx)
    dimensions = [d for d in DIMENSIONS if d in tx.columns]
    totals = kept(user_dimension_totals(tx, [*dict.fromkeys([*dimensions, *FACETS])], params), "totals")
    amounts = kept(category_amounts(tx, params), "category_amounts")
    summed = landed.per_user(lambda part: user_totals(with_features(part, params), params)) if landed else None
    profiles = kept(user_profiles(tx, params, totals=totals, summed=summed), "profiles")
    flags = kept(user_flags(profiles, tx, params), "flags")
    # The users are a table of their own, so that a join sees the size of the ids alone.
    users = kept(interesting_users(flags), "users")
    interesting, normal = split(tx, users)
    by_hour = dimension_stats(totals, "hour", "transaction_count").withColumn("hour", F.col("hour").cast("int"))
    by_category = dimension_stats(totals, "category", "total_transactions")
    by_state = dimension_stats(totals, "state", "transaction_count").drop("unique_users")
    by_category = extend_category_stats(by_category, amounts, params)
    comparison = compare_totals(totals.where(F.col("dimension").isin(*dimensions)), users)
    categories = comparison.where(F.col("dimension") == "category").withColumnRenamed("value", "category")
    return Analysis(
        transactions=tx,
        category_stats=by_category,
        hourly_stats=by_hour,
        state_stats=by_state if "state" in dimensions else None,
        profiles=profiles,
        flags=flags,
        users=users,
        summary=interesting_summary(flags),
        interesting=interesting,
        normal=normal,
        row_share=row_share_of(totals, users),
        comparison=comparison,
        top_categories=top_categories(by_category),
        peak_hour=busiest_hour(by_hour),
        over_represented=over_represented(categories),
        _cached=cached,
        _mark=mark if keep == "table" else None,
        _landed=landed,
    )
