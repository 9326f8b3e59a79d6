"""``spark-submit`` entry: read transactions, run the analysis, write its tables.

    python -m spendscope --input hdfs:///data/transactions.csv /data/transactions.csv --output hdfs:///results

On a cluster, ``spark.checkpoint.dir`` must name a folder that all executors share.
"""

from __future__ import annotations

import argparse

from spendscope.params import Params
from spendscope.plans import analyse, load
from spendscope.session import build_session, drop_scratch
from spendscope.sources.landing import land_by_user


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    defaults = Params()
    parser = argparse.ArgumentParser(prog="spendscope")
    parser.add_argument("--input", nargs="+", required=True, help="paths; the first that exists is read")
    parser.add_argument("--output", required=True, help="folder for the result tables")
    parser.add_argument("--landing", help="folder for the input as Parquet in the order of user and time")
    parser.add_argument("--by-user", action="store_true", help="bucket the rows by user first, for totals without an exchange")
    parser.add_argument("--lenient", action="store_true", help="leave out lines that cannot be read instead of failing")
    parser.add_argument("--shuffle-partitions", type=int, help="shuffle width: about one for every 200 MB")
    parser.add_argument("--master", help="only outside spark-submit")
    parser.add_argument("--daily-rate", type=float, default=defaults.daily_rate)
    parser.add_argument("--amount-quantile", type=float, default=defaults.amount_quantile)
    parser.add_argument("--amount-method", default=defaults.amount_method)
    parser.add_argument("--amount-population", default=defaults.amount_population)
    parser.add_argument("--amount-decimals", type=int, help="decimals of the amounts, for exact sums")
    parser.add_argument("--distance-km", type=float, default=defaults.distance_km)
    parser.add_argument("--categories", type=int, default=defaults.categories)
    parser.add_argument("--gap", default=defaults.gap)
    parser.add_argument("--gap-seconds", type=int, default=defaults.gap_seconds)
    parser.add_argument("--short-gaps", type=int, default=defaults.short_gaps)
    parser.add_argument("--burst", default=defaults.burst)
    parser.add_argument("--window-transactions", type=int, default=defaults.window_transactions)
    parser.add_argument("--span", default=defaults.span)
    parser.add_argument("--null-bin", action="store_true")
    parser.add_argument("--distinct", default=defaults.distinct)
    parser.add_argument("--cache-features", action="store_true")
    parser.add_argument("--partitions", type=int, help="spread the rows over this many partitions first")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    params = Params(**{name: getattr(args, name) for name in Params.__dataclass_fields__})
    spark = build_session(args.master, partitions=args.shuffle_partitions)
    source = load(spark, *args.input, landing=args.landing, lenient=args.lenient)
    if args.by_user:
        source = land_by_user(source)
    with analyse(
        source, params, cache_features=args.cache_features, partitions=args.partitions
    ) as analysis:
        analysis.write(args.output)
        for row in analysis.summary.collect():
            print(f"{row['criterion']}: {row['users']:,} of {row['all_users']:,} ({row['percent']:.2f}%)")
    drop_scratch(spark)


if __name__ == "__main__":
    main()
