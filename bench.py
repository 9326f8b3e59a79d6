"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from spendscope.plans import analyse, load  # noqa: E402
from spendscope.plans.queries import REGISTRY, TUNED  # noqa: E402
from spendscope.session import build_session  # noqa: E402
from spendscope.sources.sinks import write_csv  # noqa: E402
from spendscope.sources.testdata import transactions  # noqa: E402

# Every result table of one whole analysis, from load to comparison.
WHOLE = "whole_analysis"
TABLES = (
    "category_stats", "hourly_stats", "state_stats", "profiles", "flags", "users", "summary",
    "row_share", "comparison", "top_categories", "peak_hour", "over_represented",
)
# The same on 13 copies of the events in CSV, shifted in time: 1.3 million rows at scale 0.1,
# as many as the published runs have. In the skewed form a third of the rows are one user's.
CSV, SKEWED = "whole_analysis_csv", "whole_analysis_csv_skewed"
COPIES = 13

HEADLINE = (
    "features",
    "category_stats",
    "category_stats_ext",
    "hourly_stats",
    "state_stats",
    "user_profiles",
    "high_amount",
    "tx_gaps",
    "burst_users",
    "burst_users_window",
    "user_flags",
    "interesting_users",
    "interesting_summary",
    "segment_interesting",
    "segment_normal",
    "compare_category",
    "compare_all_dimensions",
    "variant_ratio",
    WHOLE,
    CSV,
    SKEWED,
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="spendscope-bench-")
    spark = build_session(
        f"local[{cpus}]",
        "spendscope-bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__driver__host="127.0.0.1",
        spark__checkpoint__dir=scratch,
    )
    spark.sparkContext.setLogLevel("ERROR")

    def write_source(name: str) -> str:
        rows = transactions(spark, sf_dir, with_state=True).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
        rows = rows.withColumns(
            {
                "trans_num": F.col("trans_num") * COPIES + F.col("copy"),
                "trans_date_trans_time": F.col("trans_date_trans_time") + F.make_dt_interval(F.col("copy") * 31),
            }
        )
        if name == SKEWED:
            rows = rows.withColumn("cc_num", F.when(F.col("trans_num") % 3 == 0, 1).otherwise(F.col("cc_num")))
        path = f"{scratch}/{name}.csv"
        write_csv(rows.drop("copy"), path)
        return path

    sources = {name: write_source(name) for name in names if name in (CSV, SKEWED)}

    def run(name: str) -> float:
        start = time.perf_counter()
        if name in REGISTRY:
            # Every row and column is computed, and nothing is kept.
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        else:
            rows = load(spark, sources[name]) if name in sources else transactions(spark, sf_dir, with_state=True)
            with analyse(rows, TUNED) as result:
                for table in TABLES:
                    getattr(result, table).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("category_stats")
    times = {}
    for name in names:
        times[name] = run(name)
        if name not in sources:
            times[name] = min(times[name], run(name))
    line = {
        "metric": "total seconds over the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
