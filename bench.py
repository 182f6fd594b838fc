"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Every run ends in an action; after one warm-up the median of the runs counts. The long
jobs (streams and models) are run once after the warm-up of the session.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemill.registry import all_queries  # noqa: E402
from tidemill.session import build_session  # noqa: E402

HEADLINE = [
    "join_inner", "join_sort_merge", "join_shuffle_hash", "join_broadcast", "join_map_side",
    "join_salted", "join_hot_split", "join_full", "join_chain", "cogroup",
    "word_count", "word_count_by_key", "agg_sum_count", "agg_stats", "agg_salted", "agg_cube",
    "agg_two_level", "agg_collect_list", "agg_baskets", "dedup_cols", "distinct_rows",
    "win_running_range", "win_running_rows", "win_rank", "win_lag_lead", "topn_per_group",
    "longest_streak", "pivot_sum", "total_row", "pv_uv", "tag_lookup", "peaks_troughs",
    "user_level", "dashboard_batch", "log_parse", "sort_multi", "zip_index", "udf_dsl",
    "upsert_latest", "offset_clamp",
]
ONCE = [
    "stream_window_sum", "stream_running_count", "stream_dashboard", "exactly_once",
    "ml_linreg", "ml_kmeans", "ml_rf", "ml_als", "ml_fpgrowth",
]
# two tables of this many rows go into the shuffle joins at sf0.1
JOIN_ROWS = {"join_sort_merge": "lineitem", "join_shuffle_hash": "lineitem"}


# the sizes of the one published join, text parsing included
LEFT_LINES, RIGHT_LINES = 3_000_000, 200_001


def text_sides(spark, folder: str) -> tuple[str, str]:
    """Two folders of lines ``key<TAB>value``, written once."""
    left, right = f"{folder}/left", f"{folder}/right"
    key = f"concat(id % {RIGHT_LINES}, '\t', id)"
    spark.range(LEFT_LINES).selectExpr(f"{key} as value").write.text(left)
    spark.range(RIGHT_LINES).selectExpr("concat(id, '\t', uuid()) as value").write.text(right)
    return left, right


def join_texts(spark, left: str, right: str) -> float:
    """Read both, cut the lines and shuffle-join on the key."""
    start = time.perf_counter()
    sides = []
    for path, name in ((left, "a"), (right, "b")):
        cells = F.split("value", "\t")
        sides.append(spark.read.text(path).select(cells[0].alias("key"), cells[1].alias(name)))
    joined = sides[0].join(sides[1].hint("merge"), "key")
    joined.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(spark, query, root: str) -> float:
    start = time.perf_counter()
    query(spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    warehouse = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.warehouse.dir": warehouse,
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    queries = all_queries()
    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in HEADLINE + ONCE:
        try:
            if name in HEADLINE:
                timed(spark, queries[name], root)
            times = [timed(spark, queries[name], root) for _ in range(runs if name in HEADLINE else 1)]
            seconds[name] = round(statistics.median(times), 3)
        except Exception as error:  # one broken query must not hide the others
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
    left, right = text_sides(spark, f"{warehouse}/texts")
    join_texts(spark, left, right)
    seconds["join_text_3m"] = round(statistics.median(join_texts(spark, left, right) for _ in range(runs)), 3)
    rate = {"join_text_3m": round(LEFT_LINES / seconds["join_text_3m"])}
    for name, table in JOIN_ROWS.items():
        if name in seconds:
            rows = spark.read.parquet(f"{root}/{table}.parquet").count()
            rate[name] = round(rows / seconds[name])
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of the queries' times (median of runs)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rate,
                "failed": failed,
                "cpus": int(cpus),
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
