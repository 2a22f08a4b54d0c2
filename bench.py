"""Time the named queries: ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]``, one JSON line on stdout.

The headline queries run by default; ``BENCH_KEYS`` picks others (comma separated, or
``all``). ``BENCH_RUNS`` is the number of timed runs per batch query after one warm-up.
Results go to a no-op sink, so every
column of every row is computed. Streaming queries run once: each of their runs
lands its slices anew.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace import session  # noqa: E402
from millrace.plans import all_cases  # noqa: E402

HEADLINE = """
src_text_lines src_delimited src_json_lines src_nested_json src_envelope src_archives
snk_keyed_upsert snk_parquet_json
prj_translate prj_tokens_flat prj_empty_to_zero prj_parent_into_child flt_sql_string flt_keyword_track
flt_exists_slice
join_inner join_cogroup join_left_anti join_left_outer join_lookup_chain join_stream_interval
agg_count_by_value agg_reduce_by_pair agg_avg_combiner agg_min_by agg_multi agg_rollup agg_cube
agg_dedup_subset agg_distinct agg_basket agg_sql_topk
stat_corr stat_crosstab stat_describe ord_top_n ord_by_value_desc set_except_both
st_tumbling st_sliding_avg st_running_count st_session_count
udf_lookup udf_aggregate
ml_col_stats ml_corr_spearman ml_chi_square ml_standard_scale ml_fp_growth ml_stream_linreg
graph_subgraph graph_pagerank
""".split()

STREAMED = (
    "src_stream_", "snk_text_per", "snk_parquet_per", "snk_append_log", "snk_foreach", "snk_keyed",
    "snk_table_per", "join_stream", "set_union_prev", "set_intersect", "set_except", "st_", "ml_stream",
)
ONCE = ("src_", "snk_", "ml_als", "ml_cross", "ml_forest", "graph_top", "graph_page")


def timed(case, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    case.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    cases = all_cases()
    picked = os.environ.get("BENCH_KEYS", "")
    keys = list(cases) if picked == "all" else [k for k in picked.split(",") if k] or HEADLINE
    spark = session.build(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__sql__warehouse__dir="/tmp/millrace-warehouse",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for key in keys:
        try:
            once = key.startswith(STREAMED) or key.startswith(ONCE)
            if not once:
                timed(cases[key], spark, sf_dir)
            found = [timed(cases[key], spark, sf_dir) for _ in range(1 if once else runs)]
            seconds[key] = round(statistics.median(found), 3)
        except Exception as failure:
            print(f"{key}: {str(failure)[:300]}", file=sys.stderr)
            seconds[key] = None
        print(f"{key} {seconds[key]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(s for s in seconds.values() if s is not None), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
