"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data and
the local cores.  Every query is run to its full result through the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from catalog import load  # noqa: E402
from fieldcast.session import build_session  # noqa: E402

HEADLINE = (
    "jn_01_star_schema", "agg_01_daily_weather", "agg_04_monthly_weather",
    "agg_05_city_profile", "agg_06_season_shift", "win_02_renewable_rank",
    "agg_55_shift_by_season", "win_04_trend", "win_08_stratified_flag", "jn_02_build_fact",
    "agg_19_hourly_coverage", "agg_20_quality_report", "agg_24_city_profile_full",
    "agg_25_describe_plus", "agg_28_iqr_outliers_by_city", "agg_31_yearly_trend",
    "win_06_onset_7d", "jn_06_crop_weather_match", "scl_22_suitability", "ml_07_pearson_pairs",
    "ml_08_spearman", "ml_13_vif", "ml_15_linear_trend", "ml_06_score_nearest",
    "jn_14_point_in_polygon", "jn_15_nearest_polygon", "txt_01_chunks",
    "txt_04_similarity_topk", "txt_05_keyword_topk", "dq_06_orphans",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = load().QUERIES
    # one small query warms up the session, so that the first timing is not the start-up
    queries["agg_01_daily_weather"](spark, sf).limit(1).collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, total time",
                      "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")),
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
