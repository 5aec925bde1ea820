"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "x1_nearest_existing", "x3_second_pass", "t1_outcomes", "a11_source_yield", "t4_fresh_items", "j4_unseen",
    "w3_newest_hashes", "w6_trailing_counters", "e1_classify", "e1_standard_rules", "e6_fill_missing", "q7_strict",
    "a14_validation_totals", "a6_statistics", "k3_category_rows", "f5_search_text", "j2_match_rules", "u2_all_findings",
    "g5_sustained_metric", "s11_crawl_links", "x4_header_sections", "x4_selected_items", "c8_strip_html",
    "p7_service_contexts", "k2_service_envelopes", "h7_overall",
)


def main():
    from pyspark.sql import SparkSession

    from checks import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("bench")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", cores)
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "16g")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/documents.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in chosen:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
