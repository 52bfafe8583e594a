"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from lakesift.probes import load_all  # noqa: E402
from lakesift.session import build  # noqa: E402

HEADLINES = [
    "d1_d3_line_rates", "c2_star_enrichment", "d19_ratio_of_sums", "d22_customer_season_percent",
    "d25_dashboard_slice", "f4_most_improved", "i3_primary_key_clean", "i3_primary_key_rejects",
    "i4_reference_clean", "i4_i5_table_outcomes", "i5_negative_clean", "i8_range_expectations",
    "i20_reconcile", "e1_key_count", "e2_keep_latest", "e3_surplus_rows", "e4_number_copies",
    "b13_running_number_key", "d6_duplicate_profile", "d7_null_counts", "d10_distinct_counts",
    "d13_quantiles", "d15_histogram", "c3_left_anti_orphans", "c4_left_semi_matched", "g1_distinct_rows",
    "a3_typed_csv", "a16_ingest_manifest", "a17_published_fact", "j6_upsert",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    wanted = sys.argv[1:] or HEADLINES
    spark = build(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    probes = load_all()
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for key in wanted:
        start = time.perf_counter()
        probes[key].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
