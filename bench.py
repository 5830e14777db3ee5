"""Time the headline queries. Prints one JSON line.

The first entry is the refresh of the warehouse from raw text, which the other queries then read. Each query is run
``BENCH_RUNS`` times into a sink that reads every row and keeps none; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.inputs import warehouse  # noqa: E402
from checks.registry import queries  # noqa: E402
from tiffin.session import session  # noqa: E402

HEADLINE = """
order_enriched fct_order_enhanced scd2_customer restaurant_advanced_kpi agent_efficiency_kpi city_search_to_order
restaurant_feedback_kpi customer_experience_kpi agent_feedback_kpi daily_city_kpi daily_city_kpi_stream
q1_city_kpi q2_top_restaurants q3_problem_restaurants q4_cuisine_city q5_segment_kpi q6_prime_kpi q7_agent_perf
q8_feedback_dist q9_commission_city q10_secure_restaurants dash_overview dash_daily dash_order_detail
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return time.perf_counter() - start

    seconds = {"refresh_warehouse": timed(lambda: warehouse(spark, sf_dir))}
    registered = queries()
    for name in names:
        run = lambda q=registered[name]: q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = statistics.median(timed(run) for _ in range(runs))
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
