"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default the sf0.1 tables) on ``local[BENCH_CPUS]``. A
query's time covers building the plan and running it into a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from offerloom.session import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "flagship_offers",
    "links_per_domain",
    "scl1_parse_price",
    "scl11_normalise_url",
    "pel1_page_elements",
    "ext7_offer_fields",
    "ext8_microdata_offer",
    "ext12_auto_extract",
    "ext17_rule_extract",
    "lnk3_drop_consecutive_dups",
    "lnk5_known_urls",
    "lnk7_dedupe_frontier",
    "lst2_popularity_rank",
    "lst3_popularity_by_page",
    "dtl1_merge_offer",
    "var3_number_variants",
    "var4_stamp_group",
    "err1_classify_pages",
    "rpt1_coverage",
    "rpt2_shortfall",
    "rpt3_found_missing",
    "rpt4_url_overlap",
    "snk2_to_messages",
    "snk1_write_offers",
    "str4_stream_popularity",
    "job_scrape_details",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
