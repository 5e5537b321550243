"""Wall seconds of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores. Every query is
run to the end three times with its result thrown away, and the median counts; the first, untimed one only
warms the session up.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemill.catalog import QUERIES  # noqa: E402
from tidemill.session import local_session  # noqa: E402

HEADLINE = [
    "base_log_split", "fix_is_new", "unique_visitor", "user_jump", "dim_route", "order_detail_wide",
    "pay_success", "order_refund", "cart_add", "coupon_order", "comment_add",
    "kw_window", "traffic_window", "traffic_window_from_streams", "home_detail_uv_window", "login_window", "register_window",
    "cart_uu_window", "order_window", "payment_window", "province_window", "spu_order_window",
    "refund_window", "dedup_keep_last", "keyword_count",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), app="bench")
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("register_window")
    seconds = {name: round(median(run(name) for _ in range(3)), 3) for name in names}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
