"""Times the headline queries, the median of three runs of each, the first of which warms up; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollcall.plans import registry  # noqa: E402
from rollcall.session import session  # noqa: E402

HEADLINE = (
    "ballot_filter_page session_rollup member_stats left_default_counts band_join_first containment_join overlap_join keep_best_exact keep_best_frame keep_best_normalized "
    "carry_longest conditional_group_drop adjacent_fold consolidate_group year_rollup tally_from_choices topic_histogram normalize_ultra choice_lines seat_inference validate_issues html_markers"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session("bench", os.environ.get("BENCH_CPUS", "*"))
    took = {}
    for name in HEADLINE:
        times = []
        for _ in range(3):
            began = time.perf_counter()
            registry.load()[0][name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        took[name] = round(sorted(times)[1], 4)  # the first run warms up
    print(json.dumps({"metric": "headline queries, sum of median seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
