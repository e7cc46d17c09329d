"""Headline queries, timed one by one.  Prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores.
Every query runs to the end into a sink that discards rows, so nothing is cut
short and nothing is collected.
"""

from __future__ import annotations

import json
import os
import re
import time

from jobtide.checks.frames import Frames
from jobtide.checks.queries import QUERIES
from jobtide.operators import analytics
from jobtide.operators.items import requirement_items
from jobtide.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "top_tools_by_role",
    "upsert_postings",
    "posting_metadata",
    "curated_jobs",
    "map_titles",
    "map_titles_by_join",
    "missing_descriptions",
    "page_plain_text",
    "page_main_container",
    "requirement_section",
    "extract_terms",
    "parse_responses",
    "job_requirements",
    "jobs_requiring_tool",
    "role_similarity",
    "length_histogram",
    "reduction_histogram",
    "postings_by_month_flagged",
)
# Timed beside the headline and not part of its total.
ALSO = (
    "career_gap",
    "extract_terms_by_join",
    "insert_if_absent",
    "role_skill_gap",
    "stream_ingest_keys",
    "upsert_requirements",
)


def main() -> None:
    spark = build_session(
        "jobtide-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        # Small tables: keep every core busy rather than gather them in few tasks.
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    also = () if os.environ.get("BENCH_QUERIES") else ALSO
    runs = int(os.environ.get("BENCH_RUNS", "1"))

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](Frames(spark, SF_DIR)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def timed(name: str) -> float:
        run(name)  # warm-up: class loading and code generation
        return round(sorted(run(name) for _ in range(runs))[(runs - 1) // 2], 3)

    def stored_analytics() -> dict[str, float]:
        """Analytics over tables that an earlier run has stored: nothing but the stored tables is read."""
        tables = Frames(spark, SF_DIR).stored
        items = requirement_items(tables["job_requirements"])
        found = {}
        for name in ("top_tools_by_role", "role_similarity"):
            start = time.perf_counter()
            getattr(analytics, name)(items, tables["jobs"]).write.format("noop").mode("overwrite").save()
            found[f"stored:{name}"] = round(time.perf_counter() - start, 3)
        return found

    seconds = {name: timed(name) for name in names}
    others = {name: timed(name) for name in also} | (stored_analytics() if also else {})
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "also": others,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
