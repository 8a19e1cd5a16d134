"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` a
comma-separated list of other query names (``all`` for every registered query)."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from agentlake.plans import load_all
from agentlake.plans.registry import QUERIES, as_entry
from agentlake.session import local_session

HEADLINE = (
    "session_summary f01_drop_command_wrappers f04_redact_records f06_strict_milestone f09_mutating_command f18_handle_key w04_session_title w05_title_state w06_record_size w07_slices "
    "w09_stop_at_first_failure r03_size_profile c06_codex_to_records c12_usage_deltas c17_hash_tree_walk c18_cursor_to_records s04_parse_jsonl s12_build_imports "
    "j01_route_sessions j03_resolve_brains d04_match_directives d06_drop_fired d07_first_touch a02_governing_artifacts a07_lineage a12_version_diff "
    "h05_merge_state h07_dormancy h09_pick_ack l01_fold_board l06_board_delta m01_search m05_sweep st02_import_merge st06_once_per_session "
    "s01_read_claude s02_read_codex d05_rank_directives d12_render_directives st03_drain st04_debounce st05_dormancy_stream st07_board_stream st08_health_stream st11_throttle"
).split()


def main() -> None:
    load_all()
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "agentlake-bench")
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        as_entry(name)(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )


if __name__ == "__main__":
    main()
