"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion through the ``noop`` sink (full computation, nothing collected to the
driver).  One warm-up run of the collect step precedes the timed runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fimloom.session import build_session  # noqa: E402
from fimloom.plans import registry  # noqa: E402

HEADLINE = [
    "extract_functions",       # stage 1: scan, tokenize, blocks, function rows
    "function_process",        # stage 2: the full strategy mixture over every function
    "fim_single_line",
    "fim_expression_statement",
    "fim_binary_expression",
    "fim_if_block",
    "fim_loop_block",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    qs = registry.queries()
    run(qs["extract_functions"](spark, sf_dir))          # warm-up (JIT, file cache)
    times = {}
    rows = {}
    # stage 1 written once (as the collect step writes its JSONL); stage-2 queries read it
    t0 = time.time()
    registry.functions(spark, sf_dir)
    times["collect_write"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        run(df)
        times[name] = round(time.time() - t0, 3)
    n_funcs = registry.functions_lazy(spark, sf_dir).count()
    n_files = registry.c_files(spark, sf_dir).count()
    rows["functions"] = n_funcs
    rows["files"] = n_files
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec_headline_queries",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "rows": rows,
        "functions_per_sec_mixture": round(n_funcs / times["function_process"], 1),
        "functions_per_sec_end_to_end": round(n_funcs / (times["collect_write"] + times["function_process"]), 1),
        "files_per_sec_collect": round(n_files / times["extract_functions"], 1),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
