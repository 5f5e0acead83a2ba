"""Command line with the reference's two switches:

    python -m fimloom --collect_funcs <source_dir> <functions.jsonl>
    python -m fimloom --function_process <functions.jsonl> <sample_num> <fim.jsonl>

Both may be given; collect runs first.  Outputs are JSON-lines directories.  The master comes from
``spark-submit`` / the environment (``FIMLOOM_MASTER`` for a quick local run).
"""

from __future__ import annotations

import argparse
import os

from .plans.collect import collect_functions
from .plans.process import function_process
from .session import build_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="fimloom")
    ap.add_argument("--collect_funcs", nargs=2, metavar=("SOURCE_DIR", "OUTPUT"))
    ap.add_argument("--function_process", nargs=3, metavar=("INPUT", "SAMPLE_NUM", "OUTPUT"))
    args = ap.parse_args(argv)
    spark = build_session(os.environ.get("FIMLOOM_MASTER"))
    if args.collect_funcs:
        collect_functions(spark, args.collect_funcs[0], args.collect_funcs[1])
    if args.function_process:
        src, n, out = args.function_process
        function_process(spark, src, int(n), out)


if __name__ == "__main__":
    main()
