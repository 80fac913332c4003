"""Print the formatted physical plan of registered queries, or a one-line
summary of their key operators with ``--summary``.

Usage: python tools/explain.py [--summary] SF_DIR name [name ...]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")

from quaystat.plans.registry import QUERIES  # noqa: E402
from quaystat.session import local_session  # noqa: E402

KEY_OPERATORS = [
    "WindowGroupLimit", "Window", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
    "HashAggregate", "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject", "Exchange",
    "Expand", "Generate", "BroadcastExchange",
]


def summary(plan: str) -> str:
    tree = plan.split("\n\n")[0]
    counts = {op: len(re.findall(rf"\b{op}\b[^\n(]*\(\d+\)", tree)) for op in KEY_OPERATORS}
    scans = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    pushed = [p for p in re.findall(r"PushedFilters: \[(.*?)\]", plan) if p]
    parts = [f"{op}×{n}" for op, n in counts.items() if n]
    return (
        f"{', '.join(parts)}; scans read {[len(s.split(',')) for s in scans]} columns; "
        f"pushed filters: {len(pushed)}"
    )


def main() -> None:
    args = sys.argv[1:]
    brief = args and args[0] == "--summary"
    if brief:
        args = args[1:]
    sf_dir, names = args[0], args[1:]
    spark = local_session(8, 16)
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        plan = buf.getvalue()
        print(f"{name}: {summary(plan)}" if brief else f"===== {name}\n{plan}")
    spark.stop()


if __name__ == "__main__":
    main()
