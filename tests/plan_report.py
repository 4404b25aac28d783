"""Write PLANS.md: the physical-plan shape of every registered query.

    python tests/plan_report.py [sf_dir]

For each query: shuffle exchanges, broadcast exchanges, sort-merge joins, windows and
Python (Arrow) stages of the final DataFrame and of every table written while it is
built, whether a filter reached a parquet scan, and the key lists read.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import unitmesh.plans.joins as J  # noqa: E402
import unitmesh.plans.materialize as MZ  # noqa: E402
from unitmesh import build_session  # noqa: E402

NAMES = ("shuffles", "broadcasts", "sort-merge joins", "windows", "Python stages", "writes", "key reads")
COUNTS = dict.fromkeys(NAMES, 0)
PUSHED = [False]


def _count(df) -> None:
    """Add the shape of one plan, final or eagerly written."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    p = buf.getvalue().split("\n\n")[0]  # the operator tree
    COUNTS["shuffles"] += len(re.findall(r"(?<!Broadcast)Exchange \(", p))
    COUNTS["broadcasts"] += p.count("BroadcastExchange (")
    COUNTS["sort-merge joins"] += p.count("SortMergeJoin")
    COUNTS["windows"] += len(re.findall(r"\bWindow \(", p))
    COUNTS["Python stages"] += len(re.findall(r"ArrowEvalPython|MapInArrow", p))
    PUSHED[0] |= bool(re.search(r"PushedFilters: \[[^\]]*(EqualTo|In\(|GreaterThan|LessThan)", buf.getvalue()))


def _wrap():
    """Count what the queries write and read while they are built."""
    def writes(real):
        def write(df, *a, **k):
            COUNTS["writes"] += 1
            _count(df)
            return real(df, *a, **k)
        return write

    def keys(*a, **k):
        COUNTS["key reads"] += 1
        return real_keys(*a, **k)

    real_keys = J.key_values
    swaps = {MZ.materialize: writes(MZ.materialize), J.key_values: keys}
    with contextlib.suppress(ImportError):
        from unitmesh.llm import common
        swaps[common.written] = writes(common.written)
    for module in [m for n, m in sys.modules.items() if n.startswith("unitmesh") or n == "corpus_pipeline"]:
        for name, value in list(vars(module).items()):
            if callable(value) and getattr(value, "__hash__", None) and value in swaps:
                setattr(module, name, swaps[value])


def main(argv):
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    from __spark_entry__ import queries
    from unitmesh.plans import fixtures as fx
    from unitmesh.plans.q_registry import nested_units

    for n in fx.FIXTURES:
        fx.load(spark, sf, n)
    nested_units(spark, sf)
    _wrap()
    lines = ["# Physical plans of the registered queries", "",
             f"Data: `{sf}`, local[8], AQE on, default broadcast settings. Counts are sums over the final",
             "DataFrame and every table written while the query is built, from `explain(\"formatted\")`",
             "before execution (AQE may still turn a sort-merge join into a broadcast or split a skewed",
             "partition at run time). *writes* = tables written to the checkpoint folder; *key reads* =",
             "short key lists read to become scan filters. Generated by `tests/plan_report.py`.", "",
             "| query | " + " | ".join(NAMES) + " | filter pushed to scan |", "| --- " * (len(NAMES) + 2) + "|"]
    for name, fn in queries().items():
        COUNTS.update(dict.fromkeys(NAMES, 0))
        PUSHED[0] = False
        _count(fn(spark, sf))
        lines.append(f"| {name} | " + " | ".join(str(COUNTS[n]) for n in NAMES) + f" | {'yes' if PUSHED[0] else '-'} |")
        print(lines[-1], flush=True)
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
