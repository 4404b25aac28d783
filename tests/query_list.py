"""Write QUERIES.md: every registered query with its description (SURVEY ids included)."""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def main() -> None:
    lines = ["# Registered queries", "",
             "Every entry of `queries()` in `__spark_entry__.py`, and whether `oracle_sql()` has its DuckDB SQL.",
             "Generated by `tests/query_list.py`.", "",
             "| query | what it runs | oracle |", "| --- | --- | --- |"]
    oracles = oracle_sql()
    for name, fn in queries().items():
        lines.append(f"| {name} | {' '.join((fn.__doc__ or '').split())} | {'yes' if name in oracles else '-'} |")
    with open(os.path.join(ROOT, "QUERIES.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
