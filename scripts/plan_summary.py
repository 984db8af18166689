"""Summarise docs/plans/*.txt: shuffle keys, broadcasts and joins per query.

Usage: python scripts/plan_summary.py  (prints a markdown table)
"""

from __future__ import annotations

import glob
import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def summarise(text: str) -> tuple[list[str], int, int, int, str]:
    args = re.findall(r"\(\d+\) Exchange\s*\nInput \[.*?\]: \[.*?\]\s*\nArguments: (.*?)\n", text)
    keys = []
    for a in args:
        m = re.match(r"(hashpartitioning|rangepartitioning)\((.*?), \d+\), ENSURE", a)
        if m:
            cols = re.sub(r"#\d+L?", "", m.group(2))
            keys.append(("hash " if m.group(1).startswith("hash") else "range ") + f"({cols})")
        elif a.startswith("SinglePartition"):
            keys.append("single (1 row per task)")
    bcast = len(re.findall(r"\(\d+\) BroadcastExchange", text))
    smj = len(re.findall(r"\(\d+\) SortMergeJoin", text))
    bhj = len(re.findall(r"\(\d+\) BroadcastHashJoin", text))
    aggs = sorted({a for a in ("SortAggregate", "ObjectHashAggregate", "HashAggregate")
                   if f") {a}" in text})
    return keys, bcast, smj, bhj, ", ".join(aggs)


def main() -> None:
    print("| Query | Shuffles (partitioning keys) | Broadcasts | SMJ / BHJ | Aggregates |")
    print("|---|---|---|---|---|")
    for f in sorted(glob.glob(os.path.join(ROOT, "docs", "plans", "*.txt"))):
        keys, b, smj, bhj, aggs = summarise(open(f).read())
        name = os.path.basename(f)[:-4]
        print(f"| `{name}` | {'; '.join(keys) or 'none'} | {b} | {smj} / {bhj} | {aggs or '—'} |")


if __name__ == "__main__":
    main()
