"""Summarise the physical plans of registered queries (markdown).

usage: python tools/plan_summary.py [--sf DIR] [name ...]
Counts exchanges, join strategies and aggregate kinds, and lists the scans with
their pushed filters and read schemas (from ``explain('formatted')``).
"""

from __future__ import annotations

import argparse
import collections
import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ["overview_ratio", "overview_daily_distinct", "regional_ratio", "drug_doses", "decode_clean",
            "person_fingerprint", "score_pattern_join", "score_sliding", "lookup_append", "clean_values",
            "export_chain"]


def summarise(text: str) -> dict:
    tree = text.split("\n\n")[0]
    ops = collections.Counter()
    for line in tree.splitlines():
        m = re.search(r"([A-Z][A-Za-z]+(?: [A-Z][A-Za-z]+)*) \(\d+\)", line)
        if m:
            ops[m.group(1)] += 1
    scans = re.findall(r"\(\d+\) Scan parquet.*?\n(.*?)(?=\n\(\d+\)|\Z)", text, re.S)
    scan_info = []
    for block in scans:
        loc = re.search(r"Location: .*?\[file:([^\]]+)\]", block)
        pushed = re.search(r"PushedFilters: (\[.*?\])", block)
        schema = re.search(r"ReadSchema: (struct<.*?>)", block)
        scan_info.append((os.path.basename(loc.group(1)) if loc else "?",
                          pushed.group(1) if pushed else "[]",
                          schema.group(1) if schema else ""))
    return {"ops": ops, "scans": scan_info}


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from claimwise.plans.registry import load_all
    from claimwise.session import local_session

    spark = local_session(8, 8)
    reg = load_all()
    for name in a.names or HEADLINE:
        df = reg[name].build(spark, a.sf)
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        s = summarise(buf.getvalue())
        ops = s["ops"]
        keys = [k for k in ops if any(w in k for w in ("Exchange", "Join", "Aggregate", "Window", "Generate",
                                                        "Union", "Expand", "Sort"))]
        print(f"### `{name}`\n")
        print("operators: " + ", ".join(f"{k} x{ops[k]}" for k in sorted(keys)) + "\n")
        for table, pushed, schema in s["scans"]:
            print(f"* scan `{table}` pushed `{pushed}` read `{schema}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
