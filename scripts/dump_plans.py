"""Write PLANS.md: the physical plan of every batch catalog query.

    python scripts/dump_plans.py [sf_dir]

For each query: the operator tree of ``explain("formatted")`` (the plan
AQE starts from; at run time it may still coalesce partitions or switch a
join to broadcast) and, for every scan, its pushed filters and read
schema. Streaming queries are listed by the scan of their sink.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ridewx.plans.catalog import QUERIES  # noqa: E402
from ridewx.session import local_session  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> str:
    lines = text.splitlines()
    tree, details, i = [], [], 0
    while i < len(lines) and not re.match(r"^\(\d+\) ", lines[i]):
        if lines[i].strip() and not lines[i].startswith("=="):
            tree.append(lines[i])
        i += 1
    node = None
    for ln in lines[i:]:
        if re.match(r"^\(\d+\) ", ln):
            node = ln
        elif node and "Scan" in node and ln.startswith(("PushedFilters", "ReadSchema",
                                                        "PartitionFilters")):
            details.append(f"{node.strip()} {ln.strip()}")
    # Keep the final plan only when AQE printed both.
    if "+- == Final Plan ==" in text:
        start = next((k for k, t in enumerate(tree) if "Final Plan" in t), 0)
        end = next((k for k, t in enumerate(tree) if "Initial Plan" in t), len(tree))
        tree = tree[start + 1:end]
    tree = [re.sub(r"/tmp/\S+", "<checkpoint>", t) for t in tree]
    details = [re.sub(r"file:/\S+", "<path>", d) for d in details]
    return "\n".join(tree) + ("\n\n" + "\n".join(dict.fromkeys(details)) if details else "")


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    out = ["# Physical plans", "",
           f"Physical plans of the catalog queries on `{sf_dir}` (local[8], "
           "8 shuffle partitions), written by `scripts/dump_plans.py`: the plan AQE "
           "starts from (at run time it may still coalesce partitions). Scan lines "
           "show what reached the parquet reader. Queries over silver read the "
           "silver table written once per application; streaming queries show "
           "the scan of their sink.", ""]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        out += [f"## {name}", "", "```", summarize(formatted(df)), "```", ""]
    # The streaming queries themselves (the rows above show their sinks).
    from ridewx.plans.catalog import Inputs
    from ridewx.streaming.enrich_stream import (
        check_trip_stream,
        enrich_stream,
        hourly_stream_metrics,
        stream_trips,
    )
    i = Inputs.of(spark, sf_dir)
    enriched = enrich_stream(check_trip_stream(stream_trips(spark, sf_dir)), i.hours())
    for name, df in (("stream_enrich (streaming plan)", enriched),
                     ("stream_hourly_metrics (streaming plan)", hourly_stream_metrics(enriched))):
        out += [f"## {name}", "", "```", summarize(formatted(df)), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main(sys.argv)
