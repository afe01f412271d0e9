"""Write the physical plan (operator tree + scan details) of the headline
queries to docs/PLANS.md.

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SHOW = ["pair_activity", "port_scan_approx", "ioc_match", "merge_iocs", "new_iocs", "ioc_incremental", "decode_logs"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    scans = [blk for blk in details.split("\n\n") if "Scan " in blk.split("\n", 1)[0]]
    keep = []
    for blk in scans:
        lines = [ln for ln in blk.splitlines() if ln.split(":")[0] in
                 ("Output [1]", "PushedFilters", "PartitionFilters", "ReadSchema") or ln.startswith("(")]
        keep.append("\n".join(re.sub(r"#\d+L?", "", ln) for ln in lines))
    return re.sub(r"#\d+L?", "", tree).strip() + "\n\n" + "\n\n".join(keep)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from tidewatch.plans.catalog import REGISTRY
    from tidewatch.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/explain_plans.py` on `{sf_dir}` (local[8], AQE on); each query is run "
           "first, so these are AQE's final plans (`*` marks whole-stage-codegen operators). In `merge_iocs` and `new_iocs` the current table is itself "
           "derived from the raw fixture (hence its aggregation); in the refresh job it is a Parquet "
           "snapshot scan.", ""]
    for name in SHOW:
        df = REGISTRY[name].build(spark, sf_dir)
        df.collect()  # run this Dataset (small, sf0.01) so explain shows AQE's final plan
        out += [f"## {name}", "", "```", plan_text(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main(sys.argv)
