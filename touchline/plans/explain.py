"""Print the final adaptive plans of registered queries (the source of PLANS.md).

    python -m touchline.plans.explain /root/testdata/sf0.01 [query ...] > PLANS.md

Each query is run, then its executed plan is printed in ``formatted`` mode with
details kept only for scans, exchanges, window limits and joins.
"""

from __future__ import annotations

import re
import sys

from touchline.plans.catalog import QUERIES
from touchline.session import build_session

DEFAULT = ["player_performance", "live_events", "frame_speed_x", "top_players",
           "ball_in_box_by_pitch", "latest_ball_state"]
KEEP = ("Scan", "Exchange", "ReusedExchange", "WindowGroupLimit", "BroadcastHashJoin", "SortMergeJoin")


def final_plan(spark, df) -> str:
    """The executed plan in ``formatted`` mode, final adaptive plan only, with the
    details of the nodes in :data:`KEEP`."""
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree = text.split("+- == Initial Plan ==")[0].rstrip()
    ids = set(re.findall(r"(?:" + "|".join(KEEP) + r")[^\n(]*\((\d+)\)", tree))
    details = []
    for block in text.split("\n\n"):
        m = re.match(r"\((\d+)\) (\S+)", block.strip())
        if m and m.group(1) in ids:
            lines = [re.sub(r"#\d+L?", "", line) for line in block.strip().splitlines()
                     if not line.startswith(("Input", "Output", "Batched", "Location"))]
            details.append("\n".join(line if len(line) < 200 else line[:197] + "..." for line in lines))
    return "```\n" + tree + "\n```\n\n```\n" + "\n\n".join(details) + "\n```\n"


def main(argv: list[str]) -> None:
    sf_dir, names = argv[0], argv[1:] or DEFAULT
    spark = build_session("local[8]", app_name="touchline-explain", shuffle_partitions=8)
    print("# Physical plans\n")
    print(f"Final adaptive plans of the main queries after running on `{sf_dir}` with `local[8]`")
    print("and 8 shuffle partitions (`explain` mode `formatted` on the executed query).")
    print("Only the nodes that decide the cost at scale are detailed: scans (`ReadSchema`),")
    print("exchanges (partitioning), reused exchanges, window limits and joins.")
    print("Regenerate with `python -m touchline.plans.explain <sf_dir> > PLANS.md`.\n")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        # Runs this very plan (adaptive plans become final) and brings nothing but a count back.
        df._jdf.queryExecution().toRdd().count()
        print(f"## {name}\n")
        print(final_plan(spark, df))


if __name__ == "__main__":
    main(sys.argv[1:])
