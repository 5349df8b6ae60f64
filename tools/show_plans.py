"""Print the physical plans of the main operators (``explain("formatted")``).

Usage: python tools/show_plans.py [sf_dir]   (builds a small lake first)
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitals.functions.schemas import EVENT_PARTITIONS  # noqa: E402
from vitals.operators import gold as G  # noqa: E402
from vitals.operators import silver as SV  # noqa: E402
from vitals.plans import pipeline as P  # noqa: E402
from vitals.plans import serving as Q  # noqa: E402
from vitals.session import local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session()
    lake = P.build_lake(spark, sf)
    parsed = SV.parse_bronze(lake.bronze())
    facts = SV.events_projection(parsed).dropna(subset=["id", "actor_id", "repo_id"])
    buckets, n = SV.salt_buckets(facts, list(EVENT_PARTITIONS), 2_000_000)
    plans = {
        "silver fact dedup": SV.dedup_clustered(facts, list(EVENT_PARTITIONS), buckets, min(n, 32)),
        "gold for two days": G.daily_activity(G.events_for_days(lake.events(), "2024-01-20", "2024-01-21"), P.now_col()),
        "top_repos": Q.top_repos(lake, "2024-01-05", "2024-01-10"),
        "top_contributors": Q.top_contributors(lake, "2024-01-05", "2024-01-10"),
        "overview_kpis": Q.overview_kpis(lake, "2024-01-05", "2024-01-10"),
    }
    for name, df in plans.items():
        print(f"==== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
