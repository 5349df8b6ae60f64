"""Serving-query semantics on small hand-made tables: window bounds, empty ranges,
latest-version joins and stable "first" / tie choices."""

import datetime as dt

import pytest

from vitals.plans import serving as Q
from vitals.sources.lake import GOLD_SCHEMA, Lake


class MemLake(Lake):
    def __init__(self, spark, events=None, actors=None, repos=None, orgs=None, gold=None):
        self.spark = spark
        self._t = {"events": events, "actors": actors, "repos": repos, "orgs": orgs, "gold": gold}

    def events(self):
        return self._t["events"]

    def actors(self):
        return self._t["actors"]

    def repos(self):
        return self._t["repos"]

    def orgs(self):
        return self._t["orgs"]

    def gold(self):
        return self._t["gold"]


EV = "id long, type string, action string, actor_id long, repo_id long, org_id long, public boolean, created_at timestamp_ntz, year string, month string, day string, hour string"
ACT = "id long, login string, display_login string, gravatar_id string, url string, avatar_url string, is_bot boolean, first_seen_at timestamp_ntz, inserted_at timestamp_ntz"
REPO = "id long, name string, url string, first_seen_at timestamp_ntz, inserted_at timestamp_ntz"
ORG = "id long, login string, gravatar_id string, url string, avatar_url string, first_seen_at timestamp_ntz, inserted_at timestamp_ntz"


def ev(i, ts, actor=1, repo=1, etype="PushEvent"):
    return (i, etype, "pushed", actor, repo, None, True, ts, f"{ts.year}", f"{ts.month:02d}", f"{ts.day:02d}", f"{ts.hour:02d}")


def gold_row(day, repo, org, watch=0, fork=0, total=1):
    base = {f.name: 0 for f in GOLD_SCHEMA.fields}
    base.update(day=day, repo_id=repo, org_id=org, watch_events=watch, fork_events=fork, total_events=total,
                pr_merge_rate=None, issue_close_rate=None, activity_score=float(watch * 2),
                updated_at=dt.datetime(2024, 2, 1), year=str(day.year), month=f"{day.month:02d}")
    return tuple(base[f.name] for f in GOLD_SCHEMA.fields)


@pytest.fixture
def lake(spark):
    t0 = dt.datetime(2024, 1, 10)
    events = spark.createDataFrame(
        [
            ev(1, t0.replace(day=9, hour=23)),                  # before start: out
            ev(2, t0),                                           # start midnight: in
            ev(3, t0.replace(day=12, hour=0), actor=2),          # end midnight: in
            ev(4, t0.replace(day=12, hour=0, second=1), actor=3),  # after end midnight: out
        ],
        EV,
    )
    ts = dt.datetime(2024, 1, 1)
    actors = spark.createDataFrame(
        [(1, "old", None, None, "u", None, False, ts, ts), (1, "new[bot]", None, None, "u", None, True, ts.replace(day=5), ts),
         (2, "bea", None, None, "u", None, False, ts, ts), (3, "cy", None, None, "u", None, False, ts, ts)],
        ACT,
    )
    repos = spark.createDataFrame([(1, "o/a", "u", ts, ts), (2, "o/b", "u", ts, ts), (3, "o/c", "u", ts, ts)], REPO)
    orgs = spark.createDataFrame([(7, "seven", None, "u", None, ts, ts), (8, "eight", None, "u", None, ts, ts)], ORG)
    d = dt.date(2024, 1, 10)
    gold = spark.createDataFrame(
        [
            gold_row(d, 1, None, watch=2), gold_row(d, 1, 8, watch=1),           # first day: null org and org 8
            gold_row(d + dt.timedelta(days=1), 1, 7, watch=1),
            gold_row(d, 2, 7, watch=3), gold_row(d, 3, 8, watch=3),              # tie on stars: repo id decides
        ],
        GOLD_SCHEMA,
    )
    return MemLake(spark, events, actors, repos, orgs, gold)


def test_silver_window_keeps_only_end_midnight(lake):
    rows = Q.bot_vs_human(lake, "2024-01-10", "2024-01-12").collect()
    assert sum(r["events"] for r in rows) == 2


def test_include_end_day_option(lake):
    assert Q.silver_window(lake, "2024-01-10", "2024-01-12", include_end_day=True).count() == 3


def test_latest_actor_version_used_once(lake):
    rows = Q.top_contributors(lake, "2024-01-10", "2024-01-12").collect()
    logins = {r["login"]: (r["events"], r["is_bot"]) for r in rows}
    assert logins["new[bot]"] == (1, True) and "old" not in logins


def test_first_org_is_earliest_day_non_null(lake):
    rows = {r["repo_name"]: r["org_name"] for r in Q.stars_vs_forks(lake, "2024-01-10", "2024-01-11").collect()}
    assert rows["o/a"] == "eight"


def test_ties_broken_by_repo_id(lake):
    rows = Q.trending_repos(lake, "2024-01-10", "2024-01-11", limit=2).collect()
    assert [r["repo_name"] for r in rows] == ["o/a", "o/b"]


def test_empty_range_gives_nulls_not_errors(lake):
    r = Q.ecosystem_kpis(lake, "2025-01-01", "2025-01-31").first()
    assert r["total_stars"] == 0 and r["star_fork_ratio"] is None and r["avg_activity_score"] is None
    k = Q.overview_kpis(lake, "2025-01-01", "2025-01-31").first()
    assert k["total_events"] == 0 and k["unique_contributors"] == 0


def test_growth_is_cumulative(lake):
    rows = Q.star_growth(lake, "2024-01-10", "2024-01-11").collect()
    assert [(r["stars"], r["cumulative_stars"]) for r in rows] == [(9, 9), (1, 10)]
