from __future__ import annotations

import datetime as dt
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from vitals.session import configure  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("vitals-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s


def actor(i, login):
    return json.dumps({"id": i, "login": login, "display_login": login, "gravatar_id": "", "url": f"https://api.github.com/users/{login}", "avatar_url": None})


def repo(i, name):
    return json.dumps({"id": i, "name": name, "url": f"https://api.github.com/repos/{name}"})


def org(i, login):
    return json.dumps({"id": i, "login": login, "gravatar_id": "", "url": f"https://api.github.com/orgs/{login}", "avatar_url": None})


BRONZE_COLS = ["id", "type", "actor", "repo", "payload", "public", "created_at", "org"]


@pytest.fixture
def sample_bronze(spark):
    """Three raw events: Push, Watch, Issues; the third has no org and a bot actor."""
    rows = [
        ("1", "PushEvent", actor(100, "alice"), repo(10, "o/r"), json.dumps({"size": 1}), True, "2026-07-19T10:00:00Z", org(1, "o")),
        ("2", "WatchEvent", actor(101, "bob"), repo(10, "o/r"), json.dumps({"action": "started"}), True, "2026-07-19T11:00:00Z", org(1, "o")),
        ("3", "IssuesEvent", actor(102, "bot[bot]"), repo(20, "p/q"), json.dumps({"action": "opened"}), True, "2026-07-19T12:00:00Z", None),
    ]
    return spark.createDataFrame(rows, "id string, type string, actor string, repo string, payload string, public boolean, created_at string, org string")


def silver_rows(spark, types, actions, repo_ids=None, org_ids=None, actor_ids=None, ts=None):
    """Minimal silver events for gold tests."""
    n = len(types)
    ts = ts or dt.datetime(2026, 7, 19, 10, 0, 0)
    rows = [
        (types[i], actions[i], (actor_ids or [100] * n)[i], (repo_ids or [10] * n)[i], (org_ids or [1] * n)[i], ts)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "type string, action string, actor_id long, repo_id long, org_id long, created_at timestamp_ntz")
