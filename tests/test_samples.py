"""A failed batch shows the first failing rows of each table."""

from test_jobs import _fork, _land_rows, _now
from vitals.plans import jobs as J
from vitals.session import scratch_path
from vitals.sources.lake import TableLake


def test_failed_batch_shows_its_first_failing_rows(spark):
    lk = TableLake(spark, scratch_path(spark, "test-samples"))
    rows = [_fork(80, "2024-03-03T05:00:00Z")] + [_fork(100 - i, "not a time") for i in range(10)]
    _land_rows(spark, lk, rows, "2024-03-03-5.json.gz")
    rep = J.silver_batch(lk, _now())
    assert rep.status == J.FAILED and not lk.has("events")
    assert [r["id"] for r in rep.samples["events"]] == [91, 92, 93, 94, 95] and J.SAMPLE_ROWS == 5
    assert all(r["created_at"] is None for r in rep.samples["events"])
