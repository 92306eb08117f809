import datetime as dt

from conftest import SF_TINY, rows
from dimfold.operators import datelist, reduced
from dimfold.plans.fold import fold, latest
from dimfold.session import shared_dir
from dimfold.sources import views


def test_fold_through_files_equals_batch(spark):
    ev = views.events(spark, SF_TINY)
    start, run = dt.date(2024, 1, 10), dt.date(2024, 1, 20)
    days = [start + dt.timedelta(days=k) for k in range(1, (run - start).days + 1)]

    def step(table, d):
        return datelist.dates_step(ev, latest(table, "date", d - dt.timedelta(days=1)), d)

    table = fold(spark, shared_dir(spark, "t_fold"), datelist.dates_build(ev, start), days, step, "date")
    assert rows(latest(table, "date", run)) == rows(datelist.dates_build(ev, run))
    assert table.select("date").distinct().count() == len(days) + 1


def test_month_fold_with_staging_is_idempotent(spark):
    ev = views.events(spark, SF_TINY, shift_days=15)
    start, run = dt.date(2024, 1, 29), dt.date(2024, 2, 2)
    days = [start + dt.timedelta(days=k) for k in range(1, (run - start).days + 1)]
    path = shared_dir(spark, "t_month_fold")
    step = lambda table, d: reduced.metric_step(ev, table, d)
    table = fold(spark, path, reduced.metric_build(ev, start), days, step, "month_start", stage=True)
    expected = rows(reduced.metric_build(ev, run))
    assert rows(table.select("user_id", "month_start", "metric_name", "metric_array")) == expected
    # re-running the last day changes nothing
    again = fold(spark, path, table.where("false"), [run], step, "month_start", stage=True)
    assert rows(again.select("user_id", "month_start", "metric_name", "metric_array")) == expected
