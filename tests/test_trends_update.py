"""Trends brought up to date day by day equal those built whole."""

import datetime as dt
import os
import random
import tempfile

import pytest

from snapflow.operators import trends as T
from snapflow.operators.history import history_rows, previous_rows, read_history, upsert_with_latest
from snapflow.session import reliable_checkpoint
from snapflow.sources import sinks
from tests.conftest import plan_text, rows
from tests.test_history import _files, _metrics

D0 = dt.date(2024, 1, 1)
NOW = dt.datetime(2024, 6, 1)


def _day(n):
    return D0 + dt.timedelta(days=n)


def _merge(spark, hist, data):
    new = reliable_checkpoint(history_rows(_metrics(spark, data), None, now=NOW, previous=previous_rows(spark, hist)))
    return new, upsert_with_latest(spark, hist, new)


def _whole(spark, hist, as_of, days):
    return rows(T.build_trends(read_history(spark, hist), as_of=as_of, days=days), *T.TRENDS_COLUMNS)


@pytest.mark.parametrize("catalog", [False, True])
def test_updates_equal_full_builds(spark, catalog):
    rnd = random.Random(4)
    root = tempfile.mkdtemp(prefix="trends-", dir=os.environ.get("TMPDIR", "/tmp"))
    if catalog:
        spark.sql("DROP DATABASE IF EXISTS trends_test CASCADE")
    hist, target = (("trends_test.h", "trends_test.t") if catalog else (f"{root}/h", f"{root}/t"))
    days = 12

    def measures(names, d):
        return [(e, d, rnd.randint(0, 90), 1, rnd.randint(0, 50), 0) for e in names]

    start = [r for n in range(36) for r in measures([e for e in "abcd" if e != "d" or n % 9 == 0], _day(n))]
    _merge(spark, hist, start)
    assert not T.update_trends(spark, target, read_history(spark, hist), *_merge(spark, hist, measures("a", _day(35))), _day(36), days)
    T.write_trends(spark, target, T.build_trends(read_history(spark, hist), as_of=_day(36), days=days), _day(36), days)
    runs = [(36, measures("abcde", _day(36))),                              # the next day, with a new entity
            (37, measures("b", _day(28)) + measures("c", _day(37))),        # a late day: later frames change
            (39, measures("f", _day(10)) + [("g", None, 1, 1, 1, 1)]),      # a day before the cut, an undated row
            (39, [("g", None, 2, 1, 1, 1)]),                                # nothing dated
            (60, measures("ad", _day(59)))]                                 # most days expire
    for n, data in runs if not catalog else runs[:2]:
        new, state = _merge(spark, hist, data)
        assert T.update_trends(spark, target, read_history(spark, hist), new, state, _day(n), days), n
        assert rows(T.read_trends(spark, target), *T.TRENDS_COLUMNS) == _whole(spark, hist, _day(n), days), n
    assert not T.update_trends(spark, target, read_history(spark, hist), new, state, _day(30), days)      # back in time: whole build
    assert not T.update_trends(spark, target, read_history(spark, hist), new, state, _day(90), days + 1)
    if catalog:
        spark.sql("DROP DATABASE trends_test CASCADE")


def test_one_new_day_touches_one_partition(spark):
    root = tempfile.mkdtemp(prefix="trends-", dir=os.environ.get("TMPDIR", "/tmp"))
    hist, target, days = f"{root}/h", f"{root}/t", 90
    _merge(spark, hist, [(e, _day(n), n, 1, n, 0) for n in range(140) for e in "ab"])
    T.write_trends(spark, target, T.build_trends(read_history(spark, hist), as_of=_day(139), days=days), _day(139), days)
    before = _files(target)
    new, state = _merge(spark, hist, [(e, _day(140), 7, 1, 3, 0) for e in "ab"])
    assert T.changed_dates(new, state, _day(140), days) == [_day(140)]
    back = T.look_back_start(state, _day(140), 0)
    assert back.start == _day(140 - T.LOOKBACK_ROWS) and back.deep is None
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_text(T.build_trends(read_history(spark, hist), as_of=_day(140), days=0, look_back=back, dates=[_day(140)]))
    scans = [line.split("PartitionFilters")[1] for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all(any(f"{op} {day}" in s for op, day in ((">=", _day(110)), (">=", _day(140)), ("=", _day(140)))) for s in scans), scans
    assert T.update_trends(spark, target, read_history(spark, hist), new, state, _day(140), days)
    after = {k: v for k, v in _files(target).items() if "_note" not in k[0]}
    old = {k: v for k, v in before.items() if "_note" not in k[0]}
    gone, came = old.keys() - after.keys(), after.keys() - old.keys()
    assert {d.rsplit("=", 1)[1] for d, _ in gone} == {str(_day(49))} and {d.rsplit("=", 1)[1] for d, _ in came} == {str(_day(140))}
    assert all(after[k] == old[k] for k in after.keys() & old.keys())
    assert rows(T.read_trends(spark, target), *T.TRENDS_COLUMNS) == _whole(spark, hist, _day(140), days)


def test_stop_after_the_history_leads_to_a_full_build(spark, monkeypatch):
    """The daily run marks the trends before the history changes; a stopped run's marts are built whole next time."""
    from snapflow.plans import bridge as B, daily
    root = tempfile.mkdtemp(prefix="trends-", dir=os.environ.get("TMPDIR", "/tmp"))
    cfg = daily.RunConfig(root=root, as_of=dt.date(2024, 1, 30), now=NOW, check="off", gate=False, staging="full",
                          repo_tiebreak=("full_name",), package_tiebreak=("version",))
    sf = "/root/testdata/sf0.001"
    B.repo_documents(B.table(spark, sf, "events")).write.parquet(cfg.raw_repos)
    B.package_documents(B.table(spark, sf, "orders")).write.parquet(cfg.raw_packages)
    mapping = B.mapping(B.table(spark, sf, "customer"))
    used = []
    update = daily.update_trends
    monkeypatch.setattr(daily, "update_trends", lambda *a: used.append(update(*a)) or used[-1])
    daily.run_daily(spark, mapping, cfg)
    target = cfg.table("fct_technology_trends", cfg.marts_schema)
    assert used == [] and not sinks.is_stale(spark, target)
    out = daily.run_daily(spark, mapping, cfg)
    assert used == [True]
    want = rows(T.build_trends(out["history"], as_of=cfg.as_of, days=90), *T.TRENDS_COLUMNS)
    assert rows(out["trends"], *T.TRENDS_COLUMNS) == want
    whole = daily.upsert_with_latest
    monkeypatch.setattr(daily, "upsert_with_latest", lambda *a: whole(*a) and (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        daily.run_daily(spark, mapping, cfg)
    monkeypatch.setattr(daily, "upsert_with_latest", whole)
    out = daily.run_daily(spark, mapping, cfg)
    assert used == [True] and rows(out["trends"], *T.TRENDS_COLUMNS) == want       # built whole, not updated
