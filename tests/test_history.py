import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from snapflow.operators.history import (HISTORY_COLUMNS, history_rows, merge_frame, read_history,
                                        rebuild_history, upsert)
from snapflow.operators.metrics import METRICS_COLUMNS
from tests.conftest import rows

D0 = dt.date(2024, 3, 1)
NOW = dt.datetime(2024, 4, 1)


def _metrics(spark, data):
    """data: (technology_name, snapshot_date, stars, forks, downloads, issues)."""
    df = spark.createDataFrame(data, "technology_name string, snapshot_date date, github_stars bigint, "
                                     "github_forks bigint, pypi_downloads_daily bigint, open_issues bigint")
    fill = {}
    for c in METRICS_COLUMNS:
        if c in df.columns:
            continue
        if c in ("weekly_to_daily_ratio", "monthly_to_weekly_ratio", "fork_to_star_ratio", "stars_per_contributor"):
            fill[c] = F.lit(0.0)
        elif c.endswith("_at") or c.endswith("_time"):
            fill[c] = F.col("snapshot_date").cast("timestamp_ntz")
        elif c in ("github_repo", "pypi_package", "popularity_tier", "usage_tier"):
            fill[c] = F.lit("x")
        else:
            fill[c] = F.lit(None).cast("bigint")
    return df.withColumns(fill).select(*METRICS_COLUMNS)


def _path():
    return tempfile.mkdtemp(prefix="hist-", dir=os.environ.get("TMPDIR", "/tmp")) + "/h"


def _changes(df):
    return rows(df, "technology_name", "snapshot_date", "stars_change", "downloads_change")


def test_first_next_rerun_new_entity(spark):
    path = _path()
    day1 = _metrics(spark, [("a", D0, 10, 1, 100, 3), ("b", D0, 5, 1, 50, 0)])
    upsert(spark, path, history_rows(day1, None, now=NOW))                    # first run: zeros
    h = read_history(spark, path)
    assert sorted(h.columns) == sorted(HISTORY_COLUMNS)
    assert _changes(h) == [("a", D0, 0, 0), ("b", D0, 0, 0)]

    d1 = D0 + dt.timedelta(days=1)
    day2 = _metrics(spark, [("a", d1, 15, 1, 90, 3), ("b", d1, 5, 1, 55, 0), ("c", d1, 7, 0, 1, 0)])
    upsert(spark, path, history_rows(day2, read_history(spark, path), now=NOW))
    got = _changes(read_history(spark, path).where(F.col("snapshot_date") == d1))
    assert got == [("a", d1, 5, -10), ("b", d1, 0, 5), ("c", d1, 7, 1)]        # new entity: full value

    day2b = _metrics(spark, [("a", d1, 16, 1, 90, 3), ("b", d1, 5, 1, 55, 0), ("c", d1, 7, 0, 1, 0)])
    upsert(spark, path, history_rows(day2b, read_history(spark, path), now=NOW))  # same-day rerun
    h = read_history(spark, path)
    assert h.count() == 5
    got = _changes(h.where(F.col("snapshot_date") == d1))
    assert got == [("a", d1, 1, 0), ("b", d1, 0, 0), ("c", d1, 0, 0)]        # only the movement since the rerun
    assert _changes(h.where(F.col("snapshot_date") == D0)) == [("a", D0, 0, 0), ("b", D0, 0, 0)]


def test_null_dates_are_never_matched(spark):
    path = _path()
    m = _metrics(spark, [("a", None, 1, 1, 1, 1)])
    upsert(spark, path, history_rows(m, None, now=NOW))
    upsert(spark, path, history_rows(m, read_history(spark, path), now=NOW))
    h = read_history(spark, path)
    assert h.where(F.col("snapshot_date").isNull()).count() == 2              # a rerun adds another row


def test_late_snapshot_uses_newest_stored_row(spark):
    path = _path()
    upsert(spark, path, history_rows(_metrics(spark, [("a", D0 + dt.timedelta(days=5), 50, 0, 0, 0)]), None, now=NOW))
    late = _metrics(spark, [("a", D0, 20, 0, 0, 0)])
    out = history_rows(late, read_history(spark, path), now=NOW)
    assert _changes(out) == [("a", D0, -30, 0)]


def test_duplicate_incoming_keys_rejected(spark):
    m = _metrics(spark, [("a", D0, 1, 1, 1, 1), ("a", D0, 2, 1, 1, 1)])
    with pytest.raises(ValueError):
        upsert(spark, _path(), history_rows(m, None, now=NOW))


def test_merge_frame_keeps_untouched_rows(spark):
    t = spark.createDataFrame([(D0, "a", 1), (D0, "b", 2), (None, "a", 3)], "snapshot_date date, technology_name string, v int")
    r = spark.createDataFrame([(D0, "a", 10), (None, "a", 30)], "snapshot_date date, technology_name string, v int")
    assert rows(merge_frame(t, r)) == [(D0, "a", 10), (D0, "b", 2)]       # undated rows are appended, not merged
    assert rows(merge_frame(t, r, max_dates=0)) == [(D0, "a", 10), (D0, "b", 2)]


def test_schema_sync_adds_and_drops(spark):
    path = _path()
    old = history_rows(_metrics(spark, [("a", D0, 1, 1, 1, 1)]), None, now=NOW).drop("issues_change") \
        .withColumn("legacy", F.lit("x"))
    upsert(spark, path, old)
    new = history_rows(_metrics(spark, [("b", D0 + dt.timedelta(days=1), 2, 2, 2, 2)]), None, now=NOW)
    upsert(spark, path, new)
    h = read_history(spark, path)
    assert "legacy" not in h.columns and "issues_change" in h.columns
    assert rows(h, "technology_name", "issues_change") == [("a", None), ("b", 0)]


def test_fold_equals_closed_form(spark):
    """Folding the daily increment over in-order data equals the one-pass rebuild."""
    import random
    rnd = random.Random(3)
    data = []
    for d in range(6):
        for e in "abcd":
            if rnd.random() < 0.75 or d == 0:
                data.append((e, D0 + dt.timedelta(days=d), rnd.randint(0, 100), rnd.randint(0, 9),
                             rnd.randint(0, 1000), rnd.randint(0, 20)))
    all_rows = _metrics(spark, data)
    path = _path()
    for d in range(6):
        day = all_rows.where(F.col("snapshot_date") == D0 + dt.timedelta(days=d))
        existing = None if d == 0 else read_history(spark, path)
        upsert(spark, path, history_rows(day, existing, now=NOW))
    folded = rows(read_history(spark, path), "technology_name", "snapshot_date", "stars_change", "forks_change",
                  "downloads_change", "issues_change")
    closed = rows(rebuild_history(all_rows), "technology_name", "snapshot_date", "stars_change", "forks_change",
                  "downloads_change", "issues_change")
    assert folded == closed


def test_latest_table_equals_history_scan(spark):
    """Increments fed from the one-row-per-entity latest table equal those that scan history."""
    from snapflow.operators.history import latest_path, upsert_with_latest
    import random
    rnd = random.Random(11)
    days = []
    for d in range(5):
        day = [(e, D0 + dt.timedelta(days=d), rnd.randint(0, 50), 1, rnd.randint(0, 9), 0)
               for e in "abcde" if rnd.random() < 0.7 or d == 0]
        days.append(day)
    days.append([(e, D0 + dt.timedelta(days=4), v + 1, f, dl, i) for e, _, v, f, dl, i in days[4]])  # same-day rerun
    p_scan, p_state = _path(), _path()
    for i, day in enumerate(days):
        m = _metrics(spark, day)
        h = None if i == 0 else read_history(spark, p_scan)
        upsert(spark, p_scan, history_rows(m, h, now=NOW))
        prev = None if i == 0 else spark.read.parquet(latest_path(p_state))
        upsert_with_latest(spark, p_state, history_rows(m, None, now=NOW, previous=prev))
    cols = ("technology_name", "snapshot_date", "stars_change", "downloads_change")
    assert rows(read_history(spark, p_scan), *cols) == rows(read_history(spark, p_state), *cols)


def test_stop_between_the_two_writes(spark, monkeypatch):
    """History written, latest table not: the next day still compares with what the history holds."""
    from snapflow.operators import history as H
    path = _path()

    def day(n, stars):
        m = _metrics(spark, [("a", D0 + dt.timedelta(days=n), stars, 0, stars, 0)])
        return history_rows(m, None, now=NOW + dt.timedelta(days=n), previous=H.previous_rows(spark, path))

    H.upsert_with_latest(spark, path, day(0, 10))
    write = H.sinks.write_table

    def stop(df, target, *a, **k):
        if target.endswith("_latest"):
            raise KeyboardInterrupt
        return write(df, target, *a, **k)

    monkeypatch.setattr(H.sinks, "write_table", stop)
    with pytest.raises(KeyboardInterrupt):
        H.upsert_with_latest(spark, path, day(1, 43))
    monkeypatch.setattr(H.sinks, "write_table", write)
    H.upsert_with_latest(spark, path, day(1, 43))                        # the day again: nothing has changed since
    assert _changes(read_history(spark, path).where(F.col("snapshot_date") == D0 + dt.timedelta(days=1))) == \
        [("a", D0 + dt.timedelta(days=1), 0, 0)]
    monkeypatch.setattr(H.sinks, "write_table", stop)
    with pytest.raises(KeyboardInterrupt):
        H.upsert_with_latest(spark, path, day(2, 36))
    monkeypatch.setattr(H.sinks, "write_table", write)
    state = H.upsert_with_latest(spark, path, day(3, 10))
    d3 = D0 + dt.timedelta(days=3)
    assert _changes(read_history(spark, path).where(F.col("snapshot_date") == d3)) == [("a", d3, -26, -26)]
    r = state.first()
    assert (r.snapshot_date, r.first_snapshot_date, len(r.recent_dates)) == (d3, D0, 4)
    assert rows(state) == rows(H.derive_latest(H.read_history(spark, path)))


def test_first_run_with_undated_rows_only(spark):
    from snapflow.operators.history import previous_rows, upsert_with_latest
    path = _path()
    for n in range(2):
        m = _metrics(spark, [("a", None, 5 + n, 0, 1, 0)])
        upsert_with_latest(spark, path, history_rows(m, None, now=NOW + dt.timedelta(days=n), previous=previous_rows(spark, path)))
    upsert_with_latest(spark, path, history_rows(_metrics(spark, [("b", D0, 1, 1, 1, 1)]), None, now=NOW,
                                                 previous=previous_rows(spark, path)))
    h = read_history(spark, path)
    assert dict(h.dtypes)["snapshot_date"] == "date"
    assert rows(h, "technology_name", "snapshot_date", "stars_change") == [("a", None, 0), ("a", None, 1), ("b", D0, 1)]


def test_undated_partition_is_not_rewritten(spark):
    import glob
    path = _path()
    upsert(spark, path, history_rows(_metrics(spark, [("a", None, 1, 1, 1, 1), ("a", D0, 1, 1, 1, 1)]), None, now=NOW))
    before = set(glob.glob(f"{path}/snapshot_date=__HIVE*/*/*.parquet"))
    upsert(spark, path, history_rows(_metrics(spark, [("b", None, 2, 1, 1, 1), ("b", D0, 2, 1, 1, 1)]), None, now=NOW))
    assert before and before < set(glob.glob(f"{path}/snapshot_date=__HIVE*/*/*.parquet"))


def test_previous_of_undated_rows_is_the_newest_built(spark):
    from snapflow.operators.history import derive_latest, latest_rows
    one, two = (history_rows(_metrics(spark, [("a", None, stars, 0, 0, 0)]), None, now=NOW + dt.timedelta(days=n))
                for n, stars in ((0, 9), (1, 4)))
    for h in (one.union(two), two.union(one)):
        assert rows(latest_rows(h), "github_stars") == rows(derive_latest(h), "github_stars") == [(4,)]


def test_unreadable_history_is_an_error(spark):
    from snapflow.operators.history import previous_rows
    path = _path()
    assert previous_rows(spark, path) is None
    os.makedirs(path)
    with open(f"{path}/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        previous_rows(spark, path)
    with pytest.raises(Exception):
        upsert(spark, path, history_rows(_metrics(spark, [("a", D0, 1, 1, 1, 1)]), None, now=NOW))
    assert os.listdir(path) == ["part-0.parquet"]


def test_stop_in_the_middle_of_a_schema_change(spark, monkeypatch):
    from snapflow.sources import sinks
    path = _path()
    old = history_rows(_metrics(spark, [("a", D0, 1, 1, 1, 1)]), None, now=NOW).withColumn(
        "issues_change", F.col("issues_change").cast("decimal(20,0)"))       # another type: the table is written anew
    upsert(spark, path, old)
    new = history_rows(_metrics(spark, [("b", D0, 2, 2, 2, 2)]), None, now=NOW)
    move = sinks.move_path

    def stop(spark, source, target):
        if source.endswith("__new"):
            raise KeyboardInterrupt
        move(spark, source, target)

    monkeypatch.setattr(sinks, "move_path", stop)
    with pytest.raises(KeyboardInterrupt):
        upsert(spark, path, new)
    monkeypatch.setattr(sinks, "move_path", move)
    assert rows(read_history(spark, path), "technology_name") == [("a",)]           # the old table, whole
    upsert(spark, path, new)
    assert rows(read_history(spark, path), "technology_name", "issues_change") == [("a", 0), ("b", 0)]
    assert not [n for n in os.listdir(os.path.dirname(path)) if "__" in n]


def test_rebuild_rejects_undated_rows(spark):
    with pytest.raises(Exception, match="snapshot_date is null"):
        rebuild_history(_metrics(spark, [("a", D0, 1, 1, 1, 1), ("a", None, 2, 1, 1, 1)])).collect()


def test_catalog_history(spark):
    from snapflow.operators.history import previous_rows, upsert_with_latest
    spark.sql("DROP DATABASE IF EXISTS hist_test CASCADE")
    name = "hist_test.fct_history"
    for n, stars in ((0, 10), (1, 15), (1, 16)):
        m = _metrics(spark, [("a", D0 + dt.timedelta(days=n), stars, 0, 0, 0), ("x", None, stars, 0, 0, 0)])
        upsert_with_latest(spark, name, history_rows(m, None, now=NOW + dt.timedelta(hours=stars), previous=previous_rows(spark, name)))
    d1 = D0 + dt.timedelta(days=1)
    assert rows(spark.table(name), "technology_name", "snapshot_date", "stars_change") == [
        ("a", D0, 0), ("a", d1, 1), ("x", None, 0), ("x", None, 1), ("x", None, 5)]
    new = history_rows(_metrics(spark, [("b", D0, 2, 2, 2, 2)]), None, now=NOW).withColumn("note", F.lit("n"))
    upsert_with_latest(spark, name, new)
    assert rows(read_history(spark, name), "technology_name", "note")[0] == ("a", None)
    spark.sql("DROP DATABASE hist_test CASCADE")


def _files(path):
    return {(d, f): os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") and "_layout" not in d}


def test_column_changes_rewrite_no_file(spark):
    """Columns come, go and come back: old files stay as they are, old values of a dropped column stay gone."""
    path = _path()
    day = [D0 + dt.timedelta(days=n) for n in range(5)]

    def rows_of(n, stars=1):
        return history_rows(_metrics(spark, [("a", day[n], stars, 1, 1, 1), ("u", None, n, 1, 1, 1)]), None, now=NOW)

    upsert(spark, path, rows_of(0).withColumn("note", F.lit("zero")))
    upsert(spark, path, rows_of(1).withColumn("score", F.lit(1.5)))                       # note goes, score comes
    before = _files(path)
    upsert(spark, path, rows_of(2).withColumn("score", F.lit(2.5)).withColumn("Note", F.lit(7).cast("bigint")))   # other type
    after = _files(path)
    assert before.items() <= after.items() and len(after) == len(before) + 2
    h = read_history(spark, path)
    assert rows(h.where("snapshot_date is not null"), "snapshot_date", "score", "Note") == [
        (day[0], None, None), (day[1], 1.5, None), (day[2], 2.5, 7)]
    upsert(spark, path, rows_of(1, 9).withColumn("score", F.lit(3.5)).withColumn("Note", F.lit(8).cast("bigint")))   # an old day
    assert rows(read_history(spark, path).where("technology_name = 'a'"), "github_stars", "score", "Note") == [
        (1, 2.5, 7), (1, None, None), (9, 3.5, 8)]
    upsert(spark, path, rows_of(3).withColumn("score", F.lit(4).cast("decimal(6,2)")))    # a column's type changes: written anew
    h = read_history(spark, path)
    assert dict(h.dtypes)["score"] == "decimal(6,2)" and "Note" not in h.columns
    assert [float(r[0]) if r[0] is not None else None for r in rows(h.where("technology_name = 'a'"), "score")] == [2.5, 3.5, 4.0, None]
    assert h.where("snapshot_date is null").count() == 5
    assert os.path.isdir(path) and not os.path.isdir(f"{path}/_layout")


def test_dated_and_undated_rows_come_together(spark, monkeypatch):
    """Whatever write is stopped, the table holds all rows of a merge or none."""
    from snapflow.sources import sinks
    path = _path()

    def both(n):
        return history_rows(_metrics(spark, [("a", D0, n, 1, 1, 1), ("u", None, n, 1, 1, 1)]), None, now=NOW)

    upsert(spark, path, both(0))
    seen = []
    for name in ("overwrite_partitions", "write_table", "write_layout", "move_path"):
        whole = getattr(sinks, name)
        for late in (False, True):                      # before and after each write of a merge that adds a column
            def stop(*a, whole=whole, late=late, **k):
                if late:
                    whole(*a, **k)
                raise KeyboardInterrupt
            monkeypatch.setattr(sinks, name, stop)
            with pytest.raises(KeyboardInterrupt):
                upsert(spark, path, both(len(seen) + 1).withColumn(f"c{len(seen)}", F.lit(1)))
            monkeypatch.setattr(sinks, name, whole)
            h = read_history(spark, path)
            dated, undated = (rows(h.where(f"snapshot_date is {x}"), "github_stars") for x in ("not null", "null"))
            assert len(dated) == 1 and dated[0] in undated and (dated[0] == max(undated)), (name, late)
            seen.append(dated)
            upsert(spark, path, both(len(seen) + 1))     # the stopped column goes again
    assert len(rows(read_history(spark, path), "github_stars")) >= 8


def test_table_without_runs_is_taken_over(spark):
    from snapflow.sources.sinks import write_table
    path = _path()
    write_table(history_rows(_metrics(spark, [("a", D0, 1, 1, 1, 1), ("u", None, 1, 1, 1, 1)]), None, now=NOW), path, ["snapshot_date"])
    upsert(spark, path, history_rows(_metrics(spark, [("a", D0, 2, 1, 1, 1), ("u", None, 2, 1, 1, 1)]), None, now=NOW))
    assert rows(read_history(spark, path), "technology_name", "github_stars") == [("a", 2), ("u", 1), ("u", 2)]


def test_catalog_columns_come_by_alter_table(spark):
    spark.sql("DROP DATABASE IF EXISTS hist_cols CASCADE")
    name = "hist_cols.h"
    upsert(spark, name, history_rows(_metrics(spark, [("a", D0, 1, 1, 1, 1)]), None, now=NOW))
    upsert(spark, name, history_rows(_metrics(spark, [("b", D0, 2, 2, 2, 2)]), None, now=NOW).withColumn("note", F.lit("n")))
    assert rows(read_history(spark, name), "technology_name", "note") == [("a", None), ("b", "n")]
    upsert(spark, name, history_rows(_metrics(spark, [("c", D0, 2, 2, 2, 2)]), None, now=NOW))             # a column goes: written anew
    assert "note" not in read_history(spark, name).columns and read_history(spark, name).count() == 3
    spark.sql("DROP DATABASE hist_cols CASCADE")
