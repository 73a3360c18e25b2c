import datetime as dt
import random

from pyspark.sql import functions as F

from snapflow.functions.scalars import retain_days
from snapflow.operators.latest import latest_per_key
from snapflow.operators.ranking import rank_desc
from snapflow.operators.trends import build_trends, look_back_start
from tests.conftest import rows

D0 = dt.date(2023, 1, 1)


def test_bounded_lookback_equals_full_history(spark):
    rnd = random.Random(5)
    data = []
    for e in range(6):
        day = 0
        for _ in range(rnd.randint(20, 120)):
            day += rnd.choice([1, 1, 2, 5])                       # gaps between snapshots
            v = None if rnd.random() < 0.03 else rnd.randint(0, 60)  # NULL measures and ties
            data.append((f"e{e}", D0 + dt.timedelta(days=day), v, rnd.randint(0, 5), rnd.randint(0, 9)))
    snap = spark.createDataFrame(data, "technology_name string, snapshot_date date, github_stars bigint, "
                                       "github_forks bigint, pypi_downloads_daily bigint")
    as_of = D0 + dt.timedelta(days=200)
    for days in (30, 90):
        full = retain_days(build_trends(snap, as_of=as_of, days=None, rank_strategy="window"),
                           "snapshot_date", as_of, days)
        state = snap.groupBy("technology_name").agg(
            F.min("snapshot_date").alias("first_snapshot_date"),
            F.sort_array(F.collect_set("snapshot_date"), asc=False).alias("recent_dates"))
        short = state.withColumn("recent_dates", F.slice("recent_dates", 1, 25))   # too few dates kept
        for st in (None, state, short):
            for band in (10, 60, 400) if st else (None,):          # read in full for some or none
                back = st and look_back_start(st, as_of, days, band_days=band)
                bounded = build_trends(snap, as_of=as_of, days=days, look_back=back)
                assert rows(bounded) == rows(full), (days, band)


def test_hot_key_latest_and_rank(spark):
    rnd = random.Random(9)
    n = 6000
    data = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 400)}"     # one key holds a third of the rows
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 10 ** 5))
        data.append((k, ts, i, rnd.randint(0, 5) if k == "hot" else rnd.randint(0, 1000)))
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, id bigint, v bigint").repartition(6)
    got = {r.k: r.id for r in latest_per_key(df, "k", "ts", ["id"]).collect()}
    want = {}
    for k, ts, i, _ in data:
        if k not in want or (ts, i) > want[k][0]:
            want[k] = ((ts, i), i)
    assert got == {k: v[1] for k, v in want.items()}
    day = df.withColumn("d", F.lit(dt.date(2024, 1, 1)))           # one group holding every row
    a = rows(rank_desc(day, "d", "v", "r", strategy="window"), "id", "r")
    b = rows(rank_desc(day, "d", "v", "r", strategy="split"), "id", "r")
    assert a == b


def test_split_rank_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from snapflow.operators.ranking import rank_table

    row = st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
                    st.one_of(st.none(), st.integers(-5, 40)))

    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, min_size=1, max_size=60), st.integers(1, 12))
    def check(data, pieces):
        df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(data)], "g string, v bigint, id bigint")
        want = rows(rank_desc(df, "g", "v", "r", strategy="window"), "id", "r")
        t = rank_table(df.select("g", "v"), "g", "v", "r", pieces=pieces)
        got = rows(df.join(t, df.g.eqNullSafe(t.g) & df.v.eqNullSafe(t.v)).select("id", "r"), "id", "r")
        assert got == want

    check()
