"""The stream store: late lines, compaction, tails of trends."""

import datetime as dt
import random

import pytest

from trafficlens.operators import trends as T
from trafficlens.session import fresh_path
from trafficlens.streaming import store as ST


def feed(spark, store, batches):
    """Micro-batches of (title, 'yyyy-mm-dd HH', views)."""
    start = (store.version(spark) if store.version(spark) is not None else -1) + 1
    for i, rows in enumerate(batches):
        rows = [(t, dt.datetime.strptime(h, "%Y-%m-%d %H"), v) for t, h, v in rows]
        store(spark.createDataFrame(rows, "title string, ts timestamp_ntz, views bigint"), start + i)


def expected(batches, delay):
    """Day totals of closed hours, by all lines that ever arrived."""
    rows = [r for b in batches for r in b]
    newest = max(dt.datetime.strptime(h, "%Y-%m-%d %H") for _, h, _ in rows)
    out = {}
    for t, h, v in rows:
        at = dt.datetime.strptime(h, "%Y-%m-%d %H")
        if t is not None and at + dt.timedelta(hours=1) <= newest - dt.timedelta(hours=delay):
            key = t, at.strftime("%Y%m%d")
            out[key] = out.get(key, 0) + v
    return out


def days(spark, store, version=None):
    version = store.version(spark) if version is None else version
    rows = store.days(spark, version).collect()
    assert len({(r.title, r.dt) for r in rows}) == len(rows)
    return {(r.title, r.dt): r.views for r in rows}


def trends(spark, store, counts):
    rows = spark.createDataFrame([(t, d, v) for (t, d), v in counts.items()], "title string, dt string, views bigint")
    return sorted(tuple(r) for r in T.trend_table(rows).collect())


B1 = [("A", "2015-03-01 00", 1), ("A", "2015-03-01 05", 2), ("B", "2015-03-01 05", 4), ("A", "2015-03-01 09", 8), (None, "2015-03-01 10", None)]
B2 = [("A", "2015-03-01 05", 16), ("B", "2015-03-01 20", 32), ("B", "2015-03-02 03", 64)]  # 05 is late by now
B3 = [("C", "2015-03-01 00", 128), ("A", "2015-03-03 00", 256)]
B4 = [("A", "2015-03-01 09", 512), (None, "2015-03-03 09", None)]


def test_late_lines_are_kept_and_applied(spark):
    store = ST.StreamStore(fresh_path(spark, "t_store"), delay_hours=3)
    seen = []
    for b in (B1, B2, B3, B4):
        feed(spark, store, [b])
        seen.append(b)
        assert days(spark, store) == expected(seen, 3)
    late = sorted((r.title, str(r.ts), r.views, r.batch) for r in store.late(spark).collect())
    assert late == [("A", "2015-03-01 05:00:00", 16, 1), ("A", "2015-03-01 09:00:00", 512, 3), ("C", "2015-03-01 00:00:00", 128, 2)]
    # older versions are still there
    assert days(spark, store, 0) == expected([B1], 3) and days(spark, store, 1) == expected([B1, B2], 3)


def test_a_replayed_batch_changes_nothing(spark):
    store = ST.StreamStore(fresh_path(spark, "t_store"), delay_hours=3)
    feed(spark, store, [B1, B2])
    once = days(spark, store)
    rows = [(t, dt.datetime.strptime(h, "%Y-%m-%d %H"), v) for t, h, v in B2]
    store(spark.createDataFrame(rows, "title string, ts timestamp_ntz, views bigint"), 1)
    assert days(spark, store) == once and store.version(spark) == 1
    assert [r.batch for r in store.late(spark).collect()] == [1]


def test_compaction_keeps_versions_and_bounds_files(spark):
    store = ST.StreamStore(fresh_path(spark, "t_store"), delay_hours=3)
    hours = [dt.datetime(2015, 3, 1) + dt.timedelta(hours=h) for h in range(48)]
    batches = [[(t, h.strftime("%Y-%m-%d %H"), i + 1) for t in "AB"] for i, h in enumerate(hours[::8])]
    feed(spark, store, batches[:3])
    before = len(store.days(spark, 2).inputFiles())
    assert store.compact(spark) == 2 and store.compact(spark) == 2
    assert days(spark, store, 1) == expected(batches[:2], 3)  # an older version, from the batches
    feed(spark, store, batches[3:5])
    assert days(spark, store) == expected(batches[:5], 3) and days(spark, store, 2) == expected(batches[:3], 3)
    assert store.compact(spark) == 4
    after = store.days(spark, 4).inputFiles()
    assert len(after) == 2 < before and all("/compact/" in f for f in after)  # one a day
    assert store.expire(spark, keep=3) > 0  # back to compaction 2
    assert days(spark, store, 3) == expected(batches[:4], 3) and days(spark, store, 2) == expected(batches[:3], 3)
    feed(spark, store, batches[5:])
    assert days(spark, store) == expected(batches, 3)
    assert sorted(tuple(r) for r in store.trends(spark, store.version(spark)).collect()) == trends(spark, store, expected(batches, 3))
    newest = store.compact(spark)
    assert store.expire(spark, keep=newest) > 0 and days(spark, store) == expected(batches, 3)
    assert store.days(spark, 1).count() == 0  # gone
    assert store.tails(spark, newest).count() == 2


def test_tails_replace_the_history(spark, monkeypatch):
    """Batches near the end of a series read no older day; an older change
    reads its title whole. The trends equal those over all days."""
    store = ST.StreamStore(fresh_path(spark, "t_store"), delay_hours=1)
    rng = random.Random(5)
    day = lambda i: (dt.date(2015, 1, 1) + dt.timedelta(days=i)).strftime("%Y-%m-%d")
    batches = [[(t, f"{day(i)} 00", rng.randint(1, 50)) for i in range(130) for t in "AB"] + [("C", f"{day(3)} 00", 5)],
               [("A", f"{day(i)} 03", rng.randint(1, 50)) for i in range(128, 135)] + [("C", f"{day(1)} 00", 9)],
               [("B", f"{day(120)} 05", 7), ("A", f"{day(136)} 00", 3), ("D", f"{day(136)} 00", 1)],
               [("B", f"{day(20)} 05", 9), ("A", f"{day(137)} 00", 4), ("A", f"{day(139)} 00", 4)]]
    whole = []
    real = ST.StreamStore.days
    monkeypatch.setattr(ST.StreamStore, "days", lambda self, s, v, only=None: (whole.append(only), real(self, s, v, only))[1])
    for n, b in enumerate(batches):
        whole.clear()
        feed(spark, store, [b])
        assert (None in whole) == (n == 3)
        if None not in whole:
            touched = {h[:10].replace("-", "") for _, h, _ in sum(batches[:n + 1], [])}
            assert all(set(only) <= touched for only in whole)
        want = expected(batches[:n + 1], 1)
        assert sorted(tuple(r) for r in store.trends(spark, n).collect()) == trends(spark, store, want)
    tails = {r.title: (r.before, len(r.points)) for r in store.tails(spark, 3).collect()}
    assert tails["A"] == (137 - ST.TAIL, ST.TAIL) and tails["C"] == (0, 2)
    docs = spark.read.json(f"{store.root}/docs/version=3")
    assert docs.where("title = 'B'").count() == 110  # from the changed day on


def test_no_lines_and_a_moved_root(spark):
    store = ST.StreamStore(fresh_path(spark, "t_store"))
    empty = spark.createDataFrame([], "title string, ts timestamp_ntz, views bigint")
    assert store.compact(spark) is None
    store(empty, 0)
    store(empty, 1)
    assert store.version(spark) == 1 and days(spark, store) == {} and store.late(spark).count() == 0
    assert store.compact(spark) == 1 and store.expire(spark, 1) >= 0 and days(spark, store) == {}
    with pytest.raises(RuntimeError):
        ST.StreamStore(fresh_path(spark, "t_other"))(empty, 3)
