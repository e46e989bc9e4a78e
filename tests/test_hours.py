from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallygrid.functions import geo
from tallygrid.sources import files, versions as vs
from tallygrid.streaming import counts as sc, hours as hr

KIND = "n bigint, lat double, lng double, text string, ts timestamp"


def message(n, minute, text="bread"):
    when = None if minute is None else datetime(2015, 2, 4) + timedelta(minutes=minute)
    return (n, 24.56, -81.80, f"{text} w{n % 2}", when)


BATCHES = [[message(0, 5), message(1, 70), message(2, 10)], [message(3, 50), message(4, 130), message(5, 65)],
           [message(6, 20), message(7, 61), message(8, 200), message(9, None)], [], [message(10, 62), message(11, 150)],
           [message(12, 1000)]]


def expected(batches, delay=60):
    """Closed counts by hour and word, and late numbers, message by message."""
    high, counts, late = None, {}, []
    for batch in batches:
        mark = None if high is None else high - delay
        for n, _, _, text, ts in batch:
            minute = None if ts is None else (ts - datetime(2015, 2, 4)) // timedelta(minutes=1)
            if minute is None or mark is not None and (minute // 60 + 1) * 60 <= mark:
                late.append(n)
                continue
            for word in text.split():
                key = ((datetime(2015, 2, 4) + timedelta(minutes=minute)).strftime("%y%m%d%H"), word)
                counts[key] = counts.get(key, 0) + 1
        times = [(b[4] - datetime(2015, 2, 4)) // timedelta(minutes=1) for b in batch if b[4]]
        high = max([*times, *([] if high is None else [high])], default=None)
    shut = {k: v for k, v in counts.items()
            if (datetime.strptime(k[0], "%y%m%d%H") - datetime(2015, 2, 4)) // timedelta(minutes=1) + 60 <= high - delay}
    return sorted((*k, v) for k, v in shut.items()), sorted(late)


def land(spark, folder, batch):
    spark.createDataFrame(batch, KIND).coalesce(1).write.mode("append").parquet(folder)


def start(spark, folder, out, state):
    stream = geo.located(geo.with_cell(sc.read_stream(spark, folder, KIND)))
    return hr.close_hours(stream, out, state)


def result(spark, out):
    closed = sorted(tuple(r) for r in hr.read_closed(spark, out).select("yymmddhh", "word", "cnt").collect())
    return closed, sorted(r["n"] for r in hr.read_late(spark, out, KIND).collect())


def test_hours_close_once_and_late_messages_go_aside(spark, path):
    folder, out, state, seen = path("in"), path(), path("state"), {}
    for i, batch in enumerate(BATCHES):
        land(spark, folder, batch)
        start(spark, folder, out, state).awaitTermination()
        got = result(spark, out)
        assert got == expected(BATCHES[:i + 1])
        for hour, word, cnt in got[0]:  # what is closed never changes
            assert seen.setdefault((hour, word), cnt) == cnt
    assert got[1] == [6, 9, 10] and len({h for h, _ in seen}) >= 3
    assert not [h for b in vs.names(spark, f"{out}/open") for h in vs.names(spark, f"{out}/open/{b}")
                if h.startswith("yymmddhh=") and h < "yymmddhh=15020416"]
    assert files.expire_buckets(spark, f"{out}/closed", "15020400") == ["yymmddhh=15020400"]


@pytest.mark.parametrize("broken", ["commit", "forget", "remove"])
def test_a_batch_that_ended_anywhere_counts_once(spark, path, monkeypatch, broken):
    folder, out, state = path("in"), path(), path("state")
    for i, batch in enumerate(BATCHES[:4]):
        land(spark, folder, batch)
        if i == 2:
            with monkeypatch.context() as m:
                m.setattr(hr.vs, broken, lambda *_, **__: 1 / 0)
                with pytest.raises(Exception):
                    start(spark, folder, out, state).awaitTermination()
        start(spark, folder, out, state).awaitTermination()
    assert result(spark, out) == expected(BATCHES[:4])


def test_state_of_running_counts_is_kept_on_disk(spark, path):
    folder = path("in")
    land(spark, folder, BATCHES[0])
    stream = geo.located(geo.with_cell(sc.read_stream(spark, folder, KIND)))
    sc.event_hours(sc.hour_windows(stream), path(), path("state")).awaitTermination()
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_an_open_hour_has_few_files(spark, path, monkeypatch):
    """Not one from every task that counts."""
    folder, out = path("in"), path()
    monkeypatch.setattr(hr, "HOUR_FILES", 2)
    land(spark, folder, [message(n, n % 180, f"bread{n}") for n in range(360)])
    start(spark, folder, out, path("state")).awaitTermination()
    for hour in ("15020402",):
        left = vs.names(spark, f"{out}/open/batch_id=0/yymmddhh={hour}")
        assert 0 < len([n for n in left if n.endswith(".parquet")]) <= 2
    got = hr.read_closed(spark, out).agg(F.sum("cnt")).first()[0]
    assert got == 2 * 60 * 2  # of the one hour that is behind
