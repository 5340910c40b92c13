"""Medians from states kept by day, against plain ones; old days are not read again."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tagloom.operators import daily_medians


def rows_of(seed, days, per_day):
    rnd = random.Random(seed)
    draw = {"even": lambda d: rnd.random(), "ties": lambda d: float(rnd.randint(0, 3)), "drift": lambda d: d + rnd.gauss(0, 0.01)}
    rows = [(f"2024-01-{d:02d}", w, f(d), -f(d)) for d in days for w, f in draw.items() for _ in range(rnd.randint(1, per_day))]
    # a writer of one run, one with two values far apart, nothing measured, no writer, no day
    return rows + [(f"2024-01-{days[0]:02d}", "one", 3.5, None), (f"2024-01-{days[0]:02d}", "two", -1e300, 1.0), (f"2024-01-{days[-1]:02d}", "two", 1e300, 2.0),
                   (f"2024-01-{days[0]:02d}", "none", None, None), (f"2024-01-{days[0]:02d}", None, 1.0, 1.0), (None, "even", 9.0, 9.0)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "day string, writer string, m double, k double").repartition(4)


def plain(rows):
    out = {}
    for w in {r[1] for r in rows if r[0] and r[1]}:
        middle = [statistics.median(vs) if (vs := [r[at] for r in rows if r[0] and r[1] == w and r[at] is not None]) else None for at in (2, 3)]
        if middle != [None, None]:
            out[w] = tuple(middle)
    return out


def kept(spark, folder, **how):
    return {r.writer: (r.m, r.k) for r in daily_medians.medians(spark, folder, ("m", "k"), **how).collect()}


@pytest.mark.parametrize(("fences", "last_values"), [(4, 12), (64, 20_000)])
def test_medians_over_growing_days(spark, tmp_path, fences, last_values):
    folder = str(tmp_path / "state")
    old, new = rows_of(1, [1, 2, 3], 900), rows_of(2, [4, 5], 1500)
    daily_medians.add_days(frame(spark, old), folder, ("m", "k"), fences)
    assert kept(spark, folder, last_values=last_values) == plain(old)
    # reading a value of an old day would end the job
    seen = F.col("day") < "2024-01-04"
    guarded = frame(spark, old + new).withColumn("m", F.when(seen, F.raise_error(F.lit("read again")).cast("double")).otherwise(F.col("m")))
    daily_medians.add_days(guarded, folder, ("m", "k"), fences)
    assert kept(spark, folder, last_values=last_values) == plain(old + new)
    daily_medians.add_days(guarded.where("day is not null"), folder, ("m", "k"), fences)  # nothing new
    assert kept(spark, folder, last_values=last_values) == plain(old + new)


def test_old_partitions_are_not_opened(spark, tmp_path):
    rows = rows_of(3, [1, 2, 3], 300)
    frame(spark, [r for r in rows if r[0]]).write.partitionBy("day").parquet(str(tmp_path / "runs"))
    runs, folder = spark.read.parquet(str(tmp_path / "runs")), str(tmp_path / "state")
    daily_medians.add_days(runs.where("day <= '2024-01-02'"), folder, ("m", "k"))
    known = sorted(str(r.day) for r in daily_medians.kept_days(spark, folder).collect())
    assert known == ["2024-01-01", "2024-01-02"]
    for day in known:  # what is there now is no Parquet file any more
        for path in (tmp_path / "runs" / f"day={day}").glob("*.parquet"):
            path.write_bytes(b"not a table")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    daily_medians.add_days(runs, folder, ("m", "k"))
    assert kept(spark, folder) == plain(rows)


def test_a_lost_job_leaves_nothing(spark, tmp_path, monkeypatch):
    folder, rows = str(tmp_path / "state"), rows_of(4, [1, 2], 200)
    assert kept(spark, folder) == {}
    with monkeypatch.context() as m:
        m.setattr(daily_medians, "FENCE_SHAPE", None)
        m.setattr(daily_medians, "VALUE_SHAPE", None)  # fails after the values were written
        m.setattr(daily_medians, "kept_days", lambda *_: spark.createDataFrame([], "day string"))
        with pytest.raises(Exception):
            daily_medians.add_days(frame(spark, rows), folder, ("m", "k"))
    assert kept(spark, folder) == {}
    daily_medians.add_days(frame(spark, rows), folder, ("m", "k"))
    assert kept(spark, folder) == plain(rows)


def test_few_values_are_read_again(spark, tmp_path):
    folder = str(tmp_path / "state")
    rnd = random.Random(5)
    rows = [(f"2024-01-{d:02d}", "w", rnd.random(), None) for d in range(1, 6) for _ in range(2000)]
    daily_medians.add_days(frame(spark, rows), folder, ("m",))
    held, below = daily_medians.open_fences(spark, folder)
    assert held.count() <= 3 * 5 and below.first()["size"] == 10_000
