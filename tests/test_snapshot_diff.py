import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from harspan.functions.dates import calendar_day, registry_day
from harspan.operators import snapshot_diff

SCHEMA = "row_id long, snapshot_no int, licNo string, licenseStatus string, licExpDate string, loaded_at timestamp, place string"


def brute(rows):
    last = {}
    for snap, key, value in rows:
        last[(snap, key)] = value
    snaps = sorted({s for s, _ in last})
    out = set()
    for old, new in zip(snaps, snaps[1:]):
        for key in {k for s, k in last if s in (old, new)}:
            a, b = last.get((old, key)), last.get((new, key))
            if a is None:
                out.add((new, key, "added"))
            elif b is None:
                out.add((new, key, "removed"))
            elif a != b:
                out.add((new, key, "changed"))
    return out


@pytest.mark.parametrize("chunk", [1, 2, 7, 1000])
def test_against_brute_force(spark, chunk):
    rng = random.Random(chunk)
    rows = []
    for snap in (1, 2, 5, 6):
        for k in range(300):
            if rng.random() < 0.9:
                rows.append((snap, f"K{k:04d}", (rng.choice("ab") if rng.random() < 0.1 else "a", None if k % 9 == 0 else str(k % 5 + (rng.random() < 0.02)))))
    df = spark.createDataFrame([(s, k, *v) for s, k, v in rows], "snapshot_no int, row_key string, status string, expires string")
    found = snapshot_diff.diff_snapshots(df.repartition(3), chunk)
    assert {(r.snapshot_no, r.row_key, r.change_kind) for r in found.collect()} == brute(rows)


def test_licences(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [
        (1, 1, " q-1", "Active", "2024-01-05", t(1), "x"), (2, 2, "Q-1 ", " ACTIVE ", "05/01/2024", t(1), "x"),
        (3, 1, "Q-2", "Active", None, t(1), "x"), (4, 2, "Q-2", "Active", "2024-01-01", t(1), "x"),
        (5, 1, "Q-3", "Active", "no date", t(1), "x"), (6, 2, "Q-3", "Expired", "no date", t(2), "x"), (7, 2, "Q-3", "Active", "No Date", t(3), "x"),
        (8, 1, "Q-4", "Active", "2024-01-01", t(1), "x"), (9, 3, "Q-4", "Active", "2024-01-01", t(1), "x"),
        (10, 2, None, "Active", "2024-01-01", t(1), "x"), (11, 2, "  ", "Active", None, None, None),
    ]
    out = {(r.snapshot_no, r.licno, r.change_kind) for r in snapshot_diff.licence_changes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {(2, "Q-2", "changed"), (2, "Q-4", "removed"), (3, "Q-4", "added"), (3, "Q-1", "removed"), (3, "Q-2", "removed"), (3, "Q-3", "removed")}


def test_ties_repeats_and_empty(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1, "A", "x", None, t, "p"), (2, 1, "A", "y", None, t, "p"), (2, 1, "A", "y", None, t, "p"), (3, 2, "A", "y", None, t, "p")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert snapshot_diff.licence_changes(df).count() == 0
    assert snapshot_diff.licence_changes(df.where("snapshot_no = 1")).count() == 0
    assert snapshot_diff.licence_changes(df.where("false")).count() == 0


def test_days(spark):
    texts = ["2024-1-5", "05/03/2024", "12/25/2024", "5 Jan 2024", "25-12-2024", "31/31/2024", "x", None, ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(calendar_day(F.col("t")).cast("string").alias("d")).collect()
    assert [r.d for r in rows] == ["2024-01-05", "2024-03-05", "2024-12-25", "2024-01-05", "2024-12-25", None, None, None, None]
    told = ["2024-1-5", "05/03/2024", "12/25/2024", "5 Jan 2024", "1704412800", "1704412800000", " not a date ", "", None]
    rows = spark.createDataFrame([(t,) for t in told], "t string").select(registry_day(F.col("t")).alias("d")).collect()
    assert [r.d for r in rows] == ["2024-01-05", "2024-03-05", "2024-12-25", "2024-01-05", "2024-01-05", "2024-01-05", "not a date", None, None]
