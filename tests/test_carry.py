"""Last values, running counts and sessions by key against plain loops, with a key that has a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import PipelineConfig
from millrace.operators.carry import SLICE, ordered, with_last, with_running, with_sessions

SCHEMA = "id long, key string, at long, value string, amount long, _before string"


def rows_of(seed=1, n=1500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice(["hot", f"k{rng.randrange(40)}", f"k{rng.randrange(40)}"])
        at = rng.choice([None, rng.randrange(20_000), rng.randrange(20_000), 7_777]) if rng.random() < 0.3 else rng.randrange(20_000)
        rows.append((i, rng.choice([None, key]) if rng.random() < 0.02 else key, at, rng.choice([None, None, f"v{i}"]), rng.choice([None, 0, 1, 5]), "clash"))
    return rows


def by_key(rows):
    keys = {}
    for r in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        keys.setdefault(r[1], []).append(r)
    return keys.values()


@pytest.mark.parametrize("slice_rows,limit", [(1_000_000, 1_000_000), (60, 1_000_000), (60, 0), (1, 1_000_000)])
@pytest.mark.parametrize("inclusive", [True, False])
def test_last_values_and_running_sums(spark, slice_rows, limit, inclusive):
    rows = rows_of()
    last, sums = {}, {}
    for group in by_key(rows):
        seen = total = None
        for r in group:
            before = seen
            seen = r[3] if r[3] is not None else seen
            last[r[0]] = seen if inclusive else before
            total = total if r[4] is None else r[4] + (total or 0)
            sums[r[0]] = total
    config = PipelineConfig(broadcast_limit_rows=limit)
    table = spark.createDataFrame([r[:5] for r in rows], SCHEMA.rsplit(",", 1)[0]).repartition(5)
    found = ordered(table, "key", "at", ["id"], config, slice_rows, 100)
    assert found.hot == (slice_rows < 1000)
    got = with_last(found, "value", "out", inclusive)
    assert got.columns == [*table.columns, "out"]
    assert {r["id"]: r["out"] for r in got.collect()} == last
    assert {r["id"]: r["out"] for r in with_running(found, "amount", "out").collect()} == sums


def test_no_slice_holds_the_hot_key(spark):
    table = spark.createDataFrame([r[:5] for r in rows_of(2, 6000)], SCHEMA.rsplit(",", 1)[0])
    found = ordered(table, "key", "at", ["id"], PipelineConfig(), 100, 10)
    most = found.rows.where("key = 'hot'").groupBy(SLICE).agg(F.count("*").alias("n"), F.count_if(F.col("at") == 7_777).alias("tied"), F.count_if(F.col("at").isNull()).alias("untimed")).collect()
    assert len(most) > 10 and all(r["n"] - r["tied"] - r["untimed"] <= 220 for r in most)


@pytest.mark.parametrize("slice_rows", [1_000_000, 80])
def test_sessions(spark, slice_rows):
    rows = rows_of(3)
    want = {}
    for group in by_key(rows):
        number, before = 0, None
        for r in group:
            if r[2] is not None and (before is None or r[2] - before > 300):
                number += 1
            before = r[2] if r[2] is not None else before
            want[r[0]] = max(number, 1)
    table = spark.createDataFrame([r[:5] for r in rows], SCHEMA.rsplit(",", 1)[0])
    got = with_sessions(table, "key", "at", ["id"], 300, PipelineConfig(), slice_rows=slice_rows, stretch=50)
    assert {r["id"]: r["session"] for r in got.collect()} == want and got.columns == [*table.columns, "session"]


def test_no_rows(spark):
    table = spark.createDataFrame([], SCHEMA.rsplit(",", 1)[0])
    assert with_sessions(table, "key", "at", ["id"], 300, PipelineConfig()).collect() == []
