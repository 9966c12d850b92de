"""Ordered operators against plain Python, with limits low enough to take the staged way."""

import random

import pytest
from pyspark.sql import functions as F

from questmart.operators.ordering import (
    assign_dense_ids,
    running_totals,
    stage_sorted,
    with_last_seen,
    with_next,
)
from questmart.sources.health import fill_durations, fill_event_ids


@pytest.fixture(scope="module", autouse=True)
def many_partitions(spark):
    """Small rows would be coalesced into one partition; keep several so that borders are crossed."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(600):
        key = rng.choice(["hot", "hot", "hot", "a", "b", None])
        marker = rng.choice([None, None, None, i])
        out.append((key, rng.randrange(50), i, marker))
    return out


@pytest.fixture
def frame(spark, rows):
    return spark.createDataFrame(rows, "k STRING, t INT, i INT, m INT").repartition(4)


def test_dense_ids_are_dense_and_ordered(frame, rows):
    got = assign_dense_ids(frame, ["t", "i"], "id").select("t", "i", "id").collect()
    want = {(t, i): n for n, (_, t, i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[2])), start=1)}
    assert {(r.t, r.i): r.id for r in got} == want


def test_dense_ids_keep_given_ids_and_start_behind(spark):
    df = spark.createDataFrame([(3, None), (1, 77), (2, None)], "t INT, id BIGINT")
    got = {r.t: r.id for r in assign_dense_ids(df, ["t"], "id", after=100).collect()}
    assert got == {1: 77, 2: 102, 3: 103}


def test_copies_spread_over_partitions(spark):
    df = spark.range(4000).select(F.lit(1).alias("t"))
    staged = stage_sorted(df, ["t"], "copies")
    sizes = [r["count"] for r in staged.groupBy("_part").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2500
    ids = assign_dense_ids(df, ["t"], "id").agg(F.count_distinct("id"), F.min("id"), F.max("id")).first()
    assert tuple(ids) == (4000, 1, 4000)


def test_running_totals(frame, rows):
    got = {(r.t, r.i): r.i_before for r in running_totals(frame, ["t", "i"], ["i"]).collect()}
    total, want = 0, {}
    for _, t, i, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        want[(t, i)] = total
        total += i
    assert got == want


def _per_key(rows):
    keyed = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        keyed.setdefault(row[0], []).append(row)
    return keyed


def test_next_row(frame, rows):
    got = {r.i: r.next_i for r in with_next(frame, ["k"], ["t", "i"], ["i"]).collect()}
    want = {}
    for own in _per_key(rows).values():
        for row, following in zip(own, [*own[1:], None]):
            want[row[2]] = following[2] if following else None
    assert got == want


def test_last_seen(frame, rows):
    got = {r.i: (r.m_now, r.m_before) for r in with_last_seen(frame, ["k"], ["t", "i"], "m").collect()}
    want = {}
    for own in _per_key(rows).values():
        last = None
        for row in own:
            before, last = last, row[3] if row[3] is not None else last
            want[row[2]] = (last, before)
    assert got == want


def test_marker_carried_through_partitions_without_one(spark):
    rows = [("hot", i, i, 9 if i == 0 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "k STRING, t INT, i INT, m INT").repartition(4)
    got = with_last_seen(df, ["k"], ["t"], "m").where(F.col("m_now") != 9).count()
    missing = with_last_seen(df, ["k"], ["t"], "m").where(F.col("m_now").isNull()).count()
    assert (got, missing) == (0, 0)


def test_duration_counts_second_boundaries(spark):
    df = spark.sql(
        "SELECT TIMESTAMP '2025-01-01 00:00:00.9' AS session_start, TIMESTAMP '2025-01-01 00:00:01.1' AS session_end, CAST(NULL AS BIGINT) AS duration_seconds "
        "UNION ALL SELECT TIMESTAMP '2025-01-01 00:00:00', TIMESTAMP '2025-01-01 00:10:00', 5"
    )
    assert sorted(r.duration_seconds for r in fill_durations(df).collect()) == [1, 5]


def test_equal_times_get_distinct_event_ids(spark):
    df = spark.sql(
        "SELECT TIMESTAMP '2025-01-01' AS event_date, a AS account_id, 'x' AS event_type, 'y' AS event_subtype, '{}' AS event_metadata "
        "FROM VALUES ('b'), ('a'), ('c') AS v(a)"
    )
    assert {r.account_id: r.event_id for r in fill_event_ids(df).collect()} == {"a": 1, "b": 2, "c": 3}
