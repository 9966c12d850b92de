"""What one task holds in memory must not grow with what it reads."""

from questmart.operators import accounts, ordering
from questmart.session import open_folders
from questmart.sources import star_tables
from questmart.sources.rates import exchange_rate
from tests.tables import bronze, event, frame
from tests.test_plans import plan

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def written_plan(spark, table):
    return spark.sql(f"EXPLAIN INSERT INTO {table} SELECT id, id % 3 AS kind FROM range(10)").first()[0]


def test_few_folders_are_written_without_a_sort(spark):
    spark.sql("CREATE TABLE foldered (id BIGINT, kind BIGINT) USING parquet PARTITIONED BY (kind)")
    before = spark.conf.get(WRITERS)
    try:
        assert "Sort" in written_plan(spark, "foldered")
        with open_folders(spark):
            assert "Sort" not in written_plan(spark, "foldered")
            spark.range(10).selectExpr("id", "id % 3 AS kind").write.insertInto("foldered")
        assert sorted(tuple(r) for r in spark.table("foldered").collect()) == [(i, i % 3) for i in range(10)]
    finally:
        spark.sql("DROP TABLE foldered")
    assert spark.conf.get(WRITERS) == before


def test_event_role_is_stored_without_a_sort(spark, sf_dir, monkeypatch):
    """every task sorted its events by type before it wrote them."""

    class Watched:
        sparkContext, conf = spark.sparkContext, spark.conf
        read = property(lambda self: spark.read)

        def sql(self, text):
            open_at_once.append(int(spark.conf.get(WRITERS)))
            return spark.sql(text)

    open_at_once = []
    monkeypatch.setattr(star_tables, "_stored", {})
    events = star_tables.StarBronze(Watched(), sf_dir).events
    types = events.select("event_type").distinct().count()
    assert open_at_once and all(types <= n for n in open_at_once)
    assert events.count() == star_tables.read_star(spark, sf_dir, "lineitem").count()


def test_facts_are_dealt_out_before_they_are_added_up(spark):
    """hash tables of facts grew with what a reading task read."""
    text = plan(accounts.fact_totals(frame(spark, "events", []), exchange_rate(spark)))
    dealt = text.index("Exchange hashpartitioning(account_id")
    assert "REPARTITION_BY_NUM" in text[dealt:].splitlines()[0]
    assert "Aggregate" in text[:dealt] and "Aggregate" not in text[dealt:]


def test_levels_of_a_busy_account_are_spread_by_level(spark):
    passed = [event(n, "progression", "level_success", "2025-01-01 10:00", "a", level_id=f"LEVEL_{n % 3:03d}") for n in range(30)]
    passed.append(event(99, "progression", "level_success", "2025-01-01 10:00", "a"))
    t = bronze(spark, events=passed)
    totals = accounts.fact_totals(t.events, t.exchange_rate)
    assert sorted((r.value or "", r.n) for r in totals.collect()) == [("", 1), ("000", 10), ("001", 10), ("002", 10)]
    row = accounts.event_profile(t.events, t.exchange_rate).first()
    assert (row.last_completed_level, row.has_level, row.number_of_purchases) == (2, True, None)


def test_rows_that_all_have_ids_are_not_sorted_to_number_them(spark, monkeypatch):
    """the load sorted and stored all events once more for ids that none lacked."""

    def stored(*_):
        raise AssertionError("sorted and stored")

    rows = spark.createDataFrame([(7, "b"), (3, "a")], "id BIGINT, name STRING")
    missing = spark.createDataFrame([(7, "b"), (None, "a")], "id BIGINT, name STRING")
    assert sorted(tuple(r) for r in ordering.assign_dense_ids(missing, ["name"], "id").collect()) == [(1, "a"), (7, "b")]
    monkeypatch.setattr(ordering, "stage_sorted", stored)
    assert sorted(tuple(r) for r in ordering.assign_dense_ids(rows, ["name"], "id").collect()) == [(3, "a"), (7, "b")]
