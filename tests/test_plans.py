"""Physical-plan checks of the scale properties the queries rely on."""

from encore import schemas
from encore.operators.gold import gold_layout
from encore.plans import dashboard, lake, recommend
from encore.sources import fixtures

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _gold_table(spark, tmp_root):
    p = f"{tmp_root}/gold"
    gold_layout(lake.from_tables(spark, SF).gold).write.partitionBy("event_month").parquet(p)
    return spark.read.schema(schemas.GOLD).parquet(p)


def test_message_parsed_once(spark):
    valid = lake.from_tables(spark, SF).valid
    plan = _plan(valid)
    assert plan.count("from_json(") == 1, plan


def test_time_range_prunes_months_and_pushes_filters(spark, tmp_root):
    g = _gold_table(spark, tmp_root)
    df = dashboard.listening_trend(g, "1 hour", "2024-01-05 00:00:00", "2024-01-06 00:00:00")
    sp = df._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters" in sp and ">= 202401" in sp
    assert "GreaterThanOrEqual(event_timestamp" in sp


def test_top_n_per_group_limits_before_shuffle(spark, tmp_root):
    g = _gold_table(spark, tmp_root)
    recs = recommend.recommend(g, 3, as_of="2024-02-01 00:00:00")
    sp = recs._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in sp


def test_gold_scan_reads_only_needed_columns(spark, tmp_root):
    g = _gold_table(spark, tmp_root)
    sp = dashboard.top_songs(g, 5)._jdf.queryExecution().sparkPlan().toString()
    assert "ReadSchema: struct<song_name:string,artist_name:string,event_type:string>" in sp


def test_fixture_scan_is_spread(spark):
    ev = fixtures.raw_events(spark, SF)
    assert ev.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_recent_window_queries_prune_months(spark, tmp_root):
    from encore.plans import insights
    g = _gold_table(spark, tmp_root)
    for df in (insights.trending_songs(g, as_of="2024-01-20 00:00:00"),
               insights.growing_artists(g, week="2024-01-15")):
        sp = df._jdf.queryExecution().sparkPlan().toString()
        assert "PartitionFilters: [isnotnull(event_month" in sp and "<= 202401" in sp, sp
    # default bounds come from a scalar subquery: the month filter prunes at run time
    sp = insights.trending_songs(g)._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in sp and "scalar-subquery" in sp
    sp = dashboard.top_songs(g, 5, day="2024-01-15")._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in sp and "= 202401)]" in sp
    assert ">= 2024-01-15 00:00:00)" in sp    # a plain range on the column, not to_date()
