import datetime as dt

import pytest
from pyspark.sql import functions as F

from spinledger.functions import joins, ranking, tiers, timeparts
from spinledger.functions.rounding import half_up


def times(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(
        "CAST(t AS timestamp_ntz) AS played_at"
    )


def test_local_time_over_both_dst_changes(spark):
    rows = times(
        spark,
        ["2024-03-10 08:59:59", "2024-03-10 09:00:00", "2024-11-03 07:30:00", "2024-11-03 08:30:00"],
    )
    got = [r.local_timestamp for r in timeparts.add_local_time(rows).collect()]
    assert got == [
        dt.datetime(2024, 3, 10, 1, 59, 59),
        dt.datetime(2024, 3, 10, 3, 0),
        dt.datetime(2024, 11, 3, 1, 30),
        dt.datetime(2024, 11, 3, 1, 30),
    ]


def test_weekday_numbers_and_weekend(spark):
    # Sunday, Monday, Saturday at local noon
    rows = times(spark, ["2024-01-07 19:00:00", "2024-01-08 19:00:00", "2024-01-06 19:00:00"])
    got = timeparts.add_local_time(rows).select("local_day_of_week", "is_weekend").collect()
    assert [tuple(r) for r in got] == [(0, True), (1, False), (6, True)]


@pytest.mark.parametrize(
    "hour, part",
    [(5, "Night"), (6, "Morning"), (11, "Morning"), (12, "Afternoon"), (17, "Afternoon"),
     (18, "Evening"), (21, "Evening"), (22, "Night")],
)
def test_day_parts(spark, hour, part):
    assert spark.range(1).select(timeparts.day_part(F.lit(hour))).head()[0] == part


def test_release_dates(spark):
    rows = spark.createDataFrame([("2015",), ("2015-10-15",), ("bad",), (None,)], "d string")
    got = rows.select(
        timeparts.release_date(F.col("d")), timeparts.release_year(F.col("d")),
        timeparts.release_year(F.col("d"), None),
    ).collect()
    assert [tuple(r) for r in got] == [
        (dt.date(2015, 1, 1), 2015, 2015),
        (dt.date(2015, 10, 15), 2015, 2015),
        (None, 2000, None),
        (None, 2000, None),
    ]


def test_tier_edges(spark):
    row = spark.range(1).select(
        tiers.popularity_tier(F.lit(80)), tiers.popularity_tier(F.lit(79)),
        tiers.popularity_tier(F.lit(None).cast("int")), tiers.duration_bucket(F.lit(119999)),
        tiers.duration_bucket(F.lit(420000)), tiers.era(F.lit(1989)),
    ).head()
    assert tuple(row) == (4, 3, 0, 0, 5, "classic")


def test_half_up_ignores_binary_noise(spark):
    assert spark.range(1).select(half_up(F.lit(53.349999999999994), 1)).head()[0] == 53.4


def test_salted_join_equals_plain_join(spark):
    facts = spark.range(3000).selectExpr(
        "string(id) AS play", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL "
        "ELSE string(id % 50) END AS k"
    )
    dim = spark.range(40).selectExpr("string(id) AS key", "id * 2 AS v").union(
        spark.createDataFrame([("hot", -1)], "key string, v bigint")
    )
    for how in ("left", "inner"):
        salted = joins.salted_dimension_join(facts, dim, "k", "key", ["play"], how, 8, max_bytes=0)
        plain = facts.join(dim, F.col("k") == F.col("key"), how)
        assert sorted(salted.collect(), key=str) == sorted(plain.collect(), key=str)


def test_hot_key_is_spread_by_its_count_and_cold_keys_are_not_copied(spark):
    facts = spark.range(60_000).selectExpr(
        "string(id) AS play", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL "
        "ELSE string(id % 20000) END AS k"
    )
    dim = spark.range(20_000).selectExpr("string(id) AS key").union(
        spark.createDataFrame([("hot",)], "key string")
    )
    hot = {r["_hot"]: r["_salts"] for r in joins.hot_keys(facts, "k", 128).collect()}
    assert hot == {"hot": 43}
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2000")
    try:
        joined = joins.salted_dimension_join(facts, dim, "k", "key", ["play"], max_bytes=0)
        rows = joined.groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert rows.sum() == 60_000 and rows.max() <= 2 * rows.median()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_dimension_is_not_broadcast(spark):
    dim = spark.range(1000).selectExpr("id AS key")
    assert joins.fits_broadcast(dim)
    assert not joins.fits_broadcast(dim, max_bytes=10)


def test_dimension_is_measured_by_its_rows_not_by_its_files(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(3_000_000).selectExpr("id % 7 AS key", "'a name of some length' AS name").write.parquet(path)
    dim = spark.read.parquet(path)
    assert joins.planned_bytes(dim) < 1 << 20 and not joins.fits_broadcast(dim)
    assert not joins.fits_broadcast(dim.groupBy("key").agg(F.max("name").alias("name")))
    assert joins.fits_broadcast(dim, max_bytes=1 << 30)
    joined = joins.join_dimension(spark.range(10).withColumnRenamed("id", "key"), dim, "key")
    assert "strategy=broadcast" not in joined._jdf.queryExecution().analyzed().toString()


def test_exact_row_number_is_gap_free_and_ordered(spark):
    rows = spark.range(500).selectExpr("id % 3 AS a", "string(id) AS b")
    got = ranking.exact_row_number(rows, ["a", "b"], "n").collect()
    want = sorted((r.a, r.b) for r in got)
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.n)] == want
    assert sorted(r.n for r in got) == list(range(1, 501))


def test_average_percent_rank_matches_pandas(spark):
    values = [5, 1, 1, 3, 3, 3, 0, 9]
    rows = spark.createDataFrame([(v,) for v in values], "v int")
    got = ranking.average_percent_rank(rows, "v", "r").toPandas()
    want = got["v"].rank(method="average", pct=True)
    assert (got["r"] - want).abs().max() < 1e-12


def test_most_frequent_breaks_ties_by_value(spark):
    rows = spark.createDataFrame([("g", "b"), ("g", "a"), ("h", None)], "g string, v string")
    got = {r.g: (r.v, r.plays) for r in ranking.most_frequent(rows, ["g"], "v").collect()}
    assert got == {"g": ("a", 1), "h": (None, 1)}


def test_top_per_group_is_cut_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("id % 2 AS g", "id")
    top = ranking.top_per_group(rows, ["g"], [F.desc("id")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r.id for r in top.collect()) == [994, 995, 996, 997, 998, 999]
