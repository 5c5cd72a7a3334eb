"""What the larger steps read and move."""

from pyspark.sql import functions as F

from tideline.queries import driver_tables
from tideline.sources import tables as t

SMALL = "/root/testdata/sf0.001"


def test_marks_lose_no_wanted_row(spark):
    df = spark.range(200_000).selectExpr("id", "case when id % 1000 <> 7 then concat('d', id) end as name", "-id as n")
    for key, wanted in (("name", "concat('d', id * 400)"), ("n", "-id * 400")):
        keys = spark.range(500).selectExpr(f"{wanted} as w", "id")
        listed = keys.selectExpr(f"w as {key}")
        want = {r[0] for r in df.join(listed, key, "left_semi").select("id").collect()}
        near = {r[0] for r in t.marked(df, listed, key).select("id").collect()}
        assert want and want <= near and len(near) < len(want) + 200
        assert {r[0] for r in t.only(df, keys, key, "w").select("id").collect()} == want
    assert t.marked(df, df.where("false").select("name"), "name").isEmpty()


def test_only_shuffles_wanted_rows(spark):
    keys = spark.range(10).selectExpr("concat('d', id) as w")
    plan = t.only(spark.range(100).selectExpr("concat('d', id) as id", "id as v"), keys, "id", "w")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 2 and "getbit" in plan


def test_leads_of_one_source(spark):
    src = driver_tables.sources(spark, SMALL)
    some, rest = t.leads(src, "dealership"), t.leads(src).filter(F.col("all_src") == "dealership")
    assert some.count() == rest.count() > 0 and some.exceptAll(rest).isEmpty()
