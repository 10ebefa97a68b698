"""What grows with the buildings does not go through the driver."""

from pyspark.sql import functions as F

from gablestone.operators import chain, evidence, spatial
from gablestone.plans import chain_queries
from gablestone.sources.adapters import view

K = ["src_building", "k1", "k2", "k3", "k4"]


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_boxes_that_carry_much_are_not_broadcast(spark):
    points = spark.range(100).selectExpr("cast(id as double) as x", "cast(id as double) as y")
    boxes = spark.range(90).selectExpr("id", "cast(id as double) as bx1", "0.0D as by1", "cast(id as double) + 1 as bx2", "100.0D as by2")
    few, much = spatial.join_boxes(points, boxes), spatial.join_boxes(points, boxes.withColumn("sides", F.array_repeat(F.lit(1.5), 20_000)))
    assert "BroadcastHashJoin" in plan(few) and "BroadcastHashJoin" not in plan(much)
    assert sorted(r.id for r in much.select("id").collect()) == sorted(r.id for r in few.select("id").collect()) and few.count() == 180


def test_measures_of_a_report_meet_in_tasks(spark, sf_dir):
    """Each is cut by itself, so that the last plan only joins them, building by building."""
    text = plan(evidence.quality_report(view(spark, sf_dir, "v_points"), view(spark, sf_dir, "v_edges"), K))
    assert "Broadcast" not in text and text.count("SortMergeJoin") == 7 and "Generate" not in text


def test_buildings_stand_for_their_edges(spark, sf_dir):
    """Measures of buildings that were found before are those of their edges."""
    points, edges = view(spark, sf_dir, "v_points"), view(spark, sf_dir, "v_edges2")
    own = spatial.buildings(edges)
    inside = evidence.inside_points(points, own, K)
    rows = lambda df: sorted(map(tuple, df.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes]).collect()))
    assert spatial.buildings(own) is own and rows(spatial.morphology(own)) == rows(spatial.morphology(edges))
    assert rows(spatial.building_summary(points, own, inside=inside)) == rows(spatial.building_summary(points, edges))


def test_the_chain_keeps_its_plan_small(spark, sf_dir):
    """The evidence is joined from tables that are done; before, the plan held all measures at once and broadcast them."""
    text = plan(chain.decided(chain_queries._measured(spark, sf_dir), chain_queries._requests(spark, sf_dir)))
    assert "Broadcast" not in text and "Generate" not in text and "MapInArrow" not in text


def test_plans_rest_on_tables_that_are_done(spark, sf_dir):
    rows = chain_queries.c02_plans(spark, sf_dir)
    assert "Broadcast" not in plan(rows) and "MapInArrow" not in plan(rows) and "FlatMapGroups" not in plan(rows)
    assert rows.count() == view(spark, sf_dir, "v_edges").select("building_id").distinct().count()
