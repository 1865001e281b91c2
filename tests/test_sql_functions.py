"""SQL table functions give what the DataFrame operators give."""

import random

import pytest
from pyspark.sql import functions as F

from edgeloom.functions import tables
from edgeloom.operators import edges, mapping, template


@pytest.fixture(scope="module")
def views(spark):
    rng = random.Random(1)
    rows = [(rng.choice([*range(8), None]), rng.choice([*range(8), None]), rng.choice([None, *range(6)])) for _ in range(300)]
    held = {
        "e_": spark.createDataFrame(rows, "source bigint, target bigint, weight bigint"), "i_": spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "id bigint"),
        "x_": spark.createDataFrame([("1", "A_1"), ("1", "A_0"), ("2", "B_2"), (None, "C_3")], "accession string, vfb_id string"),
    }
    for name, df in held.items():
        df.createOrReplaceTempView(name)
    names = tables.register(spark, "e_", "i_", "x_", prefix="t_")
    assert "t_edges_within" in names
    yield tuple(held.values())
    for name in held:
        spark.catalog.dropTempView(name)


def bag(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("threshold", [0, 3])
def test_functions_equal_operators(spark, views, threshold):
    e, i, x = views
    facts = template.rows(edges.over(e, threshold), x)
    pairs = {
        f"t_edges_over({threshold})": edges.over(e, threshold), f"t_edges_within({threshold})": edges.over(edges.within(e, i), threshold), f"t_edges_summed({threshold})": edges.over(edges.summed(edges.within(e, i)), threshold),
        "t_node_strengths()": edges.strengths(e), "t_unmapped_ids()": mapping.unmapped(e, x), f"t_template_facts({threshold})": facts.select(*template.COLUMNS),
    }
    for call, want in pairs.items():
        found = spark.sql(f"SELECT * FROM {call}")
        assert [c.lower() for c in found.columns] == [c.lower() for c in want.columns], call
        assert bag(found) == bag(want), call


def test_columns_are_known_and_filters_reach_the_scan(spark, views, tmp_path):
    views[0].write.parquet(str(tmp_path / "e"))
    spark.read.parquet(str(tmp_path / "e")).createOrReplaceTempView("f_")
    tables.register(spark, "f_", "i_", "x_", prefix="u_")
    found = spark.sql("SELECT source FROM u_edges_over(4) WHERE target = 2")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.schema.names == ["source"] and "Python" not in plan
    assert "GreaterThan(weight,4)" in plan and "EqualTo(target,2)" in plan
    assert found.count() == views[0].filter((F.col("weight") > 4) & (F.col("target") == 2)).count()
