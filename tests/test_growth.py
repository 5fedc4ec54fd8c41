"""Plans whose work grows with the tables: what is broadcast, how rows are dealt, and that no step expands in one place."""

import re

import pytest
from pyspark.sql import functions as F

from skyfilm.operators import joins as J
from skyfilm.operators import tables
from skyfilm.plans import registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_of_words_are_not_broadcast(spark, tmp_path):
    spark.range(40).selectExpr("id AS k", "concat_ws(' ', 'red', 'ring', id % 7, 'of', repeat('a b ', 50)) AS text").coalesce(1).write.parquet(f"{tmp_path}/texts")
    spark.range(20000).selectExpr("concat('red ring ', id) AS name", "id AS p").coalesce(1).write.parquet(f"{tmp_path}/names")
    texts, names = (spark.read.parquet(f"{tmp_path}/{t}") for t in ("texts", "names"))
    found = J.contained_names(texts, "k", "text", names, "name", "p")
    assert "BuildLeft" not in plan(found) and "BuildRight" in plan(found)
    many = J.contained_names(texts, "k", "text", names.withColumn("more", F.expr("repeat(name, 60)")), "name", "p")
    assert "BroadcastExchange" not in plan(many)
    for df in (found, many):
        assert {r["k"]: r["name"] for r in df.collect()} == {k: f"red ring {k % 7}" for k in range(40)}


def test_rows_are_dealt_by_key_to_tasks_of_one_size(spark, monkeypatch):
    rows = spark.range(9000).selectExpr("id % 500 AS k", "id AS x")
    monkeypatch.setattr(tables, "ROWS_A_TASK", 1000)
    monkeypatch.setattr(tables, "MOST_OF_KEY", 100)
    assert tables.dealt(rows).rdd.getNumPartitions() == 9 and tables.dealt(rows.limit(900)).rdd.getNumPartitions() == 8
    hot = rows.unionByName(spark.range(200).selectExpr("7 AS k", "id AS x"))
    assert "Exchange" not in plan(tables.dealt(hot)) and tables.dealt(rows.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["im35_long_lines", "im35_without_lines", "im32_equalised", "dt20_thresholds", "im24_noise", "im20_trace", "im07_densest_window"])
def test_steps_over_pictures_leave_them_in_their_task(spark, monkeypatch, name):
    monkeypatch.setattr(tables, "ROWS_A_TASK", 1000)
    exchanges = re.findall(r"Exchange (\S+partitioning\([^)]*\))", plan(registry.QUERIES[name](spark, "/root/testdata/sf0.001")))
    assert exchanges and all(re.fullmatch(r"hashpartitioning\(k#\d+L, \d+\)", e) for e in exchanges), exchanges


@pytest.mark.parametrize("name", ["im35_without_lines", "im32_equalised", "im20_trace", "im04_components"])
def test_pictures_of_too_many_pixels_give_the_same(spark, monkeypatch, name):
    """Where a key is hot its lines and places are dealt, with the same rows."""
    whole = registry.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    monkeypatch.setattr(tables, "MOST_OF_KEY", 10)
    assert sorted(registry.QUERIES[name](spark, "/root/testdata/sf0.001").collect()) == sorted(whole)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
@pytest.mark.parametrize("name", ["im16_centroids", "im40_mark_sequence"])
def test_parts_of_many_tasks_are_joined_with_what_follows_from_them(spark, monkeypatch, name, broadcast):
    """The second use of the parts reads the exchanges of the first, and runs still meet their labels."""
    whole = registry.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    monkeypatch.setattr(tables, "ROWS_A_TASK", 100)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = registry.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert whole and sorted(got) == sorted(whole)


_HOLDS = re.compile(r"(?:\* ?\(?\d*\)? ?|[-+] )(Sort|SortMergeJoin|HashAggregate|ObjectHashAggregate|SortAggregate|Window)\b")


@pytest.mark.parametrize("name, most", [("im32_prepared", 24), ("dt19_blank_outside", 15), ("im36_tiles", 9), ("im26_curve_fit", 15), ("im11_trimmed_margins", 20)])
def test_no_plan_holds_many_steps_at_once(spark, monkeypatch, name, most):
    """Every sort and aggregation of a task keeps its memory until the task ends, so plans of many steps are cut by tables of a row for each picture."""
    from skyfilm.operators import fits, pixels, runs, strips
    from skyfilm.plans import pictures

    plans, whole = [], tables.stored

    def stored(rows, label):
        plans.append(plan(rows))
        return whole(rows, label)

    for module in (fits, pixels, runs, strips, pictures):
        monkeypatch.setattr(module, "stored", stored, raising=False)
    plans.append(plan(registry.QUERIES[name](spark, "/root/testdata/sf0.001")))
    held = [len(_HOLDS.findall(p)) for p in plans]
    assert max(held) <= most, held


def test_pictures_of_a_dark_foreground_are_parted_as_others_are(spark):
    """Only those whose dark side is rarer are filled up; ties are dark, one colour and no pixels have no level."""
    from skyfilm.operators import pixels as PX
    from skyfilm.operators import strips as ST

    pictures = {1: [[9, 9, 0], [9, 9, 9]], 2: [[3, 0, 0], [0, 0, 6]], 3: [[5, 0], [5, 0]], 4: [[7, 7], [7, 7]], 5: [[0, 0], [0, 0]]}
    rows = [(k, y, x, v) for k, p in pictures.items() for y, line in enumerate(p) for x, v in enumerate(line) if v]
    t = spark.createDataFrame(rows, "k long, y int, x int, v int")
    size = spark.createDataFrame([(k, len(p), len(p[0])) for k, p in pictures.items()], "k long, height int, width int")
    mask, levels = ST.in_two_colours(t, size, 0.75, stretch=True)
    assert sorted((r.k, r.y, r.x) for r in mask.collect()) == [(1, 0, 2), (2, 0, 0), (2, 1, 2), (3, 0, 1), (3, 1, 1)]
    by_all = PX.thresholds(PX.level_counts(ST.stretched(t), size)).selectExpr("k", "CAST(floor(otsu * 0.75) AS INT) AS level")
    assert sorted(levels.collect()) == sorted(by_all.collect()) and {r.k for r in levels.where("level IS NULL").collect()} == {4, 5}
