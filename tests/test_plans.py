"""What the plans read, shuffle and run in."""

import re

import pytest
from pyspark.sql import functions as F

from marklens.plans.catalogue import QUERIES
from marklens.sources import warehouse as wh
from samples import final_plan, record, records

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    """Nothing is small enough to broadcast unless the query says so."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, before)


def scans(plan):
    """Tables read, one entry per scan that runs."""
    return re.findall(r"FileScan parquet .*?/(\w+)\.parquet", plan)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_everything_runs_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow", plan)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    ("name", "tables"),
    [
        ("attendance_summary", ["orders"]),
        ("study_hours_summary", ["orders"]),
        ("attendance_histogram", ["orders"]),
        ("low_attendance", ["customer", "orders"]),
        ("by_study_hours", ["customer", "orders"]),
        ("class_statistics", ["lineitem", "orders"]),
        ("dashboard_kpis", ["lineitem", "orders"]),
        ("grade_distribution_dense", ["lineitem", "orders"]),
        ("subject_box", ["lineitem", "orders"]),
        ("split_sizes", ["lineitem", "orders"]),
        ("top_students", ["customer", "lineitem", "orders"]),
        ("top3_per_subject", ["customer", "lineitem", "orders"]),
        ("scan_base", ["customer", "lineitem", "orders"]),
    ],
)
def test_each_needed_table_is_read_once(shuffled, name, tables):
    assert sorted(scans(final_plan(QUERIES[name](shuffled, SF)))) == tables


def test_only_needed_columns_are_read(spark):
    plan = final_plan(QUERIES["attendance_summary"](spark, SF))
    assert re.search(r"ReadSchema: struct<o_totalprice:double>", plan)
    assert "lineitem" not in plan


def test_lookup_reaches_both_scans(spark):
    df = QUERIES["find_by_id"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderkey,7)" in plan
    assert "EqualTo(l_orderkey,7)" in plan


def test_top_k_keeps_k_rows_per_task(spark):
    assert "TakeOrderedAndProject(limit=5" in final_plan(QUERIES["top_students"](spark, SF))
    assert "TakeOrderedAndProject(limit=5" in final_plan(QUERIES["sql_top_students"](spark, SF))


def test_top_per_subject_keeps_k_rows_per_task(spark):
    plan = final_plan(QUERIES["top3_per_subject"](spark, SF))
    assert plan.count("TakeOrderedAndProject(limit=3") == 3


def test_a_batch_is_read_for_its_facts_and_for_its_rows(shuffled):
    plan = final_plan(QUERIES["validate_rejects"](shuffled, SF))
    # Facts, the keys looked up, and the rows.
    assert sorted(scans(plan)) == ["events", "events", "events", "orders"]
    assert "BroadcastExchange" not in plan


@pytest.mark.parametrize(
    ("name", "limit"), [("top_students", "2k"), ("top3_per_subject", "2k"), ("find_by_id", "64k")]
)
def test_naming_the_best_never_shuffles_the_customers(spark, name, limit):
    """The limit alone makes the winners the broadcast side."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, limit)
    try:
        plan = final_plan(QUERIES[name](spark, SF))
    finally:
        spark.conf.set(threshold, before)
    assert not re.search(r"hashpartitioning\((coalesce\()?c_custkey", plan)
    assert re.search(r"BroadcastHashJoin \[coalesce\(c_custkey", plan)
    assert sorted(scans(plan)) == ["customer", "lineitem", "orders"]


def test_filters_run_before_names_are_joined(shuffled):
    plan = final_plan(QUERIES["at_risk"](shuffled, SF))
    join = re.search(r"SortMergeJoin \[customer_key", plan).start()
    risk = re.search(r"Filter .*< 75\.0", plan).start()
    assert risk > join


def test_hot_customer_is_split(shuffled, tmp_path):
    """One customer holds a third of the orders; adaptive execution splits that partition."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: shuffled.conf.get(k) for k in conf}
    for k, v in conf.items():
        shuffled.conf.set(k, v)
    try:
        ids = shuffled.range(0, 60_000, 1, 16)
        customer = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None)
        core = ids.select(
            F.col("id").alias("Student_ID"),
            F.xxhash64("id").cast("double").alias("Attendance"),
            customer.otherwise(F.col("id")).alias(wh.CUSTOMER_KEY),
        )
        people = shuffled.range(0, 60_000).select(
            F.col("id").alias("c_custkey"),
            F.concat(F.lit("Name "), F.col("id")).alias("Name"),
            F.lit("x").alias("Gender"),
        )
        named = wh.with_identity(core, people)
        plan = final_plan(named)
        assert "skew=true" in plan
        rows = named.agg(
            F.count("*").alias("n"),
            F.count_if(F.col("Name") == "Name 7").alias("hot"),
            F.count_if(F.col("Name").isNull()).alias("unnamed"),
        ).first()
        assert tuple(rows) == (60_000, 20_000, 20_000)
    finally:
        for k, v in before.items():
            shuffled.conf.set(k, v)


def test_unknown_customers_keep_their_records(spark):
    few = records(spark, [record(1), record(2), record(3)]).drop("Name", "Gender")
    keys = F.when(F.col("Student_ID") == 1, 10).when(F.col("Student_ID") == 2, 99)
    few = few.withColumn(wh.CUSTOMER_KEY, keys)
    people = spark.createDataFrame([(10, "Ten", "x")], "c_custkey bigint, Name string, Gender string")
    for named in (wh.name_few(few, people), wh.with_identity(few, people)):
        got = {r.Student_ID: r.Name for r in named.collect()}
        assert got == {1: "Ten", 2: None, 3: None}
