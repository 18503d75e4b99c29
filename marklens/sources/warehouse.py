"""Student records derived from the order tables.

An order is a record: its lines give the three marks, its price the attendance,
its date the study hours, its customer the name and the group. Both joins keep
every order.

Marks and identity are separate steps on purpose. The lines are grouped by the
join key, so Catalyst drops that join when no mark is used. The identity join is
left to the queries that print names, and comes last, after their filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marklens.spec import DEFAULT_SPEC as SPEC
from marklens.spec import INGEST_ORDER

CUSTOMER_KEY = "customer_key"

# The columns in use. A known schema saves the job that looks for one.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_quantity double, l_discount double, l_tax double",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "events": "event_id bigint, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three marks per order.

    The sums are whole numbers, so the result does not depend on the order in
    which partial sums meet. Partial aggregation shrinks an order with many
    lines before the shuffle.
    """

    def mean(column: str, factor: int) -> Column:
        return F.expr(f"cast(sum(floor({column} * {factor} + 0.5D)) AS double) / count(*)")

    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    return lines.agg(
        mean("l_quantity", 2).alias("Math"),
        mean("l_discount", 1000).alias("Science"),
        mean("l_tax", 1250).alias("English"),
    )


def settled(df: DataFrame) -> DataFrame:
    """Orders that are closed; they play the part of records already stored."""
    return df.filter("o_orderstatus = 'F'")


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


# 50 plus a ten-thousandth of the price, rounded half up to two decimals. Counted
# in whole cents, because a price on the edge between two hundredths has no exact
# double and engines round it differently.
_CENTS = "floor(o_totalprice * 100 + 0.5D)"
_ATTENDANCE = f"(5000 + floor(({_CENTS} + 5000) / 10000)) / 100"


def core_records(
    spark: SparkSession, sf_dir: str, orders: DataFrame | None = None
) -> DataFrame:
    """Records without name and group, with the customer key instead."""
    headers = order_headers(spark, sf_dir) if orders is None else orders
    line_marks = marks(spark, sf_dir)
    same_order = headers["o_orderkey"] == line_marks["l_orderkey"]
    return headers.join(line_marks, same_order, "left").selectExpr(
        "o_orderkey AS Student_ID",
        f"{_ATTENDANCE} AS Attendance",
        "cast(1 + dayofmonth(o_orderdate) % 8 AS double) AS Study_Hours",
        "Math",
        "Science",
        "English",
        f"o_custkey AS {CUSTOMER_KEY}",
    )


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and group per customer; the customer key is the table's unique key."""
    people = table(spark, sf_dir, "customer").filter("c_custkey IS NOT NULL")
    return people.selectExpr("c_custkey", "c_name AS Name", "c_mktsegment AS Gender")


def with_identity(core: DataFrame, people: DataFrame) -> DataFrame:
    """Attach name and group to any number of records.

    Both sides reach the join straight from a shuffle, so adaptive execution
    can split the partition of a customer who holds a large part of the orders.
    """
    joined = core.join(people, core[CUSTOMER_KEY] == people["c_custkey"], "left")
    return joined.drop(CUSTOMER_KEY, "c_custkey")


def name_few(few: DataFrame, people: DataFrame) -> DataFrame:
    """Attach name and group to a head of few records (a top-k or one key).

    The limit tells Spark how small the head is, so it is the side that gets
    broadcast, and the customers are scanned without a shuffle. An outer join
    cannot broadcast its kept side; records without a customer come back through
    the union instead. One partition makes the head a single shuffle result that
    both branches reuse; the null-safe comparison keeps a null filter, and with
    it a difference, out of the one branch.
    """
    few = few.repartition(1)
    columns = few.columns
    same_customer = people["c_custkey"].eqNullSafe(few[CUSTOMER_KEY])
    named = people.join(few, same_customer).select(*columns, "Name", "Gender")
    nothing = F.lit(None).cast("string")
    unnamed = few.withColumns({"Name": nothing, "Gender": nothing})
    return (
        named.unionByName(unnamed)
        .groupBy(*columns)
        .agg(F.max("Name").alias("Name"), F.max("Gender").alias("Gender"))
        .drop(CUSTOMER_KEY)
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full record table."""
    full = with_identity(core_records(spark, sf_dir), identities(spark, sf_dir))
    return full.select(*SPEC.columns)


def stored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the settled orders: the table that submissions are added to."""
    closed = settled(order_headers(spark, sf_dir))
    core = core_records(spark, sf_dir, closed)
    return with_identity(core, identities(spark, sf_dir)).select(*SPEC.columns)


def stored_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = settled(order_headers(spark, sf_dir))
    return closed.select(F.col("o_orderkey").alias("Student_ID"))


def line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key per order line: a batch in which most keys repeat."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_orderkey").alias("Student_ID"))


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a record somebody typed in, so all fields are text.

    Errors carry no usable id, views no name, clicks no usable mark; values run
    past the allowed ranges on their own, and users submit many times.
    """
    events = table(spark, sf_dir, "events")
    return events.withColumn("k", F.get_json_object("props", "$.k")).selectExpr(
        "if(event_type = 'error', event_type, concat(' ', user_id, ' ')) AS Student_ID",
        "if(event_type = 'view', '  ', concat(' ', event_type, ' ', user_id)) AS Name",
        "event_type AS Gender",
        "cast(value AS string) AS Attendance",
        "cast(try_cast(k AS double) / 4 AS string) AS Study_Hours",
        "k AS Math",
        "cast(99 - try_cast(k AS int) AS string) AS Science",
        "if(event_type = 'click', props, k) AS English",
        f"event_id AS {INGEST_ORDER}",
    )
