"""Case-shaped frames from the star-schema and event tables.

They give the operators inputs that grow with the data: one snapshot row per customer, a
keyed history from orders, a batch of changes to it from line items, and a daily series from
events. Line items are counted per order before any join, so one hot order or customer
reaches a join only as partial counts.

The largest counts and joins are dealt to a number of tasks that grows with the tables' rows,
so that a task's memory does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epitally.functions.expressions import epoch_millis, null_where, per_million
from epitally.schema import CASES
from epitally.workspace import tasks_for

DAY_MILLIS = 86_400_000

# Parts of a key's rows when they are counted in dealt tasks.
KEY_PARTS = 16

# The counts of the history and of the changes to it.
COUNTS = ("cases", "deaths", "recovered", "active", "critical", "tests")

# The columns of the tables read here. Declared, so that naming a table reads
# no file footers.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
        "c_mktsegment STRING"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
        "value DOUBLE, props STRING"
    ),
}


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{base}/{name}.parquet")


def shipment_tasks(spark: SparkSession, base: str) -> int:
    """Tasks for the rows of orders and line items; Parquet has their number in its footers."""
    return tasks_for(sum(table(spark, base, t).count() for t in ("orders", "lineitem")))


def _line_tasks(spark: SparkSession, base: str) -> int:
    """Tasks for the rows of line items alone."""
    return tasks_for(table(spark, base, "lineitem").count())


def _in_parts(rows: DataFrame, keys: Sequence[str], tasks: int, *counts: Column) -> DataFrame:
    """Counts by key and part of it: no more than ``KEY_PARTS`` rows of a key.

    The rows are dealt before they are counted. Counted where they are read, a task would hold
    all keys of its split, and after the session's shuffle all keys of one of its partitions,
    however many. A key with very many rows is dealt to several tasks.
    """
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(KEY_PARTS))
    dealt = rows.withColumn("_part", part).repartition(tasks, *keys, "_part")
    return dealt.groupBy(*keys, "_part").agg(*counts).drop("_part")


def _summed(counted: DataFrame, *keys: str) -> DataFrame:
    return counted.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS])


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _contract(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CASES])


def snapshot(spark: SparkSession, base: str) -> DataFrame:
    """One contract row per customer; a fifth of the rows lack ``active``."""
    orders = table(spark, base, "orders")
    lines = (
        table(spark, base, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("cases"),
            _count_if(F.col("l_returnflag") == "R").alias("deaths"),
            _count_if(F.col("l_returnflag") == "A").alias("recovered"),
            _count_if(F.col("l_returnflag") == "N").alias("active"),
        )
    )
    per_customer = (
        orders.select(
            "o_orderkey",
            "o_custkey",
            epoch_millis(orders, "o_orderdate").alias("placed"),
            (F.col("o_orderstatus") == "P").alias("pending"),
        )
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("o_custkey")
        .agg(
            F.max("placed").alias("updated"),
            F.count(F.lit(1)).alias("tests"),
            _count_if(F.col("pending")).alias("critical"),
            *[F.sum(c).alias(c) for c in ("cases", "deaths", "recovered", "active")],
        )
    )
    located = (
        table(spark, base, "customer")
        .join(table(spark, base, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, base, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "c_custkey",
            F.col("c_name").alias("country"),
            F.col("n_name").alias("iso2"),
            F.concat("n_name", F.lit("_3")).alias("iso3"),
            F.col("r_name").alias("continent"),
            (F.col("c_custkey") + 1000).alias("population"),
        )
    )
    rows = located.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
    return _contract(
        rows.withColumn("active", null_where("active", F.col("population") % 5 == 0))
        .withColumn("casesPerOneMillion", per_million("cases", "population"))
        .withColumn("deathsPerOneMillion", per_million("deaths", "population"))
    )


def _day_number(df: DataFrame, name: str) -> Column:
    return F.floor(epoch_millis(df, name) / DAY_MILLIS)


def _month_millis(df: DataFrame, name: str) -> Column:
    day = F.date_from_unix_date(_day_number(df, name).cast("int"))
    return F.unix_date(F.trunc(day, "month")).cast("long") * DAY_MILLIS


def _keyed(df: DataFrame, origin: str) -> DataFrame:
    return (
        df.withColumn("country", F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
        .withColumn("continent", F.lit(origin))
        .withColumn("population", F.col("o_custkey") + 1000)
        .withColumn("casesPerOneMillion", per_million("cases", "population"))
        .withColumn("deathsPerOneMillion", per_million("deaths", "population"))
    )


def order_history(spark: SparkSession, base: str) -> DataFrame:
    """Keyed history: one row per customer and month of ordering."""
    orders = table(spark, base, "orders")
    keys, tasks = ("o_custkey", "updated"), tasks_for(orders.count())
    in_parts = _in_parts(
        orders.select(
            "o_custkey",
            _month_millis(orders, "o_orderdate").alias("updated"),
            "o_orderstatus",
            "o_orderpriority",
            "o_totalprice",
        ),
        keys,
        tasks,
        F.count(F.lit(1)).alias("cases"),
        _count_if(F.col("o_orderstatus") == "F").alias("deaths"),
        _count_if(F.col("o_orderstatus") == "O").alias("recovered"),
        _count_if(F.col("o_orderstatus") == "P").alias("active"),
        _count_if(F.col("o_orderpriority") == "1-URGENT").alias("critical"),
        F.count("o_totalprice").alias("tests"),
    )
    counted = _summed(in_parts.repartition(tasks, *keys), *keys)
    # Codes from counts rather than min() of the texts: only fixed-width aggregates hash.
    coded = counted.withColumn(
        "iso2",
        F.when(F.col("deaths") > 0, "F").when(F.col("recovered") > 0, "O").otherwise("P"),
    ).withColumn("iso3", F.when(F.col("critical") > 0, "URGENT").otherwise("NORMAL"))
    return _contract(_keyed(coded, "ORDERED"))


def _shipments(spark: SparkSession, base: str) -> DataFrame:
    """Counts per order and month of shipping, with the order's customer."""
    lines = table(spark, base, "lineitem")
    in_parts = _in_parts(
        lines.select(
            "l_orderkey",
            _month_millis(lines, "l_shipdate").alias("updated"),
            "l_returnflag",
            "l_linestatus",
            "l_linenumber",
        ),
        ("l_orderkey", "updated"),
        _line_tasks(spark, base),
        F.count(F.lit(1)).alias("cases"),
        _count_if(F.col("l_returnflag") == "R").alias("deaths"),
        _count_if(F.col("l_returnflag") == "A").alias("recovered"),
        _count_if(F.col("l_returnflag") == "N").alias("active"),
        _count_if(F.col("l_linestatus") == "F").alias("critical"),
        F.count("l_linenumber").alias("tests"),
    )
    owners = table(spark, base, "orders").select("o_orderkey", "o_custkey")
    # Dealt after the count: an order has a row for each part of its months, however many lines.
    tasks = shipment_tasks(spark, base)
    per_order = _summed(in_parts.repartition(tasks, "l_orderkey"), "l_orderkey", "updated")
    return per_order.join(
        owners.repartition(tasks, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )


def _ship_codes(df: DataFrame) -> DataFrame:
    return df.withColumn("iso2", F.when(F.col("critical") > 0, "F").otherwise("O")).withColumn(
        "iso3",
        F.when(F.col("deaths") > 0, "R").when(F.col("active") > 0, "N").otherwise("A"),
    )


def shipment_batch(spark: SparkSession, base: str) -> DataFrame:
    """Changes to the order history: one row per customer and month of shipping.

    ``active`` is null on every seventh day number, so merges meet staged nulls.
    """
    keys = ("o_custkey", "updated")
    # Dealt before the sums too. A customer's month has a row for each order, not for each line.
    per_order = _shipments(spark, base).select(*keys, *COUNTS)
    merged = _summed(per_order.repartition(_line_tasks(spark, base), *keys), *keys)
    staged_null = F.floor(F.col("updated") / DAY_MILLIS) % 7 == 0
    with_nulls = _ship_codes(merged).withColumn("active", null_where("active", staged_null))
    return _contract(_keyed(with_nulls, "SHIPPED"))


def shipment_feed(spark: SparkSession, base: str) -> DataFrame:
    """The same changes unmerged: a key repeats, once per order; ``sequence`` orders them."""
    feed = _keyed(_ship_codes(_shipments(spark, base)), "SHIPPED")
    contract = [F.col(f.name).cast(f.dataType).alias(f.name) for f in CASES]
    return feed.select(*contract, F.col("o_orderkey").alias("sequence"))


def event_history(spark: SparkSession, base: str) -> DataFrame:
    """Daily series: one row per user and day."""
    events = table(spark, base, "events")
    return (
        events.withColumn("updated", _day_number(events, "ts") * DAY_MILLIS)
        .groupBy("user_id", "updated")
        .agg(
            F.count(F.lit(1)).alias("cases"),
            _count_if(F.col("event_type") == "error").alias("deaths"),
            _count_if(F.col("event_type") == "purchase").alias("recovered"),
        )
        .select(
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("country"),
            "updated",
            "cases",
            "deaths",
            "recovered",
        )
    )

