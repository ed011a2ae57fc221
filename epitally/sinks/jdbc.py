"""Relational tables: scan, append, and a staged upsert."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from epitally.operators.upsert import MYSQL, POSTGRES, MergeRule
from epitally.schema import VARCHAR_LENGTHS


@dataclass(frozen=True)
class JdbcTarget:
    """Connection and table; ``extra`` takes any other option of Spark's JDBC source."""

    url: str
    driver: str
    table: str = "epidemic_cases"
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    batch_size: int = 10_000
    connections: int = 16
    extra: dict[str, str] = field(default_factory=dict)

    @property
    def staging_table(self) -> str:
        return f"{self.table}_staging"

    def options(self, table: str | None = None) -> dict[str, str]:
        found = {"url": self.url, "driver": self.driver, "dbtable": table or self.table}
        if self.user is not None:
            found["user"] = self.user
        if self.password is not None:
            found["password"] = self.password
        return {**found, **self.extra}

    def write_options(self, df: DataFrame, table: str | None = None) -> dict[str, str]:
        types = ", ".join(
            f"{c} VARCHAR({n})" for c, n in VARCHAR_LENGTHS.items() if c in df.columns
        )
        found = {
            **self.options(table),
            "batchsize": str(self.batch_size),
        }
        return {**found, "createTableColumnTypes": types} if types else found


def read_options(
    target: JdbcTarget,
    table: str | None = None,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a scan; with a column and its bounds it is split into range queries.

    The bounds only place the cuts: rows outside them are read by the first or last task.
    """
    found = target.options(table)
    if column is None:
        return found
    if bounds is None or partitions is None:
        raise ValueError("a partitioned scan needs column, bounds and partitions")
    return {
        **found,
        "partitionColumn": column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def read_table(spark: SparkSession, target: JdbcTarget, table: str | None = None, **split):
    """Scan of a relational table; ``split`` as in :func:`read_options`."""
    return spark.read.format("jdbc").options(**read_options(target, table, **split)).load()


def _dealt(df: DataFrame, target: JdbcTarget) -> DataFrame:
    """Rows in as many partitions as may write at once.

    A shuffle: Spark's own limit on the number of partitions would coalesce and so run all
    that comes before the write, back to the last shuffle, in as few tasks.
    """
    return df.repartition(target.connections)


def append(df: DataFrame, target: JdbcTarget) -> None:
    """Insert the rows; an existing primary key makes the database refuse its batch.

    Each task commits its own rows, so a failed append may be partial. For batches that can
    repeat keys use :func:`upsert`.
    """
    _dealt(df, target).write.format("jdbc").options(**target.write_options(df)).mode("append").save()


def fill_staging(df: DataFrame, target: JdbcTarget) -> None:
    """Replace the rows of the staging table, keeping its definition."""
    options = target.write_options(df, target.staging_table)
    writer = _dealt(df, target).write.format("jdbc").options(**options).option("truncate", "true")
    writer.mode("overwrite").save()


def dialect(driver: str) -> str:
    return "postgresql" if "postgresql" in driver else "mysql"


def default_rule(target: JdbcTarget) -> MergeRule:
    return POSTGRES if dialect(target.driver) == "postgresql" else MYSQL


def merge_statement(target: JdbcTarget, rule: MergeRule | None = None) -> str:
    """The upsert from staging into the target, in the database's own SQL."""
    rule = rule or default_rule(target)
    columns = ", ".join(rule.insert)
    copied = (
        f"INSERT INTO {target.table} ({columns}) "
        f"SELECT {columns} FROM {target.staging_table}"
    )
    if dialect(target.driver) == "postgresql":
        updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in rule.update)
        return f"{copied} ON CONFLICT ({', '.join(rule.keys)}) DO UPDATE SET {updates}"
    updates = ", ".join(f"{c} = VALUES({c})" for c in rule.update)
    return f"{copied} ON DUPLICATE KEY UPDATE {updates}"


def open_connection(spark: SparkSession, target: JdbcTarget) -> Any:
    """A JDBC connection of the driver process.

    The database's jar must be on the driver's class path (``spark.driver.extraClassPath``),
    where ``DriverManager`` looks for it.
    """
    jvm = spark.sparkContext._jvm
    jvm.java.lang.Class.forName(target.driver)
    return jvm.java.sql.DriverManager.getConnection(
        target.url, target.user or "", target.password or ""
    )


def run_merge(connect: Callable[[], Any], statement: str) -> None:
    """Run one statement in one transaction: all of it is committed, or nothing."""
    connection = connect()
    try:
        connection.setAutoCommit(False)
        work = connection.createStatement()
        try:
            work.execute(statement)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            work.close()
    finally:
        connection.close()


def upsert(
    df: DataFrame,
    target: JdbcTarget,
    rule: MergeRule | None = None,
    connect: Callable[[], Any] | None = None,
) -> None:
    """Load the staging table from Spark tasks, then merge it inside the database."""
    rule = rule or default_rule(target)
    fill_staging(df.select(*rule.insert), target)
    opener = connect or (lambda: open_connection(df.sparkSession, target))
    run_merge(opener, merge_statement(target, rule))
