"""Source databases over JDBC, and federated catalogs.

Both need the database's driver jar on the class path.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..functions import utc_now
from ..operators.rows import rename

# The customers' table, the columns to extract, and the types to pin.
CRM_TABLE = "crm.dbo.customers"
CRM_COLUMNS = ["customer_id", "customer_name", "email", "phone", "city", "status",
               "registration_date", "created_at"]
CRM_TYPES = ("customer_name STRING, email STRING, phone STRING, city STRING, status STRING, "
             "registration_date DATE")


def read_source_table(spark: SparkSession, url: str, table: str, user: str | None = None,
                      password: str | None = None, types: str | None = None,
                      split_by: tuple[str, str, str, int] | None = None,
                      fetch_size: int = 10_000, **options: str) -> DataFrame:
    """A database table or subquery. Filters and column choices run in the database.

    ``split_by`` is (column, lowest, highest, parts) and reads the parts in parallel.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url).option("dbtable", table)
        .option("fetchsize", fetch_size).option("pushDownPredicate", True)
        .option("preferTimestampNTZ", True)
        .options(**options)
    )
    if user is not None:
        reader = reader.option("user", user).option("password", password or "")
    if types:
        reader = reader.option("customSchema", types)
    if split_by:
        column, low, high, parts = split_by
        reader = (
            reader.option("partitionColumn", column).option("lowerBound", low)
            .option("upperBound", high).option("numPartitions", parts)
        )
    return reader.load()


def read_crm_source(spark: SparkSession, url: str, table: str = CRM_TABLE, mark: dt.datetime | None = None,
                    now: dt.datetime | None = None, parts: int = 16, **options) -> DataFrame:
    """The customers' table of the source database, under its own column names.

    It is read in ``parts`` by creation time between the last extract's ``mark`` and ``now``; rows
    outside fall into the first and last part. ``split_by`` in ``options`` chooses another split.
    """
    now = now or utc_now()
    mark = mark or now - dt.timedelta(days=30)
    options.setdefault("split_by", ("created_at", mark.isoformat(" "), now.isoformat(" "), parts))
    return read_source_table(spark, url, table, types=CRM_TYPES, **options)


def crm_extract_columns(customers: DataFrame) -> DataFrame:
    """The source's customer columns under the names used from here on."""
    return rename(customers, {"id": "customer_id"}).select(*CRM_COLUMNS)


def attach_jdbc_catalog(spark: SparkSession, name: str, url: str, user: str, password: str,
                        driver: str = "org.postgresql.Driver") -> None:
    """Make a database's tables readable as ``name.schema.table``."""
    prefix = f"spark.sql.catalog.{name}"
    settings = {
        prefix: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
        f"{prefix}.url": url,
        f"{prefix}.user": user,
        f"{prefix}.password": password,
        f"{prefix}.driver": driver,
    }
    for key, value in settings.items():
        spark.conf.set(key, value)


def hive_settings(metastore_uri: str) -> dict[str, str]:
    """Settings to build a session with that share a Hive metastore's tables."""
    return {
        "spark.sql.catalogImplementation": "hive",
        "spark.hadoop.hive.metastore.uris": metastore_uri,
    }


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def rename_table(spark: SparkSession, table: str, new_name: str) -> None:
    spark.sql(f"ALTER TABLE {table} RENAME TO {new_name}")
