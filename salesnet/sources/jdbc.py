"""Loading the star tables from a relational database.

Each table is read with ``spark.read.jdbc`` split into ``num_partitions``
parallel range reads on its integer primary key; the key bounds come from one
``MIN/MAX`` row per table.  The result is conformed to the declared schemas.
Not exercised by the tests: no database is available in this environment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesnet import schemas
from salesnet.plans.tables import PRIMARY_KEYS
from salesnet.sources.star import Star


def read_table(spark: SparkSession, url: str, table: str, key: str, properties: dict,
               num_partitions: int = 64) -> DataFrame:
    """Partitioned JDBC read of ``table`` on the numeric column ``key``."""
    bounds = spark.read.jdbc(url, f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) b",
                             properties=properties).first()
    if bounds is None or bounds["lo"] is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column=key, lowerBound=int(bounds["lo"]), upperBound=int(bounds["hi"]) + 1,
                           numPartitions=num_partitions, properties=properties)


def jdbc_star(spark: SparkSession, url: str, properties: dict, num_partitions: int = 64) -> Star:
    """The seven tables of a database holding the star schema under its own table names."""
    tables = {}
    for name, schema in schemas.STAR.items():
        df = read_table(spark, url, name, PRIMARY_KEYS[name], properties, num_partitions)
        tables[name] = schemas.conform(df, schema)
    return Star(**tables)
