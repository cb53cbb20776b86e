"""Relational sources (S4): a table read with projection and predicate.

Parquet/ORC tables get column pruning and filter pushdown from Catalyst.
JDBC sources are read in parallel ranges of a numeric column when one is
given, otherwise through explicit predicates (one task each); the WHERE
clause is pushed to the database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, fmt: str, location: str, columns: list[str] | None = None,
               predicate: str | None = None, jdbc: dict | None = None,
               partition_column: str | None = None, bounds: tuple[int, int] | None = None,
               num_partitions: int = 64, predicates: list[str] | None = None) -> DataFrame:
    if fmt == "jdbc":
        opts = dict(jdbc or {})
        if predicates:
            df = spark.read.jdbc(opts.pop("url"), location, predicates=predicates, properties=opts)
        elif partition_column and bounds:
            df = spark.read.jdbc(opts.pop("url"), location, column=partition_column,
                                 lowerBound=bounds[0], upperBound=bounds[1],
                                 numPartitions=num_partitions, properties=opts)
        else:
            df = spark.read.format("jdbc").options(dbtable=location, **opts).load()
    else:
        df = spark.read.format(fmt).load(location)
    if predicate:
        df = df.filter(predicate)
    if columns:
        df = df.select(*columns)
    return df
