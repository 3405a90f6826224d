"""Facts stored by key, so that joins and aggregations by that key need no shuffle.

For a dimension that is too large to broadcast: both sides are bucketed tables with the same number of buckets. A bucket is
read by one task, so the rows of a hot key must not share one: a key with more rows than a mean bucket (there are fewer
such keys than buckets) is kept in a second, plain table and joined with the few dimension rows of those keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, buckets: int) -> list:
    """Keys with more rows than a mean bucket; fewer than `buckets` values."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [row[key] for row in counts.filter(F.col("n") * buckets > total).select(key).dropna().collect()]


def _write(df: DataFrame, name: str, path: str | None):
    writer = df.write.format("parquet").mode("overwrite")
    return writer.option("path", f"{path}/{name}") if path else writer


@dataclass(frozen=True)
class Keyed:
    """A stored table: rows by bucket, and the rows of the hot keys apart."""

    key: str
    even: DataFrame
    hot: DataFrame
    hot_values: Sequence

    @staticmethod
    def store(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None, hot: Sequence | None = None) -> Keyed:
        """Write `name` (bucketed and sorted by the key) and `name_hot`. Give `hot=[]` for a table of nearly unique keys."""
        spark = df.sparkSession
        values = hot_keys(df, key, buckets) if hot is None else list(hot)
        is_hot = F.coalesce(F.col(key).isin(values), F.lit(False)) if values else F.lit(False)
        even = df.filter(~is_hot).repartition(buckets, key)
        _write(even, name, path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
        _write(df.filter(is_hot), f"{name}_hot", path).saveAsTable(f"{name}_hot")
        return Keyed.open(spark, name, key)

    @staticmethod
    def open(spark: SparkSession, name: str, key: str) -> Keyed:
        hot = spark.table(f"{name}_hot")
        return Keyed(key, spark.table(name), hot, [row[key] for row in hot.select(key).distinct().collect()])

    def rows(self) -> DataFrame:
        return self.even.unionByName(self.hot)

    def join(self, dimension: Keyed) -> Keyed:
        """Inner join by the key. The dimension's rows of the hot keys are few and go to every task."""
        few = F.broadcast(dimension.rows().filter(F.col(self.key).isin(list(self.hot_values)))) if self.hot_values else dimension.even.limit(0)
        return Keyed(self.key, self.even.join(dimension.even, self.key), self.hot.join(few, self.key), self.hot_values)

    def map(self, change) -> Keyed:
        """Apply a function of rows, such as a filter or new columns, to both parts."""
        return Keyed(self.key, change(self.even), change(self.hot), self.hot_values)

    def aggregate(self, *columns: Column) -> DataFrame:
        """One row per key: in place for the buckets, merged before a small shuffle for the hot keys."""
        return self.even.groupBy(self.key).agg(*columns).unionByName(self.hot.groupBy(self.key).agg(*columns))
