"""Warehouse tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlake.sources.lake import observed


@dataclass(frozen=True)
class Warehouse:
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = "org.postgresql.Driver"
    connections: int = 16
    batch_rows: int = 10_000

    def options(self, table: str) -> dict[str, str]:
        """Writer options; ``connections`` caps how many tasks write at the same time."""
        options = {
            "url": self.url,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "numPartitions": self.connections,
            "batchsize": self.batch_rows,
        }
        return {name: str(value) for name, value in options.items() if value is not None}

    def save(self, frame: DataFrame, table: str) -> None:
        frame.write.format("jdbc").options(**self.options(table)).mode("overwrite").save()

    def rows(self, spark: SparkSession, table: str) -> int:
        """Row count taken by the database, not by pulling the table."""
        options = self.options(table)
        del options["dbtable"], options["numPartitions"]
        counted = spark.read.format("jdbc").options(**options)
        return counted.option("query", f"SELECT count(*) AS n FROM {table}").load().first()["n"]


def load_table(frame: DataFrame, table: str, warehouse: Warehouse) -> int:
    """Replace a warehouse table and return its row count.

    A task that is retried after its executor was lost may have committed already, so the table's own
    count is compared with the rows sent; on a difference the load fails and can simply be run again.
    """
    sent = Observation()
    warehouse.save(frame.observe(sent, F.count("*").alias("rows")), table)
    rows = observed(sent, lambda: {"rows": 0})["rows"]
    stored = warehouse.rows(frame.sparkSession, table)
    if stored != rows:
        raise RuntimeError(f"{table}: sent {rows} rows, warehouse holds {stored}")
    return stored
