"""Deployment settings from environment variables, and the default places of all layers."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from barlake.session import object_store_conf
from barlake.sources.jdbc import Warehouse

# Variable names, defaults and paths of existing deployments. --------------------
LOG_SERVERS = ("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
LOG_TOPIC = ("KAFKA_TOPIC", "stock-prices")
STORE_ENDPOINT = ("MINIO_ENDPOINT", None)
STORE_USER = ("MINIO_ROOT_USER", None)
STORE_PASSWORD = ("MINIO_ROOT_PASSWORD", None)
DB_HOST = ("WAREHOUSE_HOST", "localhost")
DB_PORT = ("WAREHOUSE_PORT", "5432")
DB_NAME = ("WAREHOUSE_DB", "stock_warehouse")
DB_USER = ("WAREHOUSE_USER", "warehouse")
DB_PASSWORD = ("WAREHOUSE_PASSWORD", None)
BRONZE = "s3a://bronze/stock-prices"
QUARANTINE = "s3a://quarantine/stock-prices"
SILVER = "s3a://silver/stock-prices"
GOLD = "s3a://gold"
CHECKPOINTS = "spark-checkpoints"
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    env: Mapping[str, str]

    @classmethod
    def from_env(cls) -> Settings:
        return cls(dict(os.environ))

    def _of(self, variable: tuple[str, str | None]) -> str | None:
        return self.env.get(*variable)

    @property
    def servers(self) -> str:
        return self._of(LOG_SERVERS)

    @property
    def topic(self) -> str:
        return self._of(LOG_TOPIC)

    def spark_conf(self) -> dict[str, str]:
        """Object store access; nothing without an endpoint, so a cluster's own settings hold."""
        endpoint = self._of(STORE_ENDPOINT)
        if endpoint is None:
            return {}
        return object_store_conf(
            endpoint, self._of(STORE_USER), self._of(STORE_PASSWORD), tls=endpoint.startswith("https")
        )

    def warehouse(self) -> Warehouse:
        url = f"jdbc:postgresql://{self._of(DB_HOST)}:{self._of(DB_PORT)}/{self._of(DB_NAME)}"
        return Warehouse(url, self._of(DB_USER), self._of(DB_PASSWORD))
