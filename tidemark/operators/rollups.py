"""User/device rollups from one reused aggregate (no fan-out join back to raw events)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def events_aggregated(events: DataFrame) -> DataFrame:
    """(user_id, device_id, event_counts, host_array) — host set per pair is bounded by hosts."""
    return events.groupBy("user_id", "device_id").agg(
        F.count(F.lit(1)).alias("event_counts"), F.sort_array(F.collect_set("host")).alias("host_array")
    )


def user_device_rollup(agg: DataFrame) -> DataFrame:
    """Per user: device count and hit totals, from the aggregate only (D14). No device list:
    a user's devices are not bounded (one client can rotate through any number of ids); the
    (user, device) rows of ``events_aggregated`` are the list."""
    return agg.groupBy("user_id").agg(
        F.sum("event_counts").alias("total_hits"),
        F.max("event_counts").alias("max_device_hits"),
        F.count(F.lit(1)).alias("n_devices"),
        F.min("device_id").alias("first_device_id"),
    )


def device_user_rollup(agg: DataFrame, devices: DataFrame) -> DataFrame:
    """Per device: user count and hits. No user list: a device's users are unbounded."""
    per_device = agg.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("event_counts").alias("total_hits")
    )
    return per_device.join(devices.select("device_id", "device_type"), "device_id")


class Rollups:
    """Both rollups from one persisted aggregate; use as a context manager so it is unpersisted."""

    def __init__(self, events: DataFrame, devices: DataFrame):
        self.agg = events_aggregated(events).persist(StorageLevel.MEMORY_AND_DISK)
        self.devices = devices

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        self.agg.unpersist()

    def users(self) -> DataFrame:
        return user_device_rollup(self.agg)

    def devices_(self) -> DataFrame:
        return device_user_rollup(self.agg, self.devices)

    def write(self, users_path: str, devices_path: str) -> None:
        """Stores both reports; the events are read and aggregated for the first one only."""
        self.users().write.parquet(users_path)
        self.devices_().write.parquet(devices_path)
