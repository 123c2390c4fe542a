"""Deterministic reading identity.

A reading's id is the SHA-256 of canonical JSON text of ``{device, measurements, timestamp_unix}``
with keys in sorted order and nulls written out. Quality flags, source and ingest time are not part
of it, so re-loading the same row gives the same id. The raw (unscaled) epoch number is used, so the
same instant given in seconds and in milliseconds yields two ids.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reading_id(device: Column, measurements: Column, timestamp_unix: Column) -> Column:
    # struct field order = sorted key order; measurements is itself built in sorted field order
    payload = F.struct(device.alias("device"), measurements.alias("measurements"),
                       timestamp_unix.alias("timestamp_unix"))
    return F.sha2(F.to_json(payload, {"ignoreNullFields": "false"}), 256)
