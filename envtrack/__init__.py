"""envtrack: a PySpark engine for batch sensor telemetry.

Raw text readings are classified, parsed into typed nested readings with quality flags, given a
deterministic id and merged into a day-partitioned Parquet table by a resumable Structured
Streaming load. Reports and queries over that table are plain DataFrame expressions.
"""

__version__ = "0.1.0"
