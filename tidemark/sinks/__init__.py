"""Sinks: idempotent partitioned Parquet, Kafka payloads, JDBC adapter."""
