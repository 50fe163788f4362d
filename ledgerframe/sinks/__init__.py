"""Sinks: partitioned Parquet tables for raw data, marts and report sections."""

from .writers import (exists, publish, read_table, recover, replace, stage_table, write_report, write_table,
                      write_tables)

__all__ = ["exists", "publish", "read_table", "recover", "replace", "stage_table", "write_report",
           "write_table", "write_tables"]
