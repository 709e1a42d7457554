"""Typed bulk loading and migration checks on Spark DataFrames."""

from .load import LoadOptions, format_report, load_database, load_report, load_table, publish_table, read_loaded
from .model import CastRule, ColumnSpec, ForeignKeySpec, KeySpec, PartitionSpec, TableSpec
from .operators.agreement import compare_by_buckets, differing_keys
from .operators.casting import cast_table, resolve_casts, target_schema
from .operators.collect import collect_ordered, expand_ordered
from .operators.compare import compare_tables, row_difference, table_counts
from .operators.integrity import (
    check_key,
    check_table,
    child_parent_join,
    enum_violations,
    fk_orphan_rows,
    fk_orphans,
    key_violation_rows,
    key_violations,
    null_violations,
    sequence_state,
)
from .operators.labels import label_bounds, label_ranks, unknown_labels, with_rank
from .operators.partitioning import route_partition
from .operators.rejects import load_with_rejects
from .operators.routing import bounds_from_text, default_from_text, route_by_bounds, route_by_values, values_from_text
from .operators.rule_table import resolve_casts_table, rules_table
from .operators.sharding import pk_ranges, shard_by_pk
from .publishing import current_version, publish_version, published_versions, read_published, remove_old_versions, restore_version
from .sinks import encode_copy_text, write_copy_text, write_partitioned, write_table
from .sources.copytext import read_copy_text
from .sources.delimited import profile_delimited, read_delimited
from .sources.footers import counts_from_files, key_bounds_from_files
from .sources.jdbc import list_jdbc_tables, read_jdbc_table
from .sources.sqlite import list_sqlite_tables, read_sqlite_table
from .sources.tables import list_tables, materialize_views, select_tables

__all__ = [name for name in dir() if not name.startswith("_")]
