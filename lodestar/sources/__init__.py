"""Scans and sinks: catalog / file tables, word lists, JDBC publish."""

from lodestar.sources.jdbc import (
    bindable, external_columns, external_ddl, external_type, insert_statement, jdbc_options, publish_jdbc,
    recreate_external_table,
)
from lodestar.sources.publish import BatchWriter, DbTarget, publish_batches
from lodestar.sources.tables import (
    create_table_if_not_exists, materialize, on_days, read_partitions, read_table,
    replace_partitions, save_counted, save_table, spread, write_all,
)
from lodestar.sources.wordlists import read_dictionary, read_word_list

__all__ = [
    "external_columns", "external_ddl", "external_type", "insert_statement", "jdbc_options",
    "publish_jdbc", "recreate_external_table",
    "create_table_if_not_exists", "materialize", "read_table", "spread", "save_table",
    "write_all", "read_word_list", "read_dictionary", "bindable", "BatchWriter", "DbTarget",
    "publish_batches", "on_days", "read_partitions", "save_counted", "replace_partitions",
]
