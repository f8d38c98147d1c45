"""Sources and sinks: transaction readers, test-table adapters, writers."""

from churnscope.sources.transactions import (
    CONTRACT, TRANSACTION_SCHEMA, read_lines, read_rejects, read_table, read_transactions,
    transactions_from_orders, transactions_from_events, edge_transactions,
)
from churnscope.sources.writers import load_model, read_written, save_model, write_table

__all__ = [
    "CONTRACT", "TRANSACTION_SCHEMA", "read_lines", "read_rejects", "read_transactions", "read_table",
    "transactions_from_orders", "transactions_from_events",
    "edge_transactions", "write_table", "read_written", "save_model", "load_model",
]
