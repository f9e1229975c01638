"""record_loader: load batches of record files into tables, Spark-first.

Read record files (batch or file stream) -> match fields to the target's
columns by normalised name -> convert values to the columns' types ->
quarantine units that fail -> reject batches that break the target's
constraints -> one atomic bulk insert per batch -> success / retry /
failure routes and receipts.
"""

from .spec import ColumnSpec, ConfigError, LoadOptions, TargetSpec
from .session import get_session

__all__ = ["ColumnSpec", "ConfigError", "LoadOptions", "TargetSpec", "get_session"]
