"""Targets and route sinks."""

from .ledger import FanOutTarget, LedgerTarget, MergeTarget
from .targets import (JdbcTarget, PathTarget, TableTarget, bulk_insert, fresh_dir,
                      read_routes, shared_dir, write_routes)
