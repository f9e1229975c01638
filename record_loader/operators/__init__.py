"""Record operators: conformance, routing, batching, merge, receipts."""

from .batches import (batches_executed, coalesce_units, load_receipts, plan_batches,
                      replacing_merge, rows_inserted, take_batch)
from .conform import (conform, conform_open, normalize_fields, normalize_open,
                      to_open_records)
from .records import match_report, select_records
from .routing import (constraint_violations, enforce_constraints, error_annotation,
                      is_transient, missing_target, quarantine_units, resolve_target,
                      route_batches, route_units, unit_failures)
