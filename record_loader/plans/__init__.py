"""End-to-end load plans."""

from .load import BatchRolledBack, LoadResult, load_batch, load_fan_out, load_per_target, plan_load
