"""Operators of a training-data pipeline; one module each, with its query and, where SQL can
express it, the DuckDB SQL of the same rows."""
