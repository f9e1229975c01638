"""Column-expression helpers: name normalisation and value conversion."""

from . import coerce, names  # noqa: F401
