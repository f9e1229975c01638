"""Record sources."""

from .files import (list_units, parse_open_records, parse_records, read_open_records,
                    read_records, wrap_single)
from .queue import unit_stream
