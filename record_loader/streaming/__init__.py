"""File-stream intake and micro-batch loads."""

from .load import (batch_loader, load_directory, load_queue, read_receipts, read_record_stream, redrive,
                   stream_load, unit_states, write_receipts)
