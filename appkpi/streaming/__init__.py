"""Incremental variants of landing and of the latest-version tables, run to completion."""

from appkpi.streaming.landing import checkpoint_folder, stream_csv_to_raw
from appkpi.streaming.latest import stream_latest

__all__ = ["checkpoint_folder", "stream_csv_to_raw", "stream_latest"]
