from feedloom.streaming.arrivals import file_stream, process_new_files
from feedloom.streaming.sensed import process_sensed, read_arrived, read_audit, sensed_stream
from feedloom.streaming.watermarks import keep_watermarks, read_watermarks, watermark_stream

__all__ = [
    "file_stream",
    "keep_watermarks",
    "process_new_files",
    "process_sensed",
    "read_arrived",
    "read_audit",
    "read_watermarks",
    "sensed_stream",
    "watermark_stream",
]
