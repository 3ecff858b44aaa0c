from .jobs import (
    decode,
    publish_files,
    publish_kafka,
    run_for,
    score_stream,
    start_keyed_sink,
    start_tail,
    with_route,
)
from .reports import read_report, row_changes, start_report

__all__ = [
    "decode",
    "publish_files",
    "publish_kafka",
    "read_report",
    "row_changes",
    "run_for",
    "score_stream",
    "start_keyed_sink",
    "start_report",
    "start_tail",
    "with_route",
]
