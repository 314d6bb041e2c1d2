from prefspark.sources.jsonl import (
    FILE_ORDER,
    nonblank_lines,
    parse_lines,
    read_jsonl,
    read_lines,
    read_ordered,
    write_jsonl,
    write_lines,
)
from prefspark.sources.registry import Dataset, load_registry, register_datasets
from prefspark.sources.staging import scratch_dir, stage_table, stages

__all__ = [
    "FILE_ORDER",
    "Dataset",
    "load_registry",
    "nonblank_lines",
    "parse_lines",
    "read_jsonl",
    "read_lines",
    "read_ordered",
    "register_datasets",
    "scratch_dir",
    "stage_table",
    "stages",
    "write_jsonl",
    "write_lines",
]
