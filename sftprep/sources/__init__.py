from .scratch import scratch_dir, settle
from .tables import (
    CONVERSATION_SCHEMA,
    EXAMPLE_SCHEMA,
    SPLIT,
    TRIPLE_SCHEMA,
    read_jsonl,
    read_table,
    select_split,
    spread,
    write_jsonl,
)

__all__ = [
    "CONVERSATION_SCHEMA",
    "EXAMPLE_SCHEMA",
    "SPLIT",
    "TRIPLE_SCHEMA",
    "read_jsonl",
    "read_table",
    "scratch_dir",
    "select_split",
    "settle",
    "spread",
    "write_jsonl",
]
