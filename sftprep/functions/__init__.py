from .cleanup import (
    clean_generation,
    cap_tokens,
    cut_prompt,
    echo_ok,
    py_strip,
    stop_at,
    strip_markers,
)
from .messages import from_messages, message_content, message_prefix, to_messages
from .templates import (
    CHATML_END,
    CHATML_START,
    TURN_END,
    TURN_START,
    escape_quotes,
    render_chatml,
    render_sections,
    render_turns,
    system_message,
)
from .tokens import (
    TOKEN_PATTERN,
    add_labels,
    append_eos,
    attention_mask,
    join_ids,
    pad,
    pad_ids,
    prepend_bos,
    tokenize,
    truncate,
    truncate_with_eos,
    was_truncated,
)

__all__ = [
    "CHATML_END",
    "CHATML_START",
    "TOKEN_PATTERN",
    "TURN_END",
    "TURN_START",
    "add_labels",
    "append_eos",
    "attention_mask",
    "cap_tokens",
    "clean_generation",
    "cut_prompt",
    "echo_ok",
    "escape_quotes",
    "from_messages",
    "join_ids",
    "message_content",
    "message_prefix",
    "pad",
    "pad_ids",
    "prepend_bos",
    "py_strip",
    "render_chatml",
    "render_sections",
    "render_turns",
    "stop_at",
    "strip_markers",
    "system_message",
    "to_messages",
    "tokenize",
    "truncate",
    "truncate_with_eos",
    "was_truncated",
]
