from .flows import (
    create_dataset,
    encoded_texts,
    evaluate,
    prompt_text,
    scored_predictions,
    training_blocks,
    training_rows,
    training_text,
)

__all__ = [
    "create_dataset",
    "encoded_texts",
    "evaluate",
    "prompt_text",
    "scored_predictions",
    "training_blocks",
    "training_rows",
    "training_text",
]
