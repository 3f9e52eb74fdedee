from .batches import format_batches, map_batches, predict_batches, tokenize_batches
from .keys import order_hash, with_row_key
from .packing import pack
from .reports import sample_report, summarize
from .sampling import pick_row, row_at, sample_n, shuffle_by_hash, take_n, train_test_split
from .scoring import accuracy, exact_match, flag_share, pair_predictions, percent
from .vocabulary import Blocks, build_vocab, decode, encode, in_blocks, special_id

__all__ = [
    "Blocks",
    "accuracy",
    "build_vocab",
    "decode",
    "encode",
    "exact_match",
    "flag_share",
    "format_batches",
    "in_blocks",
    "map_batches",
    "order_hash",
    "pack",
    "pair_predictions",
    "percent",
    "pick_row",
    "predict_batches",
    "row_at",
    "sample_n",
    "sample_report",
    "shuffle_by_hash",
    "special_id",
    "summarize",
    "take_n",
    "tokenize_batches",
    "train_test_split",
    "with_row_key",
]
