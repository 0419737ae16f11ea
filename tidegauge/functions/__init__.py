from tidegauge.functions.hashing import bit_offset, shard_of
from tidegauge.functions.text import non_word_tokens, space_tokens, words
from tidegauge.functions.times import day_end_ms, epoch_ms, floor_to, millis, window_ms

__all__ = [
    "bit_offset", "shard_of", "non_word_tokens", "space_tokens", "words",
    "day_end_ms", "epoch_ms", "floor_to", "millis", "window_ms",
]
