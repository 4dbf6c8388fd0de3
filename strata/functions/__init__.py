"""Column expressions (JVM-side, whole-stage-codegen friendly)."""

from .text import TOXIC_WORDS, flag_word_hits, is_flagged, null_chat_default
from .timeparts import (epoch_ms_to_ts, epoch_ms_to_ts_seconds, time_parts, weekday)
from .keys import md5_key, full_name, percent2

__all__ = [
    "TOXIC_WORDS", "flag_word_hits", "is_flagged", "null_chat_default",
    "epoch_ms_to_ts", "epoch_ms_to_ts_seconds",
    "time_parts", "weekday", "md5_key", "full_name", "percent2",
]
