from ledgermill.functions.cleansing import blank_to_null, hash_pii, has_text, positive, required
from ledgermill.functions.frames import empty_frame, literal_frame
from ledgermill.functions.temporal import month_key, ntz, to_seconds

__all__ = [
    "blank_to_null",
    "empty_frame",
    "has_text",
    "hash_pii",
    "literal_frame",
    "month_key",
    "ntz",
    "positive",
    "required",
    "to_seconds",
]
