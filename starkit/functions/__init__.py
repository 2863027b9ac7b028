from starkit.functions.keys import (
    UNKNOWN_KEY,
    UNKNOWN_TEXT,
    date_key,
    exact,
    hash_key,
    is_fractional,
    normalise,
    semester,
)

__all__ = [
    "UNKNOWN_KEY",
    "UNKNOWN_TEXT",
    "date_key",
    "exact",
    "hash_key",
    "is_fractional",
    "normalise",
    "semester",
]
