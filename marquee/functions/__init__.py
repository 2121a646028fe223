from .columns import (
    ACTING_CATEGORIES,
    decade,
    has_any,
    in_values,
    is_acting,
    list_text,
)

__all__ = [
    "ACTING_CATEGORIES",
    "decade",
    "has_any",
    "in_values",
    "is_acting",
    "list_text",
]
