from tallykeep.functions.text import (
    as_money, clock_text, file_label, first_comma_split, is_blank, row_text,
    shift_minutes, slice_long, whole_amount,
)

__all__ = [
    "as_money", "clock_text", "file_label", "first_comma_split", "is_blank",
    "row_text", "shift_minutes", "slice_long", "whole_amount",
]
