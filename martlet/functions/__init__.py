from martlet.functions.text import (
    count_text,
    join_items,
    mask_email,
    mask_name,
    money,
    padded_id,
    percent,
    title_text,
)
from martlet.functions.times import month_label, month_name, parse_timestamp

__all__ = [
    "count_text",
    "join_items",
    "mask_email",
    "mask_name",
    "money",
    "month_label",
    "month_name",
    "padded_id",
    "parse_timestamp",
    "percent",
    "title_text",
]
