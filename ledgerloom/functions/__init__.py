from ledgerloom.functions.columns import (
    blank_as_null,
    capped_text,
    code_label,
    day_text,
    exact_ratio,
    joined_text,
    last_or_open,
    margin_percent,
    money,
    nan_as_null,
    negate_unless,
    open_balance,
    parsed_day,
    ratio,
    tax_id_mask,
    to_integer,
    to_number,
    to_other_currency,
    with_sign_of,
)

__all__ = [
    "blank_as_null",
    "capped_text",
    "code_label",
    "day_text",
    "exact_ratio",
    "joined_text",
    "last_or_open",
    "margin_percent",
    "money",
    "nan_as_null",
    "negate_unless",
    "open_balance",
    "parsed_day",
    "ratio",
    "tax_id_mask",
    "to_integer",
    "to_number",
    "to_other_currency",
    "with_sign_of",
]
