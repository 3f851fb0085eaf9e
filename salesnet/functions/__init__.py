from salesnet.functions.scalar import (
    DEC,
    dec_round,
    money,
    to_cents,
    from_cents,
    safe_div,
    safe_pct,
    ratio_round,
    pct,
    month_start,
    month_diff,
    month_label,
    lakh_label,
    signed_pct_label,
    growth_class,
)

__all__ = [
    "DEC", "dec_round", "money", "to_cents", "from_cents", "safe_div", "safe_pct", "ratio_round", "pct", "month_start", "month_diff",
    "month_label", "lakh_label", "signed_pct_label", "growth_class",
]
