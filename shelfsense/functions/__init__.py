from shelfsense.functions.columns import (
    clip_lower, clip_upper, clip_between, safe_div, nan_to_null, isin_or_false,
    rule_label, ratio_label, decode_label,
)

__all__ = ["clip_lower", "clip_upper", "clip_between", "safe_div", "nan_to_null",
           "isin_or_false", "rule_label", "ratio_label", "decode_label"]
