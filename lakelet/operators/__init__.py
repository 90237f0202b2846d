from lakelet.operators.filters import Rule, apply_rules, filter_by_ts
from lakelet.operators.windows import dropoff_features, pickup_features, sliding_window_agg, tumbling_window_agg

__all__ = [
    "Rule",
    "apply_rules",
    "filter_by_ts",
    "dropoff_features",
    "pickup_features",
    "sliding_window_agg",
    "tumbling_window_agg",
]
