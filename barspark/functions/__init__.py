from barspark.functions.columns import (  # noqa: F401
    clip0,
    direction,
    nan_to_null,
    ratio_change,
    safe_div,
)
