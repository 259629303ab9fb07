"""Column expressions: every function takes and returns ``Column`` and stays inside Spark's own operators."""

from tillworks.functions.dates import (
    as_of_date,
    day_of_month,
    day_of_week,
    days_between,
    month_start,
    week_start_monday,
)
from tillworks.functions.numeric import (
    MONEY,
    NUMBER,
    PERCENT,
    count_ratio_pct,
    difference,
    floored_margin,
    greatest_or_zero,
    line_amount,
    money_avg,
    money_sum,
    ratio_pct,
    safe_divide,
    total_value,
    zero_if_null,
)
from tillworks.functions.parsing import (
    default_if_unparsable,
    parse_bool_flag,
    parse_form_date,
    parse_form_int,
    parse_form_number,
    parse_form_timestamp,
)
from tillworks.functions.text import (
    blank_to_null,
    mask_phone,
    null_to_blank,
    product_key_slug,
    product_family,
    product_variant,
    surrogate_key,
    trim_ws,
    upper_name,
    validate_phone,
)

__all__ = [name for name in dir() if not name.startswith("_")]
