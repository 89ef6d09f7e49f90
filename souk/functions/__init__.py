"""Column expressions shared by every layer (all built-in, JVM-side, codegen-friendly)."""

from souk.functions.dates import (  # noqa: F401
    days_between,
    hours_between,
    is_weekend,
    month_index_between,
    month_key,
    month_start,
    weekday_name,
    whole_days_floor,
    whole_days_trunc,
)
from souk.functions.numeric import (  # noqa: F401
    avg4,
    half_even_long,
    money,
    ratio,
    round4,
    round_to,
    to_double,
)
