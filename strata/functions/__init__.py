"""Column expressions (Column -> Column); all built-in Spark functions."""

from strata.functions.channels import (  # noqa: F401
    CHANNEL_TYPES,
    acquisition_type,
    channel_label,
    label_of,
    referer_host,
)
from strata.functions.periods import period_key, period_label, period_text  # noqa: F401
from strata.functions.ratios import (  # noqa: F401
    abs_change,
    growth_pct,
    double_part,
    exact_part,
    money_sum,
    pct,
    ratio,
    total,
)
from strata.functions.text import (  # noqa: F401
    direction,
    grouped,
    percent_text,
    plain,
    thousands_usd,
)
