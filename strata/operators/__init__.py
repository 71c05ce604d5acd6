"""DataFrame -> DataFrame operators: silver cleaning, period trends,
channel performance and report figures."""

from strata.operators.channels import (  # noqa: F401
    channel_orders,
    channel_performance,
    channel_sessions,
    conversions_per_visit,
    join_channel_totals,
    label_visits,
)
from strata.operators.insights import (  # noqa: F401
    best_period,
    best_worst_channel,
    channel_conversion_series,
    channel_revenue_series,
    channel_table,
    channel_type_mix,
    count_by,
    insight_summary,
    kpi_totals,
    paid_free_share,
    side_by_side,
    significant_channels,
    top_channel,
    trend_direction,
    trend_growth,
    trend_series,
    trend_windows,
    type_table,
)
from strata.operators.silver import (  # noqa: F401
    cast_timestamps,
    clean,
    drop_exact_duplicates,
    require_key,
    resolve_key,
)
from strata.operators.trend import (  # noqa: F401
    conversions_per_period,
    fill_missing,
    period_counts,
    period_trend,
    visits_per_period,
)
