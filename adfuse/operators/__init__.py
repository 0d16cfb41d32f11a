from adfuse.operators.conform import conform, conform_all, conform_tagged, unify
from adfuse.operators.filters import filter_fact, filter_series, flag_target
from adfuse.operators.funnel import engagement_summary, funnel_stages, video_funnel
from adfuse.operators.insights import (
    below_target,
    best_per_group,
    best_worst,
    cpa_rank_key,
    leader,
    platform_leaders,
    rank_campaigns,
    top_campaigns,
)
from adfuse.operators.present import (
    campaign_labels,
    cpa_chart,
    display_headers,
    engagement_tiles,
    kpi_tiles,
    platform_kpis_long,
    report_campaign_table,
    report_fact_table,
    roas_chart,
)
from adfuse.operators.rollups import (
    campaign_day_rollup,
    campaign_names,
    campaign_rollup,
    daily_ctr,
    daily_rollup,
    date_extent,
    kpi_summary,
    mean_campaign_roas,
    platform_cpm,
    platform_rollup,
    portfolio_kpis,
    rollup,
)
from adfuse.operators.windows import global_row_number, refresh_rolling_mean, rolling_mean, share_of_total, stack, top_n

__all__ = [n for n in dir() if not n.startswith("_")]
