"""Column expressions (no DataFrame in, no DataFrame out)."""

from strata.functions.classify import (  # noqa: F401
    any_of, day_type, fuel_category, is_volatile, overall_direction, penalty_flag,
    price_direction, region_label, region_type, risk_tier, time_period,
)
from strata.functions.numeric import (  # noqa: F401
    change, change_pct, round_half_up, safe_divide, share_pct,
)
from strata.functions.parse import (  # noqa: F401
    parse_mixed_date, parse_period, parse_snapshot_time,
)
