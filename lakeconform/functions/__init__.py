"""Column-to-column building blocks. All give the same values with ANSI mode on or off."""

from lakeconform.functions.dates import active_flag, month_key, parse_date, parse_month
from lakeconform.functions.keys import json_path, normalize_code, surrogate_key
from lakeconform.functions.numbers import (
    cap_range,
    guarded_ratio,
    parse_double,
    parse_int,
    parse_score,
    round_half_away,
    score_origin,
    stable_round,
    was_capped,
)
from lakeconform.functions.text import (
    clean_string,
    default_label,
    email_domain,
    is_valid_email,
    normalize_email,
    tristate_equal,
    upper_label,
)
from lakeconform.functions.vocab import (
    map_values,
    normalize_employment_type,
    normalize_engagement_type,
    normalize_role,
    normalize_status,
)

__all__ = [
    "active_flag",
    "cap_range",
    "clean_string",
    "default_label",
    "email_domain",
    "guarded_ratio",
    "is_valid_email",
    "json_path",
    "map_values",
    "month_key",
    "normalize_code",
    "normalize_email",
    "normalize_employment_type",
    "normalize_engagement_type",
    "normalize_role",
    "normalize_status",
    "parse_date",
    "parse_double",
    "parse_int",
    "parse_month",
    "parse_score",
    "round_half_away",
    "score_origin",
    "stable_round",
    "surrogate_key",
    "tristate_equal",
    "upper_label",
    "was_capped",
]
