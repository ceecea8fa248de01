from dayframe.functions.columns import (  # noqa: F401
    SEASON_ORDER,
    any_not_null,
    ascii_fold,
    band_label,
    clamp,
    haversine_km,
    min_max_norm,
    path_safe_timestamp,
    ratio_pct,
    score_class,
    season_from_date,
    season_ordinal,
    slug,
    sql_round,
    surrogate_key,
    temperature_class,
    unit_vector,
)
