from .columns import (  # noqa: F401
    cents,
    count_of,
    epoch_day,
    first_of,
    event_time,
    event_date,
    hash_bucket,
    implicit_rating,
    iso_text,
    null_safe_keys,
    safe_ratio,
    split_bucket,
    weighted_score,
)
