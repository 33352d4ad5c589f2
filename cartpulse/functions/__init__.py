from cartpulse.functions.timeparts import (  # noqa: F401
    EPOCH_NTZ, epoch_ms_to_local, instant_to_ntz, ntz_to_epoch_ms, ntz_to_instant,
    with_date_hour, split_create_time, epoch_bucket, floor_div, wall_clock_text,
)
from cartpulse.functions.money import money_sum, sorted_csv  # noqa: F401
