"""Column-level functions (all JVM-side Spark expressions, no Python UDFs)."""

from strider.functions.dates import (  # noqa: F401
    ordinal_date_text, parse_day, standardize_date,
)
from strider.functions.durations import (  # noqa: F401
    duration_text, half_up_hundredths, percentage,
)
from strider.functions.geo import EARTH_RADIUS_M, haversine_m  # noqa: F401
from strider.functions.labels import activity_text  # noqa: F401
from strider.functions.timecols import (  # noqa: F401
    day_end_ms, day_folder, epoch_ms, epoch_ms_whole_seconds, half_hour_slot, iso_weekday,
    ms_to_utc, slot_text, to_epoch_ms,
)
from strider.functions.vectors import array_sum, magnitude, majority_vote  # noqa: F401
