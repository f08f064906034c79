from crowdpulse.functions.text import age_text, full_name, one_decimal, refresh_text
from crowdpulse.functions.time import epoch_now, epoch_to_time, utc_ntz

__all__ = [
    "age_text",
    "epoch_now",
    "epoch_to_time",
    "full_name",
    "one_decimal",
    "refresh_text",
    "utc_ntz",
]
