"""Column expressions (no UDFs): clock parsing, service day, schedule instant,
delay, labels."""

from adherence.functions.schedule import (  # noqa: F401
    DEFAULT_TZ,
    actual_local_date,
    clock_parts,
    delay_seconds,
    epoch_of_ntz,
    epoch_to_local_ntz,
    scheduled_epoch,
    service_date,
)
from adherence.functions.labels import display_label  # noqa: F401
