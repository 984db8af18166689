"""Column-level helpers: all built-in, JVM-side expressions."""

from stratum.functions.dates import (  # noqa: F401
    age_group,
    age_years,
    as_of_date,
    calendar_parts,
    days_since,
    parse_date,
    parse_timestamp,
)
from stratum.functions.money import (  # noqa: F401
    avg_cents,
    cents_to_amount,
    div_half_up,
    percent_1dp,
    to_cents,
)
from stratum.functions.text import (  # noqa: F401
    completeness,
    email_domain,
    is_blank,
    normalize_city,
    normalize_state,
    one_line,
)
