from monthplan.functions.months import (  # noqa: F401
    days_in_next_month,
    expand_to_months,
    month_date,
    months_literal,
    plan_months,
)
from monthplan.functions.quantities import QTY, RATE, as_qty, as_rate, to_edge  # noqa: F401
