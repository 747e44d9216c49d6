"""Column functions: cleaning, safe casts, ratios and rule expressions."""

from tradeloom.functions.casting import (
    as_date,
    as_decimal,
    as_int,
    as_seconds,
    as_smallint,
    int_through_double,
)
from tradeloom.functions.numeric import (
    computed_once,
    from_choices,
    join_reasons,
    ratio,
    round2,
)
from tradeloom.functions.text import clean, present, stripped

__all__ = [
    "as_date",
    "as_decimal",
    "as_int",
    "as_seconds",
    "as_smallint",
    "clean",
    "computed_once",
    "from_choices",
    "int_through_double",
    "join_reasons",
    "present",
    "ratio",
    "round2",
    "stripped",
]
