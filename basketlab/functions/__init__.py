from basketlab.functions.numeric import (
    EXACT,
    div_half_up,
    exact,
    int_div,
    scaled,
    simple_return,
    units,
)

__all__ = [
    "EXACT",
    "div_half_up",
    "exact",
    "int_div",
    "scaled",
    "simple_return",
    "units",
]
