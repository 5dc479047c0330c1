"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""
from voltaic.functions.exprs import (  # noqa: F401
    code_case,
    guarded_ratio,
    in_band,
    lit_for,
    probability_of,
    safe_div,
)
from voltaic.functions.timefix import (  # noqa: F401
    epoch_ntz,
    is_repaired,
    micros_to_ntz,
    nanos_to_micros,
    ntz_to_micros,
    repair_time,
    to_millis,
)
