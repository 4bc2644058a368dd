"""Column-level coercions (all JVM-side, inside whole-stage codegen).

Spark 4 runs with ANSI mode on, where ``cast('-' as double)`` raises; every
text-to-number step here uses ``try_cast`` so unparsable text becomes null,
as it did under the non-ANSI default the reference application ran with.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import WIRE_TRUE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    """Numeric or text → double; unparsable text → null."""
    return _col(c).try_cast("double")


def bool_to_double(c: Column | str) -> Column:
    """``'true'`` → 1.0, ``'false'`` → 0.0, null → 0.0, anything else → its number (or null)."""
    x = _col(c)
    s = x.cast("string")
    return (
        F.when(s == "true", F.lit(1.0))
        .when(s == "false", F.lit(0.0))
        .when(x.isNull(), F.lit(0.0))
        .otherwise(s.try_cast("double"))
    )


def bool_to_int(c: Column | str) -> Column:
    """0 when the value is false, 1 otherwise (null included)."""
    return F.when(_col(c).cast("string") == "false", F.lit(0)).otherwise(F.lit(1))


#: What counts as a number on the wire; a bare cast would also take Java's ``1d`` and ``2f``.
NUMBER = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"


def wire_number(c: Column | str) -> Column:
    """Number sent as text, white space around it allowed: unparsable or missing → 0.0."""
    s = _col(c).cast("string")
    return F.coalesce(F.when(s.rlike(NUMBER), s.try_cast("double")), F.lit(0.0))


def wire_bool(c: Column | str) -> Column:
    """Boolean sent as text: true iff the lower-cased text without outer white space is one of the true spellings."""
    t = F.lower(F.regexp_replace(_col(c).cast("string"), r"^\s+|\s+$", ""))
    return F.coalesce(t.isin(*WIRE_TRUE), F.lit(False))
