"""Options that select one of the three transform dialects.

The reference computes the long-to-wide transform three times with
different semantics; one parameterised transform reproduces each of them.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class TransformOptions:
    """How raw observations become measures.

    drop_flagged:      drop rows whose quality flag is not empty.
    clip_raw:          null TMAX/TMIN whose raw value lies outside
                       [-clip_raw, clip_raw] (bounds kept); None = no clip.
    prcp_divisor:      PRCP is divided by this (10 = tenths of mm -> mm).
    integer_division:  divide tenths with integer division (truncating
                       toward zero) before the cast, as an INTEGER column does.
    measure_type:      Spark SQL type of the measures ("double" or a decimal).
    order_by:          columns that order rows inside a group when one row
                       has to be picked (the flags).  None = a hash of the
                       row's content, which is deterministic but arbitrary.
    order_unique:      the one ``order_by`` column is never the same in two rows of a
                       group, so it orders them alone, without a hash behind it.
    column_order:      "sql" (station name before coordinates) or "job"
                       (coordinates first), the two fact layouts.
    year_start:        type of the yearly ``date``: "date" (first day of the
                       year) or "timestamp" (its first instant, no time zone).
    """

    drop_flagged: bool = True
    clip_raw: int | None = 700
    prcp_divisor: int = 10
    integer_division: bool = False
    measure_type: str = "double"
    order_by: tuple[str, ...] | None = None
    order_unique: bool = False
    column_order: str = "sql"
    year_start: str = "date"

    def __post_init__(self):
        if self.column_order not in ("sql", "job"):
            raise ValueError(f"column_order must be 'sql' or 'job', not {self.column_order!r}")
        if self.year_start not in ("date", "timestamp"):
            raise ValueError(f"year_start must be 'date' or 'timestamp', not {self.year_start!r}")
        if self.prcp_divisor < 1:
            raise ValueError("prcp_divisor must be at least 1")
        if self.clip_raw is not None and self.clip_raw < 0:
            raise ValueError("clip_raw must be None or a bound >= 0")
        mt = self.measure_type.replace(" ", "").lower()
        if mt != "double" and not mt.startswith("decimal"):
            raise ValueError(f"measure_type must be 'double' or a decimal type, not {self.measure_type!r}")
        if self.order_by is not None and not self.order_by:
            raise ValueError("order_by must name at least one column (or be None)")
        if self.order_unique and (self.order_by is None or len(self.order_by) != 1):
            raise ValueError("order_unique is about exactly one order_by column")

    def with_order(self, *cols: str, unique: bool = False) -> "TransformOptions":
        return replace(self, order_by=tuple(cols), order_unique=unique)


# The SQL models on the cloud warehouse: the specified behaviour.
CANONICAL = TransformOptions()
# The SQL models on the local database: INTEGER value, so value/10 truncates,
# and no temperature clip.
LOCAL = TransformOptions(clip_raw=None, integer_division=True, measure_type="decimal(38,9)", year_start="timestamp")
# The batch Spark job: flagged rows kept, PRCP left unscaled, clip kept.
JOB = TransformOptions(drop_flagged=False, prcp_divisor=1, column_order="job")
