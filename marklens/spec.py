"""Column roles and cut-offs.

Every operator takes a ``ScorecardSpec``; the default describes student
records, and another table with numeric scores needs only another spec.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Names of the derived columns.
AVERAGE = "Average"
GRADE = "Grade"
STATUS = "Status"
SUPPORT = "Support_Category"
REASON = "Reason"
REJECT_REASON = "Reject_Reason"
INGEST_ORDER = "Ingest_Order"


@dataclass(frozen=True)
class SupportRules:
    """Cut-offs of the support categories; the first matching category wins.

    The mean used here is not rounded, unlike the average the grades use.
    """

    # Category names in their fixed order, and cut-offs.
    categories: tuple[str, ...] = ("High support", "Moderate support", "On track")
    high_mean: float = 40.0
    high_attendance: float = 55.0
    high_hours: float = 2.0
    high_hours_mean: float = 55.0
    moderate_mean: float = 60.0
    moderate_attendance: float = 75.0
    moderate_hours: float = 3.0


@dataclass(frozen=True)
class ScorecardSpec:
    key: str = "Student_ID"
    name: str = "Name"
    group: str = "Gender"
    attendance: str = "Attendance"
    hours: str = "Study_Hours"
    subjects: tuple[str, ...] = ("Math", "Science", "English")

    # Grade bands from best to worst, and thresholds.
    bands: tuple[tuple[float, str], ...] = (
        (90.0, "A"),
        (80.0, "B"),
        (70.0, "C"),
        (60.0, "D"),
    )
    lowest_band: str = "F"
    pass_mark: float = 40.0
    passed: str = "PASS"
    failed: str = "FAIL"
    attendance_floor: float = 75.0
    average_floor: float = 50.0
    mark_min: float = 0.0
    mark_max: float = 100.0
    hours_max: float | None = 24.0
    key_min: int | None = 1
    groups: tuple[str, ...] | None = None

    support: SupportRules = field(default_factory=SupportRules)

    @property
    def grades(self) -> tuple[str, ...]:
        return tuple(label for _, label in self.bands) + (self.lowest_band,)

    @property
    def statuses(self) -> tuple[str, ...]:
        return (self.passed, self.failed)

    @property
    def numeric(self) -> tuple[str, ...]:
        return (self.attendance, self.hours, *self.subjects)

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.key, self.name, self.group, *self.numeric)

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(self.key, T.LongType(), False),
                T.StructField(self.name, T.StringType()),
                T.StructField(self.group, T.StringType()),
                *[T.StructField(c, T.DoubleType()) for c in self.numeric],
            ]
        )

    @property
    def submission_schema(self) -> T.StructType:
        """The same columns as they arrive: all text, not yet validated."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


DEFAULT_SPEC = ScorecardSpec()
