"""What one build run carries: its clock, its id and the label curator whose labels are published."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Run:
    """``now`` is an argument everywhere, so a rebuild of an old day gives the same rows."""

    now: datetime
    run_id: str = ""
    label_creator: str | None = None

    @property
    def clock(self):
        return F.lit(self.now).cast("timestamp_ntz")

    @property
    def today(self):
        return F.to_date(self.clock)

    def audit(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "inserted_timestamp": self.clock,
                "modified_timestamp": self.clock,
                "_invocation_id": F.lit(self.run_id),
            }
        )
