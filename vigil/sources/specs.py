"""The sending systems: where their files arrive and which landing table they feed."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SourceSpec:
    source: str
    folder: str | None = "records"  # None: find the single data folder at run time
    landing_table: str | None = None  # set when one system feeds several tables

    @property
    def table(self) -> str:
        return self.landing_table or f"{self.source}_raw"

    @property
    def base(self) -> str:
        return f"{self.source}_raw"


# System names, folders and tables.
SOURCES = [
    SourceSpec("lims"),
    SourceSpec("adam_cases", "cases"),
    SourceSpec("adam_travellers", "travellers"),
    SourceSpec("uhai", "traveler_screenings"),
    SourceSpec("cbs", "reports"),
    SourceSpec("cbs", "screenings", "cbs_screenings_raw"),
    SourceSpec("mdharura", "signals"),
    SourceSpec("echis", "signals"),
    SourceSpec("krcs_evd_screening", None),
    SourceSpec("krcs_evd_quarantine", "quarantine_records"),
    SourceSpec("taifa_care_kenyaemr", "flagged_cases"),
]


def source_for(table: str) -> SourceSpec:
    return next(s for s in SOURCES if s.table == table)
