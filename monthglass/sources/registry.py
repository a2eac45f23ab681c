"""The known sources: file name and key columns."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SourceSpec:
    name: str
    file: str
    keys: tuple[str, ...]
    #: The file's header, where it is agreed on; None takes the first file's.
    columns: tuple[str, ...] | None = None


# File names and keys of the four raw sources.
SOURCES = {
    s.name: s
    for s in (
        SourceSpec("clickstream", "feature_clickstream.csv", ("Customer_ID", "snapshot_date")),
        SourceSpec("attributes", "features_attributes.csv", ("Customer_ID", "snapshot_date")),
        SourceSpec("financials", "features_financials.csv", ("Customer_ID", "snapshot_date")),
        SourceSpec("loans", "lms_loan_daily.csv", ("loan_id", "Customer_ID", "snapshot_date")),
    )
}


def source(name: str) -> SourceSpec:
    if name not in SOURCES:
        raise ValueError(f"unknown source {name!r}; known: {sorted(SOURCES)}")
    return SOURCES[name]
