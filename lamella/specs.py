"""Descriptions of sources: adding a court or a feed means adding a row here, not code."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SourceSpec:
    """How raw files are read. ``options`` go to the reader of ``format``."""

    name: str
    path: str
    format: str
    system: str = "files"
    table: str = ""
    options: dict = field(default_factory=dict)
    lineage: dict = field(default_factory=dict)


@dataclass(frozen=True)
class CourtMapping:
    """How one court's feed maps onto the canonical suit.

    ``fields`` maps canonical names to source columns. The county is fixed, or read from the canonical
    ``county`` field. ``nested_parties`` names a JSON column holding arrays of plaintiffs and defendants,
    ``nested_disposition`` one holding type and date. ``caption`` names a column like "X v. Y" that holds both
    sides. With ``status_from_date`` a suit without a status is disposed once it has a disposition date, else open.
    """

    state: str
    fields: dict[str, str]
    date_format: str
    county: str | None = None
    record_source: str = "STATE_COURT"
    nested_parties: str | None = None
    nested_disposition: str | None = None
    zero_is_null: bool = False
    id_prefix: str | None = None
    caption: str | None = None
    status_from_date: bool = False
