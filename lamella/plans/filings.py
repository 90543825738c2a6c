"""Lien and judgment feeds on their canonical tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import dates, numbers, text
from lamella.operators.dedupe import latest
from lamella.operators.mapping import source_field
from lamella.operators.validate import Rule, Split, split_valid
from lamella.plans.public_records import judgment_id, lien_id


@dataclass(frozen=True)
class FilingFeed:
    """One kind of filing: which source column holds which canonical field, and where it is filed."""

    kind: str
    fields: dict[str, str]
    office: str = ""
    date_format: str = "yyyy-MM-dd"


# Columns of the lien feeds. ``state_code`` comes from the bronze lineage.
LIEN_FEEDS = [
    FilingFeed("UCC", {
        "state_code": "_source_state", "file_number": "file_number", "filing_date": "file_date", "debtor_name": "debtor_name",
        "creditor_name": "secured_party", "collateral_description": "collateral_description", "status": "status",
    }, "SOS"),
    FilingFeed("FEDERAL_TAX", {
        "state_code": "_source_state", "file_number": "serial_number", "filing_date": "filing_date",
        "debtor_name": "taxpayer_name", "lien_amount": "amount", "release_date": "release_date",
    }, "COUNTY_RECORDER"),
    FilingFeed("STATE_TAX", {
        "state_code": "_source_state", "county": "county", "file_number": "lien_number", "filing_date": "filing_date",
        "debtor_name": "debtor_name", "lien_amount": "amount",
    }, "COUNTY_CLERK"),
    FilingFeed("JUDGMENT", {
        "state_code": "_source_state", "county": "_source_county", "file_number": "book_page", "filing_date": "filing_date",
        "debtor_name": "debtor", "creditor_name": "creditor", "lien_amount": "amount", "related_case_number": "case_number",
    }, "COUNTY_RECORDER"),
    FilingFeed("MECHANIC", {
        "state_code": "_source_state", "county": "_source_county", "file_number": "document_number",
        "filing_date": "filing_date", "debtor_name": "property_owner", "creditor_name": "claimant", "lien_amount": "amount",
        "property_address": "property_address",
    }, "COUNTY_RECORDER"),
]

# Columns of the judgment feeds.
JUDGMENT_FEEDS = [
    FilingFeed("STATE", {
        "state_code": "_source_state", "case_number": "case_number", "judgment_date": "judgment_date",
        "judgment_type": "judgment_type", "judgment_amount": "amount", "prevailing_party": "prevailing_party",
        "satisfied": "satisfied", "satisfaction_date": "satisfaction_date", "county": "county",
    }),
    FilingFeed("FEDERAL", {
        "state_code": "_source_state", "case_number": "docket_number", "judgment_date": "judgment_date",
        "judgment_amount": "amount", "county": "district",
    }),
]

# Canonical words.
LIEN_STATUSES = ["ACTIVE", "RELEASED", "EXPIRED", "SATISFIED", "PARTIAL_RELEASE"]
JUDGMENT_TYPES = ["DEFAULT", "CONSENT", "SUMMARY", "TRIAL_VERDICT", "STIPULATED"]
SATISFACTION_STATUSES = ["SATISFIED", "PARTIALLY_SATISFIED", "VACATED", "UNSATISFIED"]

_LIEN_TEXT = ["state_code", "county", "file_number", "filing_date", "lien_amount", "status", "release_date", "debtor_name",
              "creditor_name", "related_case_number", "property_address", "collateral_description"]
_JUDGMENT_TEXT = ["state_code", "case_number", "judgment_date", "judgment_type", "judgment_amount", "prevailing_party",
                  "satisfied", "satisfaction_date", "county"]


def _stack(feeds: dict[str, DataFrame], known: list[FilingFeed], names: list[str], carry: list[str]) -> DataFrame:
    """All feeds under canonical names in one plan, still as text."""
    def named(k: FilingFeed) -> DataFrame:
        columns = feeds[k.kind].columns
        return feeds[k.kind].selectExpr(
            f"'{k.kind}' AS _kind", f"'{k.office}' AS _office", f"'{k.date_format}' AS _format",
            *[f"{source_field(columns, k.fields, n)} AS {n}" for n in names], *carry,
        )

    return reduce(lambda a, b: a.unionByName(b), [named(k) for k in known if k.kind in feeds])


def _canonical_word(c: Column, words: list[str]) -> Column:
    word = F.regexp_replace(text.uppered(c), "[ -]+", "_")
    return F.when(word.isin(words), word)


def _filled(c: str) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def canonical_liens(feeds: dict[str, DataFrame], newest: str, carry: list[str], split: Split = split_valid) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of all lien feeds; the latest version of each lien counts."""
    raw = _stack(feeds, LIEN_FEEDS, _LIEN_TEXT, carry)
    formats = [k.date_format for k in LIEN_FEEDS]
    filed = dates.parse_date_by(F.col("filing_date"), F.col("_format"), formats)
    released = dates.parse_date_by(F.col("release_date"), F.col("_format"), formats)
    valid, rejected = split(raw, [
        Rule("MISSING_FILE_NUMBER", text.is_filled(F.col("file_number"))),
        Rule("MISSING_STATE", text.is_filled(F.col("state_code"))),
        Rule("BAD_FILING_DATE", filed.isNotNull()),
    ])
    status = F.coalesce(
        _canonical_word(F.col("status"), LIEN_STATUSES), F.when(released.isNotNull(), "RELEASED"), F.lit("ACTIVE")
    )
    liens = valid.select(
        lien_id(F.col("_kind"), F.col("state_code"), F.trim("file_number")).alias("lien_id"),
        F.col("_kind").alias("lien_type"),
        "state_code",
        _filled("county").alias("county"),
        F.col("_office").alias("filing_office"),
        F.trim("file_number").alias("file_number"),
        filed.alias("filing_date"),
        numbers.amount(F.col("lien_amount")).alias("lien_amount"),
        status.alias("lien_status"),
        released.alias("release_date"),
        _filled("related_case_number").alias("related_case_number"),
        _filled("property_address").alias("property_address"),
        _filled("collateral_description").alias("collateral_description"),
        text.display_name(F.col("debtor_name")).alias("debtor_name"),
        text.display_name(F.col("creditor_name")).alias("creditor_name"),
        *carry,
    )
    return latest(liens, ["lien_id"], newest), rejected


def canonical_judgments(feeds: dict[str, DataFrame], newest: str, carry: list[str], split: Split = split_valid) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of the judgment feeds; the latest version of each judgment of a court counts.

    Satisfaction is a flag or one of the canonical words; a date alone means satisfied, anything else unsatisfied.
    """
    raw = _stack(feeds, JUDGMENT_FEEDS, _JUDGMENT_TEXT, carry)
    decided = dates.parse_date_by(F.col("judgment_date"), F.col("_format"), [k.date_format for k in JUDGMENT_FEEDS])
    valid, rejected = split(raw, [
        Rule("MISSING_CASE_NUMBER", text.is_filled(F.col("case_number"))),
        Rule("MISSING_STATE", text.is_filled(F.col("state_code"))),
        Rule("BAD_JUDGMENT_DATE", decided.isNotNull()),
    ])
    settled = dates.parse_date_by(F.col("satisfaction_date"), F.col("_format"), [k.date_format for k in JUDGMENT_FEEDS])
    status = F.coalesce(
        F.when(text.lowered(F.col("satisfied")).isin("y", "yes", "true"), "SATISFIED"),
        _canonical_word(F.col("satisfied"), SATISFACTION_STATUSES),
        F.when(settled.isNotNull() & ~text.is_filled(F.col("satisfied")), "SATISFIED"), F.lit("UNSATISFIED"))
    judgments = valid.select(
        judgment_id(F.col("state_code"), F.trim("case_number"), decided).alias("judgment_id"),
        "state_code",
        _filled("county").alias("county"),
        F.trim("case_number").alias("case_number"),
        decided.alias("judgment_date"),
        _canonical_word(F.col("judgment_type"), JUDGMENT_TYPES).alias("judgment_type"),
        numbers.amount(F.col("judgment_amount")).alias("judgment_amount"),
        text.uppered(F.col("prevailing_party")).alias("prevailing_party"),
        status.alias("satisfaction_status"),
        settled.alias("satisfaction_date"),
        *carry,
    )
    return latest(judgments, ["judgment_id", "county"], newest), rejected
