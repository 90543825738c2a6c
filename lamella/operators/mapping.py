"""Bring feeds with different columns, codes and formats onto one canonical table, in one plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import dates, numbers, text
from lamella.operators.validate import Rule
from lamella.specs import CourtMapping

TEXT_FIELDS = [
    "county", "case_number", "filing_date", "case_type_raw", "case_status_raw", "court_name", "judge_name",
    "cause_of_action", "amount_demanded", "disposition", "disposition_date",
]
PARTY = "array<struct<name:string,attorney:string>>"
PARTIES_JSON = f"struct<plaintiffs:{PARTY},defendants:{PARTY}>"


def code_rows(codes: dict[str, dict[str, list[str]]]) -> list[tuple[str, str, str]]:
    """(state, raw code, canonical value) of a table canonical -> state -> codes."""
    return [(st, raw, canon) for canon, by_state in codes.items() for st, raws in by_state.items() for raw in raws]


def inline_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A constant table inside the plan. Its size is fixed by configuration, so it may be broadcast."""

    values = ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else _quoted(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def _quoted(value: str | bool | None) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    return "CAST(NULL AS string)" if value is None else "'" + value.replace("'", "\\'") + "'"


def source_field(columns: list[str], fields: dict[str, str], name: str) -> str:
    """SQL of a canonical field: the source column as text, or a typed null where the feed lacks it.

    Feeds are renamed by SQL text rather than column objects: with many feeds and fields, building the
    objects one by one takes the driver longer than the query.
    """
    column = fields.get(name)
    return f"CAST(`{column}` AS string)" if column in columns else "CAST(NULL AS string)"


def _one_party(name: str) -> str:
    party = f"named_struct('name', trim({name}), 'attorney', CAST(NULL AS string))"
    return f"CASE WHEN trim({name}) <> '' THEN array({party}) ELSE CAST(array() AS {PARTY}) END"


def _sides(caption: str) -> dict[str, str]:
    """The sides of a caption, cut at its first "v." or "vs."; in capitals only where the whole caption is. A caption
    without it is the plaintiff."""
    parts = f"split({caption}, IF({caption} = upper({caption}), r'\\s+VS?\\.\\s+', r'\\s+vs?\\.?\\s+'), 2)"
    return {"plaintiff": f"get({parts}, 0)", "defendant": f"get({parts}, 1)"}


def rename_fields(feed: DataFrame, mapping: CourtMapping, carry: list[str]) -> DataFrame:
    """One court's columns under canonical names, all text, absent fields as typed nulls."""
    columns = feed.columns
    fields = {f: source_field(columns, mapping.fields, f) for f in TEXT_FIELDS}
    if mapping.county is not None:
        fields["county"] = _quoted(mapping.county)
    names = {side: source_field(columns, mapping.fields, f"{side}_name") for side in ("plaintiff", "defendant")}
    if mapping.caption in columns:
        names = _sides(f"`{mapping.caption}`")
    parties = {f"{side}s": _one_party(name) for side, name in names.items()}
    if mapping.nested_parties in columns:
        # Parsed in a step before, so that each text is parsed once though two fields are taken from it.
        feed = feed.selectExpr("*", f"from_json(`{mapping.nested_parties}`, '{PARTIES_JSON}') AS _nested")
        parties = {side: f"_nested.{side}" for side in parties}
    if mapping.nested_disposition in columns:
        feed = feed.selectExpr("*", f"from_json(`{mapping.nested_disposition}`, 'struct<type:string,date:string>') AS _outcome")
        fields["disposition"], fields["disposition_date"] = "_outcome.type", "_outcome.date"
    constants = {
        "state_code": mapping.state, "record_source": mapping.record_source, "_prefix": mapping.id_prefix or mapping.state,
        "_format": mapping.date_format, "_zero_is_null": mapping.zero_is_null, "_status_from_date": mapping.status_from_date,
    }
    return feed.selectExpr(
        *[f"{_quoted(v)} AS {name}" for name, v in constants.items()],
        *[f"{sql} AS {name}" for name, sql in {**fields, **parties}.items()],
        *[f"`{c}`" for c in carry],
    )


def harmonize(df: DataFrame, codes: DataFrame, raw: str, into: str, default: str) -> DataFrame:
    """Map ``raw`` through ``codes(state_code, raw, canonical)``, a table fixed by configuration."""
    lookup = codes.select("state_code", F.col("raw").alias(raw), F.col("canonical").alias(into))
    return df.join(lookup, ["state_code", raw], "left").withColumn(into, F.coalesce(into, F.lit(default)))


def canonicalize(
    feeds: dict[str, DataFrame],
    mappings: list[CourtMapping],
    type_codes: DataFrame,
    status_codes: DataFrame,
    carry: list[str],
) -> DataFrame:
    """All feeds as canonical suits in a single plan, so that courts run side by side.

    ``filing_date_raw``, ``amount_raw`` and ``disposition_date_raw`` keep the text that was parsed.
    """
    named = [rename_fields(feeds[m.state], m, carry) for m in mappings if m.state in feeds]
    raw = reduce(lambda a, b: a.unionByName(b), named)
    coded = harmonize(raw, type_codes, "case_type_raw", "case_type", "OTHER")
    coded = harmonize(coded, status_codes, "case_status_raw", "case_status", "UNKNOWN")
    dated = F.when(text.is_filled(F.col("disposition_date")), "DISPOSED").otherwise("OPEN")
    status = F.when(F.col("_status_from_date") & ~text.is_filled(F.col("case_status_raw")), dated).otherwise(F.col("case_status"))
    formats = [m.date_format for m in mappings]

    def day(c: str) -> Column:
        return dates.parse_date_by(F.col(c), F.col("_format"), formats)

    first = {side: F.get(F.col(side), F.lit(0))["name"] for side in ("plaintiffs", "defendants")}
    return coded.select(
        F.concat_ws("_", "_prefix", F.translate("county", " ", "_"), "case_number").alias("suit_id"),
        "state_code", "record_source", "county", "case_number", "case_type", "case_type_raw",
        day("filing_date").alias("filing_date"),
        F.col("filing_date").alias("filing_date_raw"),
        status.alias("case_status"), "case_status_raw", "court_name",
        F.initcap(F.trim("judge_name")).alias("judge_name"),
        "cause_of_action",
        numbers.amount(F.col("amount_demanded"), F.col("_zero_is_null")).alias("amount_demanded"),
        F.col("amount_demanded").alias("amount_raw"),
        "disposition",
        day("disposition_date").alias("disposition_date"),
        F.col("disposition_date").alias("disposition_date_raw"),
        F.lit(None).cast("date").alias("last_activity_date"),
        F.trim(first["plaintiffs"]).alias("plaintiff_name"),
        F.trim(first["defendants"]).alias("defendant_name"),
        "plaintiffs", "defendants", *carry,
    )


def suit_rules() -> list[Rule]:
    return [
        Rule("MISSING_CASE_NUMBER", text.is_filled(F.col("case_number"))),
        Rule("BAD_FILING_DATE", F.col("filing_date").isNotNull()),
        Rule("MISSING_STATE", F.col("state_code").isNotNull()),
    ]


def unread_fields() -> Column:
    """Optional fields whose text could not be read. The row stays valid; the names go to its lineage."""
    return F.array_compact(F.array(
        F.when(text.is_filled(F.col("disposition_date_raw")) & F.col("disposition_date").isNull(), "disposition_date"),
        F.when(F.col("amount_raw").rlike("[A-Za-z]") & F.col("amount_demanded").isNull(), "amount_demanded"),
    ))
