"""Names of courts as one key: spellings are brought to one form, and a dictionary of a state's other names is applied."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import text
from lamella.operators.mapping import inline_table

# Other names of counties, in the form that court_form gives; short forms that feeds use.
COURT_ALIASES = [
    ("FL", "dade", "miami dade"), ("NY", "brooklyn", "kings"), ("NY", "manhattan", "new york"), ("NY", "staten island", "richmond"),
    ("CA", "la", "los angeles"), ("CA", "sf", "san francisco"),
]


def court_form(county: Column) -> Column:
    """Lower case without punctuation and without the word for the kind of district. Null or nothing left is null."""
    words = F.trim(F.regexp_replace(F.lower(county), r"[^\p{L}\p{M}\p{N}]+", " "))

    def bare(w: Column) -> Column:
        named = reduce(lambda a, b: a | b, [w.contains(kind) for kind in ("county", "cnty", "parish", "borough")])
        cut = F.regexp_replace(w, r"^(?:county|city and county|parish|borough) of |\b(?:county|cnty|parish|borough)\b", "")
        return F.when(named, text.squeeze(cut)).otherwise(w)

    # The first that is not empty. As variables of functions on arrays the patterns run once a row; tests for empty text would
    # each hold them again, and filters run them each time.
    both = F.flatten(F.transform(F.array(words), lambda w: F.array(bare(w), w)))
    return F.get(F.filter(both, lambda w: w != ""), F.lit(0))


def court_aliases(spark: SparkSession, more: list[tuple[str, str, str]] = ()) -> DataFrame:
    """(state_code, alias, court), a table fixed by configuration."""
    return inline_table(spark, [*COURT_ALIASES, *more], ["state_code", "alias", "court"])


def with_court(df: DataFrame, aliases: DataFrame | None = None, into: str = "_court") -> DataFrame:
    """``df`` with the key of its court, from ``state_code`` and ``county``."""
    named = df.withColumn(into, court_form(F.col("county")))
    if aliases is None:
        return named
    known = aliases.select("state_code", F.col("alias").alias(into), F.col("court").alias("_known"))
    return named.join(F.broadcast(known), ["state_code", into], "left").withColumn(into, F.coalesce("_known", into)).select(*df.columns, into)
