"""Secret scan with corpus-wide ownership: who else holds the same candidate tells copies from live credentials.

A candidate that many repositories and owners share is an example that was copied around; one that a single owner or a
single repository has looks live. Matching runs over whole texts in Python workers; ownership is counted by Spark over all documents.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import staged
from lamella.llm.ngram_join import group_by_ngrams

# The base patterns, the group that must be long enough, and how long. ASCII letters only fold in `assign`.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "opaque")

_SPANS = "array<struct<kind:string,start:int,end:int,secret:string>>"


def find_candidates(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, digest of the secret) in a text, by start, then kind as listed; code points, end exclusive.

    Within a kind matches are leftmost and do not overlap; matches that are too short are dropped after matching, so
    they still use up their text. ``opaque`` is the added kind: tokens of 24 characters or more with digits, capitals and
    small letters and at least 3.5 bits a character, outside all other matches.
    """
    found = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api_key", "apikey")):
        for m in re.finditer(ASSIGN, text, re.I | re.A):
            if len(m[2]) >= 8:
                found.append(("assign", *m.span(), m[2]))
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in re.finditer(ACCESS, text) if len(m[0]) >= 16]
    # runs are maximal, so a run of 32 or more found at once is the one that the base pattern finds
    found += [("hex", *m.span(), m[0]) for m in re.finditer(r"[0-9a-f]{32,}", text)]
    for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}(?![A-Za-z0-9+/_=-])", text):
        t = m[0]
        if re.search("[0-9]", t) and re.search("[A-Z]", t) and re.search("[a-z]", t):
            bits = -sum(n / len(t) * math.log2(n / len(t)) for n in Counter(t).values())
            if bits >= 3.5 and not any(s < m.end() and m.start() < e for _, s, e, _ in found):
                found.append(("opaque", *m.span(), t))
    found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return [(k, s, e, hashlib.md5(v.encode("utf-8", "surrogatepass")).hexdigest()) for k, s, e, v in found]


def _candidates(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([[dict(zip(("kind", "start", "end", "secret"), c, strict=True)) for c in find_candidates(t)] if t else []
                         for t in texts])


def _without_near_copies(found: DataFrame, holders: DataFrame) -> DataFrame:
    """``holders`` (secret, repository, owner) with one owner for all near copies of a text."""
    several = holders.groupBy("secret").agg(F.min("owner").alias("low"), F.max("owner").alias("high")).where("low < high").select("secret")
    shared = staged(holders.join(several, "secret").select("owner").distinct(), "secret-owners")
    if shared.isEmpty():
        return holders
    texts = staged(found.join(shared, "owner").groupBy("owner").agg(F.min("text").alias("text")), "secret-texts")
    groups = staged(group_by_ngrams(texts, n=3, percent=70, doc_id="owner").select(
        F.col("doc_id").alias("owner"), F.col("component_id").alias("first")), "secret-groups")
    return holders.join(groups, "owner", "left").select("secret", "repository", F.coalesce("first", "owner").alias("owner"))


def scan(docs: DataFrame, text: str = "text", repository: str = "source", doc_id: str = "doc_id",
         shared_repositories: int = 3, shared_owners: int = 6) -> DataFrame:
    """(doc_id, spans): array<struct<kind, start, end, secret, repositories, owners, live>> of every row of ``docs``.

    Repositories are distinct values of ``repository`` (null is one). Copies and near copies of one document are one
    owner: texts that share at least 70 % of their three-word shingles, or are joined by a chain of such texts, among those
    that hold a secret of several texts. A secret in at least ``shared_repositories`` repositories is widely copied, and so
    is one in several repositories with at least ``shared_owners`` owners; any other is live, so one repository never makes
    a copy, however many texts it has. Null and empty texts have no spans; repeated rows are each returned; an empty
    table gives no rows. Other columns are not looked at.
    """
    found = staged(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(repository).cast("string").alias("repository"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("owner"), F.pandas_udf(_candidates, _SPANS)(text).alias("spans"), F.col(text).alias("text"),
    ).withColumn("text", F.when(F.size("spans") > 0, F.col("text"))), "secrets")
    # one row for each distinct text that holds anything, so many copies of a text are looked up once
    texts = found.where(F.size("spans") > 0).groupBy("owner").agg(F.first("spans").alias("spans"))
    holders = staged(found.where(F.size("spans") > 0).select(
        F.explode(F.array_distinct(F.col("spans.secret"))).alias("secret"), F.coalesce("repository", F.lit("\0")).alias("repository"), "owner").distinct(), "secret-holders")
    holders = _without_near_copies(found, holders)
    repositories = holders.select("secret", "repository").distinct().groupBy("secret").agg(F.count(F.lit(1)).alias("repositories"))
    owners = holders.select("secret", "owner").distinct().groupBy("secret").agg(F.count(F.lit(1)).alias("owners"))
    known = repositories.join(owners, "secret")
    judged = (
        texts.select("owner", F.posexplode("spans").alias("at", "span")).select("owner", "at", "span.*")
        .join(known, "secret")
        .withColumn("live", (F.col("repositories") < shared_repositories) & ((F.col("repositories") < 2) | (F.col("owners") < shared_owners)))
        .groupBy("owner").agg(F.array_sort(F.collect_list(F.struct(
            "at", "kind", "start", "end", "secret", "repositories", "owners", "live"))).alias("judged"))
    )
    holding = found.where(F.size("spans") > 0).select("doc_id", "owner").join(judged, "owner").select(
        "doc_id", F.transform("judged", lambda s: s.dropFields("at")).alias("spans"))
    none = F.array().cast(holding.schema["spans"].dataType)
    return holding.unionByName(found.where(F.size("spans") == 0).select("doc_id", none.alias("spans")))
