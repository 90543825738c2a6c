"""Suits, liens and judgments from files to gold."""

import pytest
from pyspark.sql import functions as F
from test_layers import court_files

from lamella.plans import pipelines
from lamella.plans.court_names import court_aliases, court_form
from lamella.plans import public_records as pr
from lamella.specs import SourceSpec


def filing_files(folder):
    """NY judgments of the suits of court_files, a judgment lien for each, and UCC filings in TX."""
    n = range(1, 61)
    files = {
        "judgment_state": ("case_number,judgment_date,judgment_type,amount,prevailing_party,satisfied,satisfaction_date,county",
                           [f"NY-{i},2024-04-01,default,${i}00.00,{'plaintiff' if i % 2 else 'defendant'},N,,{'KINGS' if i % 3 else 'Brooklyn'}" for i in n]
                           + ["NY-7,2024-04-02,default,5.00,plaintiff,N,,Queens", ",2024-04-01,default,1.00,,N,,KINGS"]),
        "lien_judgment": ("book_page,filing_date,debtor,creditor,amount,case_number",
                          [f"B{i},2024-05-{i % 28 + 1:02d},{'Big Bank' if i % 2 else 'Ann Lee'},{'Ann Lee' if i % 2 else 'Big Bank'},{i}00.00,{f'NY-{i}' if i % 5 else ''}" for i in n]),
        "lien_ucc": ("file_number,file_date,debtor_name,secured_party,collateral_description,status",
                     [f"U{i},{2010 if i % 4 == 0 else 2023}-01-05,ACME LLC,First Bank,all assets,Active" for i in n] + [",2023-01-05,ACME LLC,x,y,Active"]),
    }
    specs = []
    for table, (header, lines) in files.items():
        (folder / f"{table}.csv").write_text("\n".join([header, *lines]) + "\n")
        state = "TX" if table == "lien_ucc" else "NY"
        specs.append(SourceSpec(f"{state}_{table}", str(folder / f"{table}.csv"), "csv", table=table, lineage={"state": state, "county": "Kings County"}))
    return specs


def test_public_records(spark, tmp_path):
    suits, root = court_files(tmp_path / "in"), str(tmp_path / "out")
    others = filing_files(tmp_path / "in")
    rows = {(r["layer"], r["table_name"]): r["rows"]
            for r in pipelines.run_public_records(spark, suits, others, root, "2025-01-15", "2025-01-15").collect()}
    assert rows["silver", "liens"] == 120 and rows["quarantine", "liens"] == 1 and rows["quarantine", "judgments"] == 1
    assert rows["silver", "judgments"] == 61 and rows["review", "judgments"] == 1

    def read(layer, table):
        return spark.read.parquet(f"{root}/{layer}/{table}")

    review = read("review", "judgments").first()
    assert (review["county"], review["reason"]) == ("Queens", "UNKNOWN_COURT")
    assert read("silver", "judgments").where("suit_id is not null").count() == 60, "KINGS, Brooklyn and Kings are one court"
    names = {r["party_name_normalized"]: r for r in read("silver", "party_master").collect()}
    bank, lee, acme = (next(r for n, r in names.items() if n.upper() == x) for x in ("BIG BANK", "ANN LEE", "ACME LLC"))
    assert (bank["total_as_defendant"], bank["total_liens_as_debtor"], bank["total_liens_as_creditor"]) == (60, 30, 30)
    assert (lee["total_as_plaintiff"], lee["total_liens_as_debtor"], lee["total_liens_as_creditor"]) == (60, 30, 30)
    assert acme["total_as_plaintiff"] == 120 and acme["total_liens_as_debtor"] == 60 and set(acme["states_appeared"]) == {"TX", "CA"}
    profile = {r["party_key"]: r for r in read("gold", "party_profile").collect()}
    assert profile[bank["party_id"]]["judgments_against"] == 30 and profile[bank["party_id"]]["liens_as_creditor"] == 30
    liens = read("gold", "lien_best_view")
    assert liens.where("related_suit_id is not null and confidence = 'HIGH'").count() == 48
    assert liens.where("lien_type = 'JUDGMENT' and confidence = 'MEDIUM'").count() == 12, "found by debtor, amount and day"
    assert liens.where("lien_type = 'UCC' and lien_status = 'EXPIRED' and not is_active").count() == 15
    assert read("gold", "suit_best_view_full").where("has_judgment").count() == 60
    assert read("gold", "suit_judgment_lien_xref").where("lien_id is not null").count() == 60
    assert read("gold", "frequent_parties").where(F.col("party_key") == acme["party_id"]).count() == 1


def test_court_names(spark):
    forms = {"Harris County": "harris", "HARRIS": "harris", " County of Los  Angeles": "los angeles", "Miami-Dade County": "miami dade", "Orleans Parish": "orleans",
             "County": "county", "": None, None: None, "SD NY": "sd ny"}
    df = spark.createDataFrame(list(forms.items()), "c string, want string")
    assert df.where(~court_form(F.col("c")).eqNullSafe(F.col("want"))).collect() == []
    suits = spark.createDataFrame(
        [("s1", "FL", "Miami-Dade County", "1"), ("s2", "FL", "Miami-Dade", "2"), ("s3", "FL", "DADE", "2"), ("s4", "FL", None, "3")],
        "suit_id string, state_code string, county string, case_number string")
    judgments = spark.createDataFrame(
        [(1, "FL", "dade county", "1"), (2, "FL", "Dade", "2"), (3, "FL", "Nowhere", "1"), (4, "FL", None, "2"), (5, "FL", None, "3"), (6, "FL", "Dade", "9"), (7, "FL", "Dade", None)],
        "judgment_key long, state_code string, county string, case_number string")
    aliases = court_aliases(spark)
    linked = {r.judgment_key: r.suit_id for r in pr.link_suit_judgment(suits, judgments, aliases).collect()}
    assert linked == {1: "s1", 2: None, 3: None, 4: None, 5: "s4", 6: None, 7: None}
    review = {r.judgment_key: r.reason for r in pr.unlinked_judgments(suits, judgments, aliases).collect()}
    assert review == {2: "SEVERAL_SUITS", 3: "UNKNOWN_COURT", 4: "SEVERAL_SUITS", 6: "NO_SUIT", 7: "NO_CASE_NUMBER"}
    assert set(review) == {k for k, v in linked.items() if v is None}, "no judgment is lost without a reason"
