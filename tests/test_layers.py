"""Sources, sinks, pipelines and streams on small files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from lamella.operators.quality import GateFailed
from lamella.plans import pipelines
from lamella.sources import bronze, readers, sinks
from lamella.specs import SourceSpec
from lamella.streaming import jobs


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unknown format"):
        readers.read_source(spark, SourceSpec("x", "/nowhere", "parchment"))


def test_nested_json_array_keeps_text(spark, tmp_path):
    doc = [{"id": "1", "parties": {"plaintiffs": [{"name": "A"}]}, "amount": 12.5}, {"id": "2", "parties": {}, "amount": None}]
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=2))
    rows = readers.read_json_raw(spark, str(tmp_path / "a.json")).orderBy("id").collect()
    assert json.loads(rows[0]["parties"]) == doc[0]["parties"] and rows[0]["amount"] == "12.5" and rows[1]["amount"] is None


def test_json_raw_keeps_text_of_split_and_packed_files(spark, tmp_path):
    """Nested text stays as written, also in a gzip file and in one that Spark cuts in parts."""
    cases = ",\n".join(f'{{"id": {i}, "parties": {{"a": [{i},  1.50]}}}}' for i in range(20_000))
    for folder, opened in (("plain", open), ("packed", gzip.open)):
        (tmp_path / folder).mkdir()
        with opened(tmp_path / folder / ("a.json" + ".gz" * (folder == "packed")), "wt") as f:
            f.write(f"[\n{cases}\n]")
    expected = {(str(i), f'{{"a": [{i},  1.50]}}') for i in range(20_000)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        for folder in ("plain", "packed"):
            rows = readers.read_json_raw(spark, str(tmp_path / folder), ["id", "parties"])
            assert {tuple(r) for r in rows.collect()} == expected
            assert rows.count() == len(expected)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_malformed_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\nbroken\n{"a": 2}\n')
    df = readers.read_jsonl_raw(spark, str(tmp_path / "a.jsonl"), ["a"], keep_malformed=True)
    good, bad = bronze.split_malformed(df)
    assert sorted(r["a"] for r in good.collect()) == ["1", "2"]
    assert [r[readers.CORRUPT] for r in bad.collect()] == ["broken"]


def test_row_positions_across_file_splits(spark, tmp_path):
    for name, n in (("a.csv", 4000), ("b.csv", 1500)):
        (tmp_path / name).write_text("k,v\n" + "".join(f"{i},text {i}\n" for i in range(1, n + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = readers.read_csv_raw(spark, str(tmp_path), fields=["k", "v"])
        assert df.rdd.getNumPartitions() > 5
        rows = bronze.row_positions(df)
        assert rows.count() == 5500
        assert rows.where(F.col("k").cast("long") != F.col("_row_number")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).withColumn("day", F.col("id") % 4)
    assert sinks.write_partition(df, path, ["day"]) == 100
    assert sinks.write_partition(df.where("day = 1"), path, ["day"]) == 25
    assert spark.read.parquet(path).count() == 100


def test_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(100).withColumn("state", F.concat(F.lit("s"), F.col("id") % 4)), path, ["state"])
    df = readers.read_partition(spark, path, state="s1")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state" in plan and df.count() == 25


def test_batch_id_is_stable():
    assert bronze.batch_id("orders", "2025-01-15") == bronze.batch_id("orders", "2025-01-15")
    assert bronze.batch_id("orders", "2025-01-15") != bronze.batch_id("orders", "2025-01-16")


def commerce_files(folder):
    folder.mkdir()
    customers = ["customer_id,email,first_name,last_name,city,state,signup_date,is_active"]
    customers += [f"CUST-{i:05d},u{i}@x.com, First{i},Last{i},City,tx,2024-01-{i % 28 + 1:02d},true" for i in range(1, 101)]
    customers += [",invalid,,,,,not-a-date,maybe", customers[1]]
    orders = ["order_id,customer_id,order_date,status,total_amount,payment_method"]
    items = ["order_item_id,order_id,product_id,quantity,unit_price,line_total"]
    states = ["completed", "shipped", "processing", "cancelled", "refunded"]
    for i in range(1, 301):
        orders.append(f"ORD-{i:06d},CUST-{i % 90 + 1:05d},2024-{i % 12 + 1:02d}-{i % 28 + 1:02d},{states[i % 5]},{i}.50,card")
        items.append(f"ITEM-{i:06d},ORD-{i:06d},PROD-{i % 20:04d},{i % 3 + 1},{i}.00,{i * (i % 3 + 1)}.00")
    products = ["product_id,name,category,price,cost"] + [f"PROD-{i:04d},P{i},C{i % 4},{i + 1}.00,1.00" for i in range(20)]
    specs = []
    for name, lines in (("customers", customers), ("orders", orders), ("order_items", items), ("products", products)):
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
        specs.append(SourceSpec(name, str(folder / f"{name}.csv"), "csv"))
    return specs


def test_commerce_pipeline(spark, tmp_path):
    specs, root = commerce_files(tmp_path / "in"), str(tmp_path / "out")
    runs = [pipelines.run_commerce(spark, specs, root, "2025-01-15", "2025-01-15") for _ in range(2)]
    first, second = ({(r["layer"], r["table_name"]): r["rows"] for r in run.collect()} for run in runs)
    assert first == second, "a second run of the same day changes nothing"
    assert first["silver", "customers"] == 100 and first["quarantine", "customers"] == 1
    assert spark.read.parquet(f"{root}/bronze/customers").count() == 102
    gold = spark.read.parquet(f"{root}/gold/customer_360")
    assert gold.count() == 100
    idle = gold.where("total_orders = 0")
    assert idle.count() > 0 and idle.where("rfm_segment <> 'No Orders' or ltv_tier <> 'bronze' or total_revenue <> 0").count() == 0
    scored = gold.where("total_orders > 0")
    assert scored.where("rfm_score not between 111 and 555").count() == 0
    statuses = spark.read.parquet(f"{root}/quality/gold_customer_360").select("status").distinct().collect()
    assert [s["status"] for s in statuses] == ["PASS"]


def court_files(folder):
    folder.mkdir()
    n = range(1, 61)
    flat = {
        "TX": ("|", "cause_nbr|case_number|file_date|case_type|case_status|plaintiff_name|defendant_name|judge|court_number|amount|cause_of_action",
               [f"C{i}|TX-{i}|01/{i % 28 + 1:02d}/2024|CV|PEND|ACME LLC|JOHN DOE|j. smith|1|$1,{i:03d}.00|Debt" for i in n]
               + ["|||", "||INVALID|CV|PEND|A|B|j|1|not_a_number|x"]),
        "NY": (",", "index_number,action_type,date_filed,status,county,plaintiff,defendant,judge_assigned,relief_sought,disposition_date",
               [f"NY-{i},Tort,02/{i % 28 + 1:02d}/2024,Settled,Kings,Ann Lee,BIG BANK,j,{i}.00,03/01/2024" for i in n]),
        "FL": (",", "case_id,case_type,filed_dt,case_status,division,pty_plaintiff,pty_defendant,judge_name,amt_claimed,disp_dt,disp_type",
               [f"FL-{i},CF,202403{i % 28 + 1:02d},CLOSED,D1,P{i},Q{i},j,0.00,20240501,Dismissed" for i in n]),
        "IL": (",", "case_number,case_category,filing_date,case_status,court_room,plaintiff_info,defendant_info,presiding_judge,demand_amount",
               [f"IL-{i},CH,{i % 28 + 1:02d}-Apr-2024,Open,1,P{i},Q{i},j,{i}" for i in n]),
        "OH": ("\t", "case_num\ttype_cd\tfile_dt\tstatus_cd\tplaintiff_nm\tdefendant_nm\tjudge_nm\tclaim_amt\tdisp_dt",
               [f"OH-{i}\tFED\t5/{i % 28 + 1}/2024\tTERMINATED\tP{i}\tQ{i}\tj\t{i}\t2/30/2024" for i in n]),
    }
    specs = []
    for state, (sep, header, lines) in flat.items():
        (folder / f"{state}.csv").write_text("\n".join([header, *lines]) + "\n")
        specs.append(SourceSpec(state, str(folder / f"{state}.csv"), "csv", table="suits", options={"sep": sep}))
    cases = [{
        "docket_id": f"CA-{i}", "case_type_code": "UD", "filing_date": f"2024-06-{i % 28 + 1:02d}", "status": "Active",
        "court_division": "Civil", "amount_controversy": i * 1.5,
        "parties": {"plaintiffs": [{"name": "Acme Inc", "attorney": "A. Ttorney"}],
                    "defendants": [{"name": f"D{i}"}, {"name": "Second Party"}]},
        "disposition": {"type": "Judgment", "date": "2024-09-01"},
    } for i in n]
    (folder / "CA.json").write_text(json.dumps(cases, indent=1))
    specs.append(SourceSpec("CA", str(folder / "CA.json"), "json", table="suits"))
    lines = [f"1:{i},Fed Plaintiff v. F{i},cause,190,2024-07-{i % 28 + 1:02d},,judge,SD NY" for i in n]
    (folder / "FED.csv").write_text("\n".join(["docket_number,case_name,cause_code,nature_of_suit,date_filed,date_terminated,judge,district", *lines]) + "\n")
    specs.append(SourceSpec("FED", str(folder / "FED.csv"), "csv", table="suits"))
    return specs


def test_records_pipeline(spark, tmp_path):
    specs, root = court_files(tmp_path / "in"), str(tmp_path / "out")
    rows = {(r["layer"], r["table_name"]): r["rows"]
            for r in pipelines.run_records(spark, specs, root, "2025-01-15", "2025-01-15").collect()}
    assert rows["silver", "suits"] == 420 and rows["quarantine", "suits"] == 2
    suits = spark.read.parquet(f"{root}/silver/suits")
    assert {r[0] for r in suits.select("state_code").distinct().collect()} == {"TX", "CA", "NY", "FL", "IL", "OH", "FED"}
    assert suits.where("state_code = 'FL' and amount_demanded is not null").count() == 0, "0.00 means no amount"
    assert suits.where("array_contains(_unread, 'disposition_date')").select("state_code").distinct().collect()[0][0] == "OH"
    parties = spark.read.parquet(f"{root}/silver/parties")
    assert parties.where("suit_id like 'CA%' and party_type = 'DEFENDANT'").count() == 120
    assert parties.where("sequence = 2").select("party_name").distinct().collect()[0][0] == "Second Party"
    best = spark.read.parquet(f"{root}/gold/suit_best_view")
    assert best.count() == 420 and best.where("days_open < 0 or plaintiff_count < 1").count() == 0
    frequent = spark.read.parquet(f"{root}/gold/suit_party_best_view").where("party_name = 'ACME LLC'")
    assert frequent.where("is_frequent_litigant and total_suits_as_plaintiff = 60").count() == 60


def test_missing_court_stops_the_run(spark, tmp_path):
    specs = court_files(tmp_path / "in")
    specs[0] = SourceSpec("TX", str(tmp_path / "absent.csv"), "csv", table="suits")
    with pytest.raises(RuntimeError, match="TX"):
        pipelines.run_records(spark, specs, str(tmp_path / "out"), "2025-01-15", "2025-01-15")


def test_gate_stops_the_run(spark, tmp_path):
    specs = commerce_files(tmp_path / "in")
    (tmp_path / "in" / "orders.csv").write_text(
        "order_id,customer_id,order_date,status,total_amount,payment_method\n" + "ORD-1,CUST-00001,2024-01-01,lost,1.00,card\n" * 5)
    with pytest.raises(GateFailed):
        pipelines.run_commerce(spark, specs, str(tmp_path / "out"), "2025-01-15", "2025-01-15")


def test_repeated_stream_batch_leaves_no_duplicates(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(10)
    for _ in range(2):
        jobs._put(df, path, 0)
    jobs._put(df, path, 1)
    assert spark.read.parquet(path).count() == 20


def test_late_rows_of_every_batch(spark, tmp_path):
    """More batches than a query remembers."""
    for i in range(6):
        spark.sql(f"SELECT timestamp '2024-01-{20 - i:02d} 00:00:00' AS ts, 1 AS value").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        stream = jobs.read_stream(spark, str(tmp_path / "in"), ["ts"], maxFilesPerTrigger=1)
        totals = jobs.windowed_totals(stream, "ts", "value", [], "1 day", None, "1 hour")
        late = jobs.late_rows(spark, lambda: jobs.append_closed(totals, str(tmp_path / "out"), "late"))
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert {b for b, _, _ in late} >= set(range(6)) and sum(r for _, r, _ in late) == 6
    assert sum(dropped for _, _, dropped in late) > 0


def test_federal_captions(spark):
    from lamella.plans import records

    rows = [("1", "Ann Lee v. Big Bank", "190", "2024-05-01"), ("2", "JOHN DOE VS. ACME LLC", "440", ""), ("3", "In re Sunrise", "999", None),
            ("4", "A V. Smith vs Ray v. Coe", None, None), ("5", None, "870", None), ("6", " v. Someone", "230", "")]
    feed = spark.createDataFrame(rows, "docket_number string, case_name string, nature_of_suit string, date_terminated string").selectExpr(
        "*", "'2024-01-01' AS date_filed", "'judge' AS judge", "'c' AS cause_code", "'SD NY' AS district")
    got = {r["case_number"]: (r["plaintiff_name"], r["defendant_name"], r["case_type"], r["case_status"])
           for r in records.canonical_suits(spark, {"FED": feed}, []).collect()}
    assert got == {
        "1": ("Ann Lee", "Big Bank", "CONTRACT", "DISPOSED"), "2": ("JOHN DOE", "ACME LLC", "CIVIL", "OPEN"),
        "3": ("In re Sunrise", None, "OTHER", "OPEN"), "4": ("A V. Smith", "Ray v. Coe", "OTHER", "OPEN"),
        "5": (None, None, "TAX", "OPEN"), "6": (None, "Someone", "EVICTION", "OPEN"),
    }
