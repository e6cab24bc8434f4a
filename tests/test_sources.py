"""Landing, workbooks, layers, and the whole batch from files to Gold."""

import zipfile

import pytest

from wardflow.operators.audit import delivered_files, observed_gate
from wardflow.plans.silver import TABLES, judge_table
from wardflow.sources.feeds import FEEDS
from wardflow.sources.landing import land, list_files, profile_headers, read_feed
from wardflow.sources.layers import Layers


def csv(root, feed, batch, *lines, header=None):
    folder = root / feed.folder
    folder.mkdir(parents=True, exist_ok=True)
    text = [header or ",".join(feed.columns), *lines]
    (folder / f"{feed.table}_{batch}.csv").write_text("\n".join(text) + "\n")


def payer(number, share="0.2"):
    return f"PAY{number},Payer {number}, Commercial ,CI,{share},30"


def test_landing_is_idempotent_and_keeps_strings(spark, tmp_path, rows):
    feed, layers = FEEDS["payer"], Layers(spark, str(tmp_path / "lake"))
    csv(tmp_path, feed, "20260101", payer("001"), payer("002"))
    land(spark, str(tmp_path), feed, layers)
    land(spark, str(tmp_path), feed, layers)
    assert layers.read("bronze_payer").count() == 2
    csv(tmp_path, feed, "20260108", payer("001", "0.3"))
    land(spark, str(tmp_path), feed, layers)
    bronze = layers.read("bronze_payer")
    assert rows(bronze, "payer_id", "_batch_id") == [("PAY001", "20260101"), ("PAY001", "20260108"), ("PAY002", "20260101")]
    assert all(t == "string" for c, t in bronze.dtypes if c != "_ingested_at")


def test_wrong_header_fails_instead_of_shifting_columns(spark, tmp_path):
    feed = FEEDS["payer"]
    swapped = ",".join(["payer_name", "payer_id", *feed.columns[2:]])
    csv(tmp_path, feed, "20260101", payer("001"), header=swapped)
    with pytest.raises(Exception, match="(?i)header"):
        read_feed(spark, str(tmp_path), feed).collect()
    assert profile_headers(spark, str(tmp_path), feed).first()["matches"] is False


def test_empty_file_is_delivered(spark, tmp_path, rows):
    feed = FEEDS["payer"]
    csv(tmp_path, feed, "20260101", payer("001"))
    csv(tmp_path, feed, "20260108")
    files = delivered_files(list_files(spark, str(tmp_path), feed), read_feed(spark, str(tmp_path), feed))
    assert rows(files, "batch_id", "rows") == [("20260101", 1), ("20260108", 0)]


def workbook(path, sheet, table, shared=()):
    def cell(column, row, value):
        if value is None:
            return ""
        if isinstance(value, int):
            return f'<c r="{column}{row}"><v>{value}</v></c>'
        return f'<c r="{column}{row}" t="inlineStr"><is><t>{value}</t></is></c>'
    body = "".join(f'<row r="{i}">' + "".join(cell(chr(65 + j), i, v) for j, v in enumerate(values)) + "</row>" for i, values in table)
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook {space} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {space}><sheetData>{body}</sheetData></worksheet>")


def test_roster_workbook(spark, tmp_path, rows):
    folder = tmp_path / "sharepoint/staff_schedules"
    folder.mkdir(parents=True)
    header = ["Facility ID", "Unit Code", "Work Date", "Shift Start", "Staff ID", "Actual Hours", "Census"]
    table = [(1, ["Roster of the week"]), (3, ["confidential"]), (5, header), (6, ["030301", "MICU", "2026-08-05", "07:00", "STF1", None, 12]),
             (7, ["030301", "MICU", "08/05/2026", "07:00", "STF1", "8", 12]), (8, [None, None]), (9, [])]
    workbook(folder / "staff_schedule_030301_20260810.xlsx", "Roster", table)
    workbook(folder / "staff_schedule_050201_20260810.xlsx", "Other", table)
    feed = FEEDS["staff_schedules"]
    got = read_feed(spark, str(tmp_path), feed)
    assert rows(got, "facility_id", "work_date", "actual_hours", "census", "_batch_id") == [
        ("030301", "08/05/2026", "8", "12", "20260810"), ("030301", "2026-08-05", None, "12", "20260810")]
    base = TABLES["staff_schedules"].base(got)
    assert base.count() == 1, "one shift written in two date formats"


def test_silver_rules_name_every_fault(spark, tmp_path, rows):
    feed = FEEDS["payer"]
    csv(tmp_path, feed, "20260101", payer("001"), payer("002", "1.5"), payer("003", "n/a"))
    bronze = read_feed(spark, str(tmp_path), feed)
    judged = judge_table("payer", TABLES["payer"].base(bronze), lambda *_: None, bronze)
    assert rows(judged, "payer_id", "payer_type_folded", "_dq_issues", "_dq_passed") == [
        ("PAY001", "commercial", "", True), ("PAY002", "commercial", "share out of 0-1 range", False), ("PAY003", "commercial", "", True)]
    passed, seen = observed_gate(judged, "gate")
    assert passed.count() == 2 and seen.get == {"rows_in": 3, "rows_out": 2}


def test_catalog_layer(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lake_test LOCATION '{tmp_path}/wh'")
    layers = Layers(spark, schema="lake_test")
    layers.reset(["t"])
    layers.replace_partitions("t", spark.createDataFrame([("a", "0012")], "v string, p string"), ["p"])
    layers.replace_partitions("t", spark.createDataFrame([("b", "0013")], "v string, p string"), ["p"])
    layers.replace_partitions("t", spark.createDataFrame([("c", "0013")], "v string, p string"), ["p"])
    assert sorted(tuple(r) for r in layers.read("t").collect()) == [("a", "0012"), ("c", "0013")]
    layers.reset(["t"])
    assert not layers.exists("t")


def test_second_landing_opens_no_old_file(spark, tmp_path, rows):
    """Old files are made unreadable: a landing that opened them would fail."""
    feed, layers = FEEDS["payer"], Layers(spark, str(tmp_path / "lake"))
    csv(tmp_path, feed, "20260101", payer("001"))
    land(spark, str(tmp_path), feed, layers)
    before = sorted(str(p) for p in (tmp_path / "lake" / "bronze_payer").rglob("*.parquet"))
    csv(tmp_path, feed, "20260101", "spoiled", header="not,the,declared,header")
    csv(tmp_path, feed, "20260108", payer("002"))
    csv(tmp_path, feed, "20260115")  # delivered without rows: in the ledger, not in the table
    land(spark, str(tmp_path), feed, layers)
    land(spark, str(tmp_path), feed, layers)
    assert rows(layers.read("bronze_payer"), "payer_id", "_batch_id") == [("PAY001", "20260101"), ("PAY002", "20260108")]
    assert rows(layers.read("landed_payer"), "batch_id") == [("20260101",), ("20260108",), ("20260115",)]
    assert set(before) <= {str(p) for p in (tmp_path / "lake" / "bronze_payer").rglob("*.parquet")}


def test_second_landing_opens_no_old_workbook(spark, tmp_path, rows):
    feed, layers = next(f for f in FEEDS.values() if f.workbook), Layers(spark, str(tmp_path / "lake"))
    (tmp_path / feed.folder).mkdir(parents=True)
    def book(batch, facility):
        workbook(tmp_path / feed.folder / f"{feed.table}_{batch}.xlsx", "Roster", [(1, ["Facility ID"]), (2, [facility])])
    book("20260101", "F1")
    land(spark, str(tmp_path), feed, layers)
    (tmp_path / feed.folder / f"{feed.table}_20260101.xlsx").write_bytes(b"no workbook any more")
    book("20260108", "F2")
    land(spark, str(tmp_path), feed, layers)
    assert rows(layers.read(f"bronze_{feed.table}"), "facility_id", "_batch_id") == [("F1", "20260101"), ("F2", "20260108")]


def test_landing_after_a_kill_lands_nothing_twice(spark, tmp_path, monkeypatch, rows):
    feed, layers = FEEDS["payer"], Layers(spark, str(tmp_path / "lake"))
    csv(tmp_path, feed, "20260101", payer("001"))
    def killed(*_):
        raise RuntimeError("killed")
    with monkeypatch.context() as patch:
        patch.setattr(layers, "append", killed)
        with pytest.raises(RuntimeError):
            land(spark, str(tmp_path), feed, layers)
    assert layers.read("bronze_payer").count() == 1
    land(spark, str(tmp_path), feed, layers)
    folder = tmp_path / feed.folder  # a second file of a landed batch
    (folder / "late_20260101.csv").write_text("\n".join([",".join(feed.columns), payer("009")]) + "\n")
    land(spark, str(tmp_path), feed, layers)
    assert rows(layers.read("bronze_payer"), "payer_id", "_batch_id") == [("PAY001", "20260101"), ("PAY009", "20260101")]
    assert layers.read("landed_payer").count() == 2
