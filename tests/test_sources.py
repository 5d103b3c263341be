"""Input formats on small files."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException

from checks import adapter as A
from loanshift.operators import clean
from loanshift.sources import economics, layout, performance, series, tables

LAYOUT = "﻿ID,Name,Abbreviation,Indicator,dType\n0,Pool ,Pool ,0,string\n1,Loan,Loan_ID ,1,string\n2,Period,Act_Period,1,string\n3,Rate,Orig_Rate,1,float64\n4,Deal,Deal,0,string\n"


def write(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_layout_and_performance_files(spark, tmp_path):
    spec = layout.read_layout(spark, write(tmp_path, "layout.csv", LAYOUT))
    assert spec.fields.names == ["Pool", "Loan_ID", "Act_Period", "Orig_Rate", "Deal"]
    assert spec.kept == ["Loan_ID", "Act_Period", "Orig_Rate"]
    write(tmp_path, "2003Q4.csv", "p|001|012004|5.5|d\np|002|112004||d\n")
    write(tmp_path, "2004Q1.csv", "p|003|22004||d\n")
    listed = write(tmp_path, "list.csv", "file\n2003Q4.csv\n2004Q1.csv\n")
    rows = clean.parse_dates(performance.read_listed(spark, str(tmp_path), listed, spec)).orderBy("Loan_ID").collect()
    assert [tuple(r) for r in rows] == [
        (dt.date(2003, 10, 1), "001", dt.date(2004, 1, 1), 5.5),
        (dt.date(2003, 10, 1), "002", dt.date(2004, 11, 1), None),
        (dt.date(2004, 1, 1), "003", dt.date(2004, 2, 1), None),
    ]


def test_rates_take_the_last_day_and_skip_blank_rows(spark, tmp_path):
    text = "a,b,c\n5/1/2010,5.0,4.0\n,,\n28/1/2010,5.2,4.1\n1/2/2010,5.3,\n"
    rows = economics.read_rates(spark, write(tmp_path, "r.csv", text)).orderBy("Year", "Month").collect()
    assert [tuple(r) for r in rows] == [(2010, 1, 5.2, 4.1), (2010, 2, 5.3, None)]


def test_unemployment_series(spark, tmp_path):
    text = "y,m,v,s\n2020,01,4.5,LAUMT3716740000003\n2020,02,-,LAUMT3716740000003\n"
    rows = economics.read_unemployment_msa(spark, write(tmp_path, "u.csv", text)).orderBy("Month").collect()
    assert [tuple(r) for r in rows] == [(2020, 1, 4.5, "16740"), (2020, 2, None, "16740")]


def test_state_unemployment_with_geocode(spark, tmp_path):
    head = ",".join(f"c{i}" for i in range(10))
    lines = ["1,x,x,\"Raleigh, NC\",x,x,x,x,North Carolina,37", "2,x,x,\"Cary, NC\",x,x,x,x,North Carolina,37",
             "3,x,x,\"Charlotte, NC-SC\",x,x,x,x,North Carolina,37"]
    geo = write(tmp_path, "g.csv", "\n".join([head, *lines]) + "\n")
    text = "y,m,v,s\n2020,1,4.5,LASST370000000000003\n"
    rows = economics.read_unemployment_state(spark, write(tmp_path, "s.csv", text), geo).collect()
    assert [tuple(r) for r in rows] == [(2020, 1, 4.5, 37, "NC")]


def test_combined_unemployment(spark, tmp_path):
    text = "f,d,u,s\n37,3/1/2010,9.1,NC\n37,4/1/2010,-,NC\n"
    rows = economics.read_unemployment(spark, write(tmp_path, "c.csv", text)).collect()
    assert [tuple(r) for r in rows] == [("37", 9.1, "NC", 2010, 3)]


def test_small_dimensions(spark, tmp_path):
    judicial = economics.read_judicial(spark, write(tmp_path, "j.csv", "a,b,c\nNC,North Carolina,0\n"))
    assert [tuple(r) for r in judicial.collect()] == [("NC", 0)]
    spread = economics.read_spread(spark, write(tmp_path, "m.csv", "a,b\n1/3/2010,2.8\n"))
    assert [tuple(r) for r in spread.collect()] == [(2010, 3, 2.8)]
    index = economics.read_hpi_zip(spark, write(tmp_path, "h.csv", "a,b,c,d\n275,2010,1,101.5\n"))
    assert [tuple(r) for r in index.collect()] == [("275", 2010, 1, 101.5)]
    areas = economics.read_area_codes(spark, write(tmp_path, "a.txt", "t\tc\tn\nA\tST01\tx\nB\tMT01\ty\nF\tCN01\tz\n"))
    assert [[r.code for r in a.collect()] for a in areas] == [["ST01"], ["MT01"]]


def test_series_json(spark, tmp_path):
    body = {"Results": {"series": [
        {"seriesID": "LAU1", "data": [{"year": "2020", "period": "M01", "value": "4.5"}]}, {"seriesID": "LAU2", "data": []},
    ]}}
    write(tmp_path, "r.json", json.dumps(body, indent=1))
    assert [tuple(r) for r in series.read_series_json(spark, str(tmp_path)).collect()] == [("2020", "01", "4.5", "LAU1")]
    empty = spark.createDataFrame([(json.dumps({"Results": {}}),)], "json string")
    assert series.parse_series_json(empty).count() == 0


def test_transition_table_prunes_partitions(spark, sf, tmp_path):
    path = str(tmp_path / "t")
    moves = A.transitions(spark, sf)
    tables.write_transitions(moves, path)
    part = tables.read_transitions(spark, path, state=2)
    assert part.count() == moves.where("Current_Status = 2").count()
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Current_Status" in plan
    assert tables.combine_all(spark, path).count() == clean.complete_cases(moves).count()


def test_cluster_needs_a_shared_folder(monkeypatch):
    from loanshift import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_malformed_records_are_an_error_or_listed(spark, tmp_path):
    spec = layout.read_layout(spark, write(tmp_path, "layout.csv", LAYOUT))
    folder = tmp_path / "raw"
    folder.mkdir()
    write(folder, "2004Q1.csv", "p|001|012004|5.5|d\np|002|012004|oops|d\np|003|012004\np|004|012004||d|x|y\np|005|022004| |d\n")
    with pytest.raises(PySparkException, match="malformed record: p"):
        performance.read_performance(spark, str(folder), spec).select("Loan_ID").collect()
    rows, rejected = performance.split_performance(spark, str(folder), spec)
    assert [r.Loan_ID for r in rows.select("Loan_ID").collect()] == ["001"] and rows.count() == 1
    assert sorted((r.file, r.record.split("|")[1], r.reasons) for r in rejected.collect()) == [
        ("2004Q1.csv", "002", ["Orig_Rate: oops"]), ("2004Q1.csv", "003", ["3 fields for 5"]), ("2004Q1.csv", "004", ["7 fields for 5"]),
        ("2004Q1.csv", "005", ["Orig_Rate:  "]),
    ]


def test_series_with_text_for_a_number_are_an_error(spark, tmp_path):
    path = write(tmp_path, "h.csv", "a,b,c,d\n27601,2004,1,100.5\n27601,2004,2,\n27601,n.a.,3,1\n")
    with pytest.raises(PySparkException, match="not a number in Year: n.a."):
        economics.read_hpi_zip(spark, path).collect()
    path = write(tmp_path, "ok.csv", "a,b,c,d\n27601,2004,1,100.5\n27601,2004,2, \n")
    assert [r.HPI for r in economics.read_hpi_zip(spark, path).collect()] == [100.5, None]
