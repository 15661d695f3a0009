import csv
import random

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from codeloom import schemas
from codeloom.sources import delimited, ragged, tables

HEADER = ["A", "B", "C", "D", "E", "F", "D1", "D2", "T1", "T2"]


def sequential_repair(lines):
    """The repair rule, one line at a time."""
    out, rejected = [], 0
    for fields in csv.reader(lines):
        if len(fields) < 10:
            rejected += 1
        else:
            middle = fields[6:len(fields) - 2]
            out.append((*fields[:6], ",".join(middle[:-1]), middle[-1], *fields[-2:], len(fields) > 10))
    return out, rejected


def test_ragged_lines_equal_a_sequential_parse(spark):
    rng = random.Random(3)
    lines = []
    for _ in range(300):
        words = ["THIS", "THAT", 'q"uote', "x y", "", '"quoted, comma"', '"dou""ble"']
        fields = [rng.choice(words) for _ in range(rng.choice([9, 10, 10, 10, 11, 12, 14]))]
        lines.append(",".join(fields))
    want, rejected = sequential_repair(lines)
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    got, rejects = ragged.repair(df, HEADER)
    assert rows(got) == sorted(want, key=repr)
    assert rejects.count() == rejected
    counts = ragged.repair_counts(df, 10).first()
    assert (counts["rejected"], counts["repaired"]) == (rejected, sum(w[-1] for w in want))


def test_long_quoted_fields_are_read_whole(spark):
    body = 'x""y' * 30_000
    df = spark.createDataFrame([('1,2,3,4,5,6,"' + body + '",d2,t1,t2',)], "value string")
    got, _ = ragged.repair(df, HEADER)
    assert got.first()["D1"] == 'x"y' * 30_000


def test_ragged_files(spark, tmp_path):
    for name, body in (
        ("a.csv", b"A ,B,C,D,E,F,D1,D2,T1,T2\r\n1,2,3,4,5,6,THIS, THAT,d2,t1,t2\r\n1,2\n"),
        ("b.csv", b"A ,B,C,D,E,F,D1,D2,T1,T2\n1,2,3,4,5,6,nul\x00byte \xff,d2,t1,t2\n"),
    ):
        (tmp_path / name).write_bytes(body)
    got, rejects = ragged.read_ragged(spark, f"{tmp_path}/*.csv")
    assert rows(got, "A", "D1", "D2", "T2", "_repaired") == [
        ("1", "THIS, THAT", "d2", "t2", True), ("1", "nulbyte �", "d2", "t2", False),
    ]
    assert rows(rejects) == [("1,2", 2)]


def test_headed_files(spark, tmp_path):
    (tmp_path / "x1.csv").write_bytes(" Code ,Name\n01,caf\xe9\n02,\"a, \"\"b\"\"\"\n".encode("latin-1"))
    (tmp_path / "x2.csv").write_bytes(b" Code ,Name\n003,N/A\n")
    got = delimited.read_headed(spark, f"{tmp_path}/x*.csv")
    assert got.columns == ["Code", "Name"]
    assert rows(got) == [("003", None), ("01", "café"), ("02", 'a, "b"')]
    assert delimited.read_headed(spark, f"{tmp_path}/x2.csv", ["Name", "Code"]).columns == ["Name", "Code"]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        delimited.read_headed(spark, f"{tmp_path}/none*.csv").collect()


def test_positional_sheets_keep_their_order(spark, tmp_path):
    (tmp_path / "s.csv").write_text("U1,x\n\"multi\nline\",y\nNA,z\n")
    got = delimited.read_positional(spark, f"{tmp_path}/s.csv", 3, multiline=True).orderBy("rn").collect()
    assert [(r["c0"], r["c1"], r["c2"]) for r in got] == [("U1", "x", None), ("multi\nline", "y", None), (None, "z", None)]
    assert got[0]["sheet"].endswith("s.csv")


def test_tables(spark, tmp_path):
    db = "codeloom_test"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}/db'")
    tables.create_schema(spark, db)
    name = f"{db}.ground_truth"
    tables.create_table(spark, name, schemas.GROUND_TRUTH)
    assert tables.load(spark, name).count() == 0
    df = spark.createDataFrame([("1", "nan", "None", "", "NaT", "x", None)], schemas.GROUND_TRUTH)
    tables.append(df, name)
    assert rows(tables.load(spark, name)) == [("1", None, None, None, None, "x", None)]
    tables.save(df.limit(0), f"{db}.copy", replace_schema=True)
    assert tables.load(spark, f"{db}.copy").columns == schemas.GROUND_TRUTH.names
    tables.export_csv(df.select("transaction_code", "gt_L4"), f"{tmp_path}/out")
    assert rows(spark.read.option("header", True).csv(f"{tmp_path}/out")) == [("1", "x")]
    assert tables.empty(spark, schemas.PRODUCT_SUGGESTIONS).count() == 0
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_observed_counts(spark):
    from codeloom.operators.audits import observed

    df, watch = observed(spark.range(10), "filter", before=F.count("*"), kept=F.count_if(F.col("id") > 6))
    assert df.filter("id > 6").count() == 3
    assert watch.get == {"before": 10, "kept": 3}


def test_files_are_stacked_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\nx,1\n")
    (tmp_path / "b.csv").write_text("b, a \n2,y\n")
    (tmp_path / "c.csv").write_text("a,c\nz,3\n")
    (tmp_path / "d.csv").write_text("")
    assert rows(delimited.read_headed(spark, f"{tmp_path}/*.csv")) == sorted([("x", "1", None), ("y", "2", None), ("z", None, "3")])
    assert rows(delimited.read_headed(spark, f"{tmp_path}/*.csv", ["c", "a"])) == sorted([(None, "x"), (None, "y"), ("3", "z")], key=repr)
    with pytest.raises(ValueError, match="missing"):
        delimited.read_headed(spark, f"{tmp_path}/*.csv", ["a", "missing"])


def test_ragged_records_over_several_lines(spark, tmp_path):
    body = ",".join(HEADER) + '\r\n1,2,3,4,5,6,"one\ntwo, ""three""\n",d2,t1,t2\n\n1,2,3,4,5,6,in " the middle,x,d2,t1,t2\nshort,"a\nb"\n'
    (tmp_path / "a.csv").write_text(body, newline="")
    got, rejects = ragged.read_ragged(spark, f"{tmp_path}/a.csv", multiline=True)
    assert rows(got, "D1", "D2", "T2") == sorted([('one\ntwo, "three"\n', "d2", "t2"), ('in " the middle,x', "d2", "t2")])
    assert rows(rejects) == [('short,"a\nb"', 2)]
