import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from codeloom.sources import delimited, ragged, records


@pytest.fixture
def split_size(spark):
    """Sets the size of the byte ranges that files are split into."""
    keys = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"

    def put(n):
        for key in keys:
            spark.conf.set(key, str(n))

    yield put
    for key in keys:
        spark.conf.unset(key)


def found(spark, path, **options):
    rows = records.read_records(spark, path, **options).withColumn("f", ragged.split_line(ragged.clean_line("value"))).collect()
    return [list(r["f"]) for r in sorted(rows, key=lambda r: (r["file"], r["range"] + r["line"]))]


def plain(text):
    return [r for r in csv.reader(io.StringIO(text, newline="")) if r and any(c.strip() for c in r)]


csv.field_size_limit(10_000_000)
BODY = 'a\n"2\n, ""q"\n"",i"n\n\né\n'


def test_a_range_boundary_at_every_byte(spark, tmp_path, split_size):
    (tmp_path / "a.csv").write_bytes(BODY.encode())
    split_size(1)
    assert records.lines_of(spark, str(tmp_path / "a.csv")).rdd.getNumPartitions() == len(BODY.encode())
    assert found(spark, str(tmp_path / "a.csv")) == plain(BODY)


@pytest.mark.parametrize("size", [5, 11, 10_000])
def test_other_range_sizes(spark, tmp_path, split_size, size):
    (tmp_path / "a.csv").write_bytes(BODY.encode())
    (tmp_path / "b.csv").write_bytes(BODY.replace("\n", "\r\n").encode() + b'open,"never closed\nto the end')
    split_size(size)
    want = plain(BODY) + plain(BODY.replace("\n", "\r\n"))
    got = found(spark, str(tmp_path / "*.csv"), broadcast_ranges=0 if size == 5 else records.BROADCAST_RANGES)
    assert got[:-1] == want and ",".join(got[-1]) == 'open,"never closed\nto the end'


def random_text(seed, n):
    rng = random.Random(seed)
    words = ["x", "y z", "", "it's", 'mid"dle', "é" * 5]
    out = io.StringIO(newline="")
    for _ in range(n):
        fields = [rng.choice(words) if rng.random() < 0.6 else '"' + rng.choice(["a\nb", "\n\n", 'q""q', "c,d", '""\n""', "line\r\n"]) + '"' for _ in range(3)]
        out.write(",".join(["id", *fields]) + "\n")
    return out.getvalue()


@pytest.mark.parametrize("seed", range(2))
def test_random_files_against_a_sequential_reader(spark, tmp_path, split_size, seed):
    text = random_text(seed, 400)
    (tmp_path / "r.csv").write_bytes(text.encode())
    split_size(397 + 150 * seed)
    assert found(spark, str(tmp_path / "r.csv")) == plain(text)


def test_exits_of_single_lines(spark):
    def run(line, state):
        for ch in line:
            if state == "field start":
                state = "quoted" if ch == '"' else "field start" if ch == "," else "plain"
            elif state == "plain":
                state = "field start" if ch == "," else "plain"
            elif state == "quoted":
                state = "quote" if ch == '"' else "quoted"
            else:
                state = "quoted" if ch == '"' else "field start" if ch == "," else "plain"
        return int(state == "quoted")

    rng = random.Random(1)
    lines = ["".join(rng.choice('"",,ab ') for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    outside, inside = records.exits(F.col("s"))
    for r in spark.createDataFrame([(s,) for s in lines], "s string").select("s", outside.alias("o"), inside.alias("i")).collect():
        assert (r["o"], r["i"]) == (run(r["s"], "field start"), run(r["s"], "quoted")), r["s"]


def test_very_long_lines_and_fields_over_many_ranges(spark, tmp_path, split_size):
    body = 'k,"' + ("line \n" * 30_000) + '"\n' + "w" * 200_000 + ',"' + "v" * 200_000 + '"\n'
    (tmp_path / "l.csv").write_bytes(body.encode())
    split_size(50_000)
    assert found(spark, str(tmp_path / "l.csv")) == plain(body)


def test_empty_and_blank_files(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes(b"")
    (tmp_path / "b.csv").write_bytes(b"\n \n\r\n")
    assert found(spark, str(tmp_path / "*.csv")) == []


def test_ragged_and_positional_readers_split_large_files(spark, tmp_path, split_size):
    header = "A,B,C,D,E,F,D1,D2,T1,T2"
    (tmp_path / "a.csv").write_text(header + "\n" + "".join(f'{i},2,3,4,5,6,"one\ntwo {i}",d2,t1,t2\n' for i in range(300)))
    split_size(1500)
    rows, rejects = ragged.read_ragged(spark, str(tmp_path / "a.csv"), multiline=True)
    assert sorted((int(r["A"]), r["D1"]) for r in rows.collect()) == [(i, f"one\ntwo {i}") for i in range(300)] and rejects.count() == 0
    sheet = delimited.read_positional(spark, str(tmp_path / "a.csv"), 8, multiline=True).orderBy("rn").collect()
    assert [(r["c0"], r["c6"]) for r in sheet] == [("A", "D1"), *((str(i), f"one\ntwo {i}") for i in range(300))]
