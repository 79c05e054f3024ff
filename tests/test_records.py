"""CSV records over small splits against the standard library."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from gaugeloom.sources import pages, records


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "1"}
    old = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def plain_rows(text):
    """Rows of the standard library; a blank line is one empty cell."""
    return [row or [""] for row in csv.reader(io.StringIO(text, newline=""))]


def read(spark, folder):
    rows = records.csv_records(spark, str(folder)).withColumn("cells", records.split_cells(F.col("record")))
    out = {}
    for row in rows.orderBy("path", "record_no").collect():
        out.setdefault(row.path, []).append((row.record_no, row.cells))
    return out


def test_records_equal_the_library(spark, tmp_path, small_splits):
    rng = random.Random(12)
    texts = {
        "a.csv": 'x,y\n"one\ntwo\n\nthree",1\n"a ""b"" c","d,e"\nplain "quotes", in cells\n"closed"after,z\n',
        "b.CSV": "".join('"%s\n%s",%d\n' % ("k" * i, 'say ""hi""\n' * (i % 4), i) for i in range(40)),
        "c/d+ 1.csv": "﻿a,b\r\n1,\"x\r\ny\"\r\n,\r\n",
        "open.csv": 'a,b\n1,"never closed\nmore, of it\n',
        "none.csv": "",
        "long.csv": '"' + 'ab""c,\n' * 3000 + '",end\n' + "x," * 20000 + "z\n",
    }
    for i in range(12):
        texts[f"r{i}.csv"] = "".join(rng.choice(['"', '"', ",", "\n", "a", '""', '","', '"\n']) for _ in range(rng.randint(1, 160)))
    for name, text in texts.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(text.encode())
    got = read(spark, tmp_path)
    for name, text in texts.items():
        want = plain_rows(text.removeprefix("﻿"))
        if name == "open.csv":
            # The library drops nothing either, but keeps the last line feed.
            want[-1][-1] = want[-1][-1].removesuffix("\n")
        cells = [row for _, row in got.get(name, [])]
        if name.startswith("r"):
            cells, want = ([[cell.rstrip("\n") for cell in row] for row in rows] for rows in (cells, want))
        assert cells == want, name
        assert [number for number, _ in got.get(name, [])] == [*range(1, len(want) + 1)]


def test_a_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("".join(f'{i},"x\n{i}"\n' for i in range(60)))
    lines = records._lines(spark, str(tmp_path), "*.csv")
    assert lines.select("split").distinct().count() > 5
    assert records.csv_records(spark, str(tmp_path)).count() == 60


def test_pages_are_read_by_name(spark, tmp_path, small_splits):
    (tmp_path / "SqlData1.csv").write_text(',sn,date,data,slave_id,type_id\n0,dev,2020-01-02 00:00:00,"{""t"":\n1}",1,2\n')
    (tmp_path / "SqlData2.csv").write_text("more,type_id,date,sn,slave_id,data\r\nx,4,2020-01-03,dev,3,{}\r\n\r\nx,,2020-01-04,dev,,\r\n")
    rows = pages.read_pages(spark, str(tmp_path)).orderBy("seq").collect()
    assert [tuple(r)[:6] for r in rows] == [
        ("dev", "2020-01-02 00:00:00", '{"t":\n1}', 1, 2, 1),
        ("dev", "2020-01-03", "{}", 3, 4, 2),
        ("dev", "2020-01-04", None, None, None, 2),
    ]
    (tmp_path / "SqlData3.csv").write_text("sn,date,data,slave_id\nd,e,f,1\n")
    with pytest.raises(Exception, match="no column type_id in page SqlData3.csv"):
        pages.read_pages(spark, str(tmp_path)).collect()


def test_page_files_are_written_once(spark, tmp_path):
    schema = "page_no long, row_number long, sn string, date string, data string, slave_id int, type_id int"
    rows = [(1 + i // 3, i % 3 + 1, f"d{i}", "t", f'{{"a": "x, {i}\n"}}', i, None) for i in range(8)]
    folder = str(tmp_path / "out")
    pages.write_page_files(spark.createDataFrame(rows, schema), folder)
    got = pages.read_pages(spark, folder).orderBy("seq").collect()
    assert [(r.page_no, r.sn, r.data, r.slave_id, r.type_id) for r in got] == [(r[0], r[2], r[4], r[5], None) for r in rows]
    with pytest.raises(FileExistsError):
        pages.write_page_files(spark.createDataFrame(rows, schema), folder)
