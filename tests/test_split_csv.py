"""CSV read by splits, against the reader of whole files."""

import csv
import random

import pytest

from inkwell.sources.readers import read_csv
from inkwell.sources.split_csv import infer_types


@pytest.fixture
def tiny_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.files.openCostInBytes", "0")]
    for key, value in old.items():
        spark.conf.set(key, value)


def write(path, rows, sep=",", end="\n"):
    with open(path, "w", newline="") as file:
        out = csv.writer(file, delimiter=sep, lineterminator=end)
        out.writerow(["id", "text", "score"])
        out.writerows(rows)


def odd_rows(seed, n):
    rng = random.Random(seed)
    parts = ["a", "é", ",", ";", '"', "\n", "\n\n", " ", "word", '""', "\r\n", "'"]
    return [(i, "x" + "".join(rng.choice(parts) for _ in range(rng.randrange(0, 40))) + "y", rng.choice([1.5, -2.0, ""])) for i in range(n)]


SCHEMA = "id BIGINT, text STRING, score DOUBLE"


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("sep, end", [(",", "\n"), (";", "\r\n")])
def test_rows_do_not_depend_on_splits(spark, tmp_path, tiny_splits, size, sep, end):
    rows = odd_rows(size, 40) + [(1000, '"' + "long\nrecord" * 30, 1.0), (1001, "", 2.0), (1002, "\n", "")]
    for part in range(2):
        write(tmp_path / f"part{part}.csv", rows[part::2], sep, end)
    want = sorted((i, text or None, score if score != "" else None) for i, text, score in rows)
    if end == "\n":  # with other line ends the reader of whole files changes those inside quotes too
        assert sorted(map(tuple, read_csv(spark, str(tmp_path), SCHEMA, sep, whole_files=True).collect())) == want
    tiny_splits(size)
    assert sorted(map(tuple, read_csv(spark, str(tmp_path), SCHEMA, sep).collect())) == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path, tiny_splits):
    write(tmp_path / "one.csv", [(i, f"line\nbreak {i}", 0.5) for i in range(2000)])
    tiny_splits(2000)
    frame = read_csv(spark, str(tmp_path / "one.csv"), SCHEMA)
    assert frame.rdd.getNumPartitions() > 8 and frame.count() == 2000
    assert read_csv(spark, str(tmp_path / "one.csv"), SCHEMA, whole_files=True).rdd.getNumPartitions() == 1


def test_headers_and_types(spark, tmp_path, tiny_splits):
    path = tmp_path / "table.csv"
    path.write_text('﻿"a\nb",n,day,when,flag,mixed,none\n1,3000000000,2024-01-02,2024-01-02 03:04:05,true,1,\n\n-2,4,2024-02-03,2024-02-03T00:00:00,FALSE,x,\n')
    tiny_splits(5)
    frame = read_csv(spark, str(path))
    assert dict(frame.dtypes) == {"a\nb": "int", "n": "bigint", "day": "date", "when": "timestamp", "flag": "boolean", "mixed": "string", "none": "string"}
    assert frame.count() == 2
    with pytest.raises(ValueError):
        read_csv(spark, str(path), "a INT, n INT")
    (tmp_path / "empty.csv").write_text("")
    assert read_csv(spark, str(tmp_path / "empty.csv"), "a INT").collect() == []
    (tmp_path / "head.csv").write_text("a,b\n")
    assert read_csv(spark, str(tmp_path / "head.csv"), "a INT, b INT").collect() == []
    assert infer_types(read_csv(spark, str(tmp_path / "head.csv"))) == "`a` string, `b` string"
