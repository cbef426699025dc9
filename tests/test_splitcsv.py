"""CSV with line breaks in fields, cut into splits at every place."""

import csv
import os
import random

import pytest

from tillwise.sources.files import load_csv

FIELDS = ["plain", "", 'a "quoted" word', "two\nlines", "three\n\nlines\n", "comma, and\r\nbreak", '"', '""\n"', "ends \\", "é ü\n" * 5, "x" * 300, " "]


@pytest.fixture
def small_splits(spark):
    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size,end", [(64, "\n"), (257, "\r\n"), (1000, "\n"), (1 << 20, "\r\n")])
def test_splits_at_every_place(spark, tmp_path, small_splits, size, end):
    rnd = random.Random(size)
    want, folder = [], tmp_path / "files"
    folder.mkdir()
    for f in range(3):
        with open(folder / f"part-{f}.csv", "w", newline="") as out:
            w = csv.writer(out, lineterminator=end)
            w.writerow(["k", "two\nline header", "c"])
            for k in range(60):
                row = [f"{f}-{k}", rnd.choice(FIELDS), rnd.choice(FIELDS)]
                w.writerow(row)
                want.append(tuple(v or None for v in row))
    small_splits(size)
    df = load_csv(spark, str(folder))
    assert df.columns == ["k", "two\nline header", "c"]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    path = tmp_path / "large.csv"
    with open(path, "w", newline="") as out:
        w = csv.writer(out)
        w.writerow(["k", "text"])
        w.writerows((k, f"line {k}\nand, \"more\" of {k}") for k in range(20_000))
    small_splits(100_000)
    assert os.path.getsize(path) > 600_000
    df = load_csv(spark, str(path))
    assert df.rdd.getNumPartitions() >= 6
    assert df.count() == 20_000
    assert df.filter("text = concat('line ', k, '\\nand, \"more\" of ', k)").count() == 20_000


def test_a_field_longer_than_many_splits(spark, tmp_path, small_splits):
    path = tmp_path / "long.csv"
    long = "\n".join(f"row {k}" for k in range(500))
    with open(path, "w", newline="") as out:
        csv.writer(out).writerows([["k", "t"], ["1", "a"], ["2", long], ["3", long + "\n"], ["4", ""]])
    small_splits(100)
    assert sorted(map(tuple, load_csv(spark, str(path)).collect())) == [("1", "a"), ("2", long), ("3", long + "\n"), ("4", None)]


def test_blank_lines_and_header_only(spark, tmp_path):
    path = tmp_path / "blank.csv"
    path.write_text("a,b\n\n1,2\n\n\n3,4")
    assert sorted(map(tuple, load_csv(spark, str(path)).collect())) == [("1", "2"), ("3", "4")]
    path.write_text("a,b\n")
    df = load_csv(spark, str(path))
    assert df.columns == ["a", "b"] and df.count() == 0
