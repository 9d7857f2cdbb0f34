"""Delimited files with line breaks inside quotes, cut into records by several tasks."""

from __future__ import annotations

import csv
import random

import pytest

from perkflow.sources import records
from perkflow.sources.tabular import read_csv


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def made(rng, n, longest):
    """Rows whose texts hold breaks, quotes and separators, some longer than several blocks."""
    parts = ["a", "é", '"', '""', ";", ",", "\n", "\r\n", "\n\n", " ", "x" * 30]
    rows = []
    for i in range(n):
        size = longest if i % 40 == 7 else rng.randint(0, 12)
        rows.append([str(i), "".join(rng.choice(parts) for _ in range(size)), rng.choice(["", "z", " p "])])
    return rows


def write(path, rows, ending="\r\n", header=("id", "text", "more")):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, delimiter=";", lineterminator=ending)
        writer.writerow(header)
        writer.writerows(rows)


def wanted(rows):
    return sorted(tuple(v or None if v == "" else v for v in row) for row in rows)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("longest", [12, 400])
def test_a_file_of_many_blocks(spark, tmp_path, small_blocks, ending, longest):
    rows = made(random.Random(longest), 300, longest)
    write(tmp_path / "a.csv", rows, ending)
    path = str(tmp_path / "a.csv")
    parities = records.block_parities(spark, path)
    [(starts, inside)] = parities.values()
    assert len(starts) > 10 and inside.any() and not inside.all()
    frame = read_csv(spark, path, ";", infer=False, multi_line=True)
    assert frame.columns == ["id", "text", "more"]
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(wanted(rows), key=repr)


def test_several_tasks_read_one_file(spark, tmp_path, small_blocks):
    write(tmp_path / "a.csv", made(random.Random(1), 200, 12))
    frame = read_csv(spark, str(tmp_path / "a.csv"), ";", infer=False, multi_line=True)
    counts = frame.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(1 for n in counts if n) > 3


def test_a_field_longer_than_several_blocks_and_none(spark, tmp_path, small_blocks):
    rows = [["1", "a\nb\n" * 2000, "x"], ["2", "plain", ""], ["3", "\n", "y"]]
    write(tmp_path / "a.csv", rows, "\n")
    frame = read_csv(spark, str(tmp_path / "a.csv"), ";", infer=False, multi_line=True)
    assert sorted(map(tuple, frame.collect())) == wanted(rows)


def test_many_files_with_marks_and_their_own_headers(spark, tmp_path, small_blocks):
    rows = made(random.Random(2), 90, 60)
    for n in range(3):
        write(tmp_path / f"{n}.csv", rows[n::3], "\n")
        data = (tmp_path / f"{n}.csv").read_bytes()
        (tmp_path / f"{n}.csv").write_bytes("\ufeff".encode() + data)
    frame = read_csv(spark, str(tmp_path), ";", infer=False, multi_line=True)
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(wanted(rows), key=repr)
    write(tmp_path / "4.csv", [], "\n", ("id", "other"))
    with pytest.raises(ValueError, match="different headers"):
        read_csv(spark, str(tmp_path), ";", multi_line=True)


def test_quotes_that_do_not_pair_stop_the_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;text\n1;"open\n2;x\n')
    with pytest.raises(ValueError, match="inside a quoted field"):
        read_csv(spark, str(tmp_path / "a.csv"), ";", multi_line=True)


def test_header_with_a_line_break_empty_file_and_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"id\nnumber";text\n\n7;"a\nb"\n')
    frame = read_csv(spark, str(tmp_path / "a.csv"), ";", multi_line=True)
    assert frame.columns == ["id\nnumber", "text"] and frame.collect() == [(7, "a\nb")]
    (tmp_path / "b.csv").write_text("")
    assert read_csv(spark, str(tmp_path / "b.csv"), ";", multi_line=True).count() == 0
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("wrong", T.LongType())])
    with pytest.raises(ValueError, match="is not"):
        read_csv(spark, str(tmp_path / "a.csv"), ";", schema, multi_line=True)
