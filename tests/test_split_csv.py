"""SRC1 in blocks: equal to the one-task reader on random files, blocks as tasks, odd files."""

from __future__ import annotations

import random

import pytest

from dfinsight.sources.io import read_csv
from dfinsight.sources.split_csv import LineStates, numbered_lines, read_csv_split

SCHEMA = "x string, y string, z string"


def random_file(rnd: random.Random, end: str) -> str:
    def cell():
        kind = rnd.random()
        if kind < .35:
            return "".join(rnd.choice("abé 1") for _ in range(rnd.randint(0, 6)))
        if kind < .85:
            return '"' + "".join(rnd.choice(["a", '""', ",", "\n", end, " "]) for _ in range(rnd.randint(0, 9))) + '"'
        return "a" + "".join(rnd.choice('a"b') for _ in range(rnd.randint(0, 4)))

    rows = [",".join(cell() for _ in range(3)) for _ in range(rnd.randint(0, 30))]
    blank = end if rnd.random() < .2 else ""
    return ("﻿" if rnd.random() < .3 else "") + blank + "x,y,z" + end + end.join(rows) + (end if rnd.random() < .5 else "")


def both(spark, path, block, **kw):
    one = sorted(map(repr, read_csv(spark, path, SCHEMA, **kw).collect()))
    return one, sorted(map(repr, read_csv_split(spark, path, SCHEMA, block_bytes=block, **kw).collect()))


@pytest.mark.parametrize("seed", range(8))
def test_equals_the_one_task_reader(spark, tmp_path, seed):
    rnd = random.Random(seed)
    for f in range(3):
        (tmp_path / f"{f}.csv").write_text(random_file(rnd, ["\n", "\r\n"][seed % 2]), newline="")
    one, split = both(spark, str(tmp_path), [5, 19, 64, 10_000][seed % 4])
    assert one == split


@pytest.mark.parametrize("text", ["", "\n\n", "x,y,z", "x,y,z\n", '"x\nx",y,z\na,b,c\n', "\r\n\r\nx,y,z\r\na,b,c\r\n", 'x,y,z\n"' + "long\n" * 400 + '",b,c\nd,e,f\n',
                                  "x,y,z\na\na,b,c,d\n,,\n", 'x,y,z\n"a ""q"" b","\n","""\n"""\n', "x,y,z\n" + "é" * 300 + ",b,c\n"])
def test_odd_files(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(text, newline="")
    one, split = both(spark, str(tmp_path), 16)
    assert one == split


def test_without_header_and_with_nulls_and_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"a\nb",2.5\n2,\\N,\n3,"",x\n')
    schema = "id int, t string, v double"
    for header in (True, False):
        want = read_csv(spark, str(tmp_path), schema, header=header, null_value="\\N").collect()
        got = read_csv_split(spark, str(tmp_path), schema, header=header, null_value="\\N", block_bytes=6).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_one_file_is_many_tasks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y,z\n" + '"line\nbreak",b,c\n' * 4000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    lines = numbered_lines(spark, str(tmp_path), block_bytes=4096)
    blocks = lines.select("block").distinct().count()
    assert blocks >= 15 and lines.inputFiles().__len__() >= 15  # a task writes a file
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert read_csv_split(spark, str(tmp_path), SCHEMA, block_bytes=4096).filter("x = 'line\\nbreak' and y = 'b' and z = 'c'").count() == 4000


def test_states_of_a_line():
    s = LineStates(",")
    assert not s.from_outside('a,"b",c') and s.from_outside('a,"b') and s.from_outside('"') and not s.from_outside('a"b,c')
    assert not s.from_inside('b",c') and s.from_inside('b') and s.from_inside('b","') and s.from_inside('""') and not s.from_inside('"')
    assert LineStates(";").from_outside('a,b;"c,') and not LineStates(";").from_outside('a,"b;c')
