import pytest
from pyspark.errors import AnalysisException

from dfinsight.__main__ import main


def test_cli_list_and_wordcount(spark, capsys, tmp_path):
    assert main(["list"]) == 0
    listed = capsys.readouterr().out.splitlines()
    assert "country_report\toracle" in listed and "sorted_ranges_orders\trows-only" in listed
    (tmp_path / "lines.txt").write_text("a b a\na\n", encoding="utf-8")
    assert main(["wordcount", str(tmp_path / "lines.txt")]) == 0
    out = capsys.readouterr().out
    assert "|a   |3  |" in out
    with pytest.raises(AnalysisException):
        main(["wordcount", "/nonexistent/texts/"])


def test_cli_run_writes_parquet(spark, tmp_path):
    out = str(tmp_path / "q1")
    assert main(["run", "country_report", "--sf-dir", "/root/testdata/sf0.001", "--out", out]) == 0
    assert spark.read.parquet(out).count() > 0


def test_cli_profile_and_analyse(spark, capsys, tmp_path):
    from tests.test_movies_csv import HEADER, LINES
    p = tmp_path / "movies.csv"
    p.write_text("﻿" + HEADER + "\n" + "\n".join(LINES) + "\n", encoding="utf-8")
    assert main(["profile", str(p)]) == 0
    out = capsys.readouterr().out
    for section in ("== table", "== audit", "== missing", "== decades"):
        assert section in out
    assert main(["analyse", str(p), "--rule", "美国:8.5:100000", "--rule", "中国大陆:8.0:50000"]) == 0
    out = capsys.readouterr().out
    assert "== q5_two_regions" in out and "Seven" in out
