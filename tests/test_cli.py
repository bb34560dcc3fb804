from edgefilter.__main__ import main
from tests.conftest import SF001


def test_list_marks_checks(capsys):
    assert main(["list"]) == 0
    out = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert out["bloom_evaluation"] == "sql" and out["cv_grid"] == "sql"


def test_run_writes_parquet(spark, tmp_path):
    out = str(tmp_path / "r")
    assert main(["run", "avg_length_by_bot", "--sf-dir", SF001, "--out", out]) == 0
    assert spark.read.parquet(out).count() == 2


def test_stream_filter_command(spark, tmp_path, capsys):
    from edgefilter.sources import files as FS
    from edgefilter.sources.tables import edits
    src = str(tmp_path / "in")
    FS.edit_json_lines(edits(spark, SF001)).coalesce(2).write.text(src)
    args = ["stream-filter", "--input", src, "--state", str(tmp_path / "state"),
            "--checkpoint", str(tmp_path / "ck"), "--once", "--timeout", "300"]
    assert main(args) == 0
    assert "blacklisted users:" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "state" / "reports")).count() >= 1
