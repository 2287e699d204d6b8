from __future__ import annotations

import fixture_rows as fx
import pytest

from footfall import __main__ as cli
from footfall.sinks.tables import read_daily, read_hourly


@pytest.fixture
def run(spark, monkeypatch):
    """The command line with the tests' session, which it must not stop."""
    monkeypatch.setattr(cli, "build_session", lambda master=None: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    return cli.main


def test_batch_and_show(run, spark, tree, tmp_path, capsys):
    out = str(tmp_path / "out")
    assert run(["batch", tree(fx.FILES), out]) == 0
    assert fx.hourly_tuples(read_hourly(spark, f"{out}/hourly")) == fx.HOURLY
    assert run(["show", out, "north", "south", "--date", "2024-03-01"]) == 0
    shown = capsys.readouterr().out
    assert "2024-03-01" in shown and "09:00" in shown and "2024-03-02" not in shown


def test_published_runs(run, spark, tree, tmp_path, capsys):
    out = str(tmp_path / "out")
    for n in (1, 2):
        root = tree({"a/2024-03-01.csv": f"timestamp,in,out\n2024-03-01T08:00:00,{n}{n}{n},0\n"}, f"in{n}")
        assert run(["batch", root, out, "--publish"]) == 0
        assert run(["show", out, "a"]) == 0
        assert f"{n}{n}{n}" in capsys.readouterr().out
    assert run(["batch", tree(fx.FILES), out, "--publish", "--min-rows", "3"]) == 1
    assert run(["show", out, "a"]) == 0 and "222" in capsys.readouterr().out


def test_ingest(run, spark, tree, tmp_path):
    out = str(tmp_path / "out")
    assert run(["ingest", tree(fx.FILES), out]) == 0
    assert fx.daily_tuples(read_daily(spark, f"{out}/daily")) == fx.DAILY


def test_failed_gate_and_missing_input(run, tree, tmp_path):
    assert run(["batch", tree(fx.FILES), str(tmp_path / "out"), "--min-rows", "3"]) == 1
    assert run(["batch", str(tmp_path / "nothing"), str(tmp_path / "out2")]) == 1


def test_prune(run, spark, tree, tmp_path):
    out = str(tmp_path / "out")
    assert run(["ingest", tree(fx.FILES), out, "--min-rows", "1"]) == 0
    assert run(["prune", out, "--before", "2024-03-02"]) == 0
    assert {r[1].day for r in fx.hourly_tuples(read_hourly(spark, f"{out}/hourly"))} == {2}
    assert run(["ingest", str(tmp_path / "nothing"), out]) == 1


def test_duplicates_are_sized_from_bytes_in_both_layouts(spark, tree):
    root = tree(fx.FILES)
    plain = cli.expected_rows(spark, root, False)
    assert plain == sum(map(len, fx.FILES.values())) // cli.BYTES_PER_LINE
    parts = tree({f"location={k.split('/')[0]}/file_date={k.split('/')[1][:-4]}/part.csv": v for k, v in fx.FILES.items()}, "parts")
    assert cli.expected_rows(spark, parts, True) == plain
