import pytest

from hitscope import operators as op
from hitscope.__main__ import main
from hitscope.streaming import ALERT_KEYS, read_changelog
from tests.lines import LINES


@pytest.fixture
def log(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "a.log").write_text("".join(f"{line}\n" for line in LINES.values() if line))
    return str(folder)


@pytest.mark.parametrize("line_format, requests", [("current", 7), ("extended", 2), ("basic", 7)])
def test_report(spark, log, tmp_path, line_format, requests):
    out = str(tmp_path / "out")
    main(["report", "--log", log, "--format", line_format, "--out", out])
    assert spark.read.parquet(f"{out}/total_requests").first()[0] == requests


def test_report_on_screen(spark, log, capsys):
    main(["report", "--log", log])
    shown = capsys.readouterr().out
    assert "status_distribution" in shown and "Non trouvé" in shown
    # Means show two decimals: (512 + 512 + 7 + 7) / 4 of the sizes that are numbers.
    assert "autre\t259.50\n" in shown


def test_every_row_is_printed(spark, tmp_path, capsys):
    line = '1.1.1.1 - - [10/Feb/2025:07:05:13 +0000] "GET /a?id={} HTTP/1.1" 200 5\n'
    (tmp_path / "a.log").write_text("".join(map(line.format, range(60))))
    main(["report", "--log", str(tmp_path / "a.log")])
    shown = capsys.readouterr().out
    assert all(f"\n{i}\t1\n" in shown for i in range(60))


def test_results_are_replaced_only_if_asked(spark, log, tmp_path):
    command = ["report", "--log", log, "--out", str(tmp_path / "out")]
    main(command)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        main(command)
    main([*command, "--overwrite"])


def test_status_in_another_format(spark, log, tmp_path):
    out = str(tmp_path / "out")
    main(["status", "--source", "text", "--option", f"path={log}", "--checkpoint", str(tmp_path / "checkpoint"),
          "--out", out, "--sink-format", "json", "--files", "1", "--state-partitions", "2", "--until-caught-up"])
    assert {r.requests for r in spark.read.json(f"{out}/status_counts").collect()} == {1, 2, 3}


@pytest.mark.parametrize("line_format, reports", [("current", 9), ("extended", 9), ("basic", 7)])
def test_report_from_one_read(spark, log, tmp_path, line_format, reports):
    out = tmp_path / "out"
    main(["report", "--log", log, "--format", line_format, "--out", str(out), "--one-read", str(tmp_path / "counts")])
    assert len(list(out.iterdir())) == reports
    main(["report", "--log", log, "--format", line_format, "--out", str(tmp_path / "singly")])
    for name in ("top_ips", "method_distribution"):
        if (tmp_path / "singly" / name).exists():
            rows = lambda root: sorted(spark.read.parquet(str(root / name)).collect())
            assert rows(out) == rows(tmp_path / "singly")


def test_alerts(spark, log, tmp_path):
    out = str(tmp_path / "out")
    main(["alerts", "--source", "text", "--option", f"path={log}", "--checkpoint", str(tmp_path / "checkpoint"),
          "--out", out, "--state-partitions", "2", "--until-caught-up"])
    lines = spark.createDataFrame([(v,) for v in LINES.values() if v], "value STRING")
    spikes = op.error_spikes(op.parse_stream_tokens(lines))
    changelog = read_changelog(spark, f"{out}/error_spikes", spikes.schema)
    assert sorted(op.latest_counts(changelog, ALERT_KEYS["error_spikes"]).collect()) == sorted(spikes.collect())


def test_status(spark, log, tmp_path):
    out = str(tmp_path / "out")
    main(["status", "--source", "text", "--option", f"path={log}", "--checkpoint", str(tmp_path / "checkpoint"),
          "--out", out, "--state-partitions", "2", "--until-caught-up"])
    counts = {r.status: r.requests for r in spark.read.parquet(f"{out}/status_counts").collect()}
    # The line that starts with junk has its 1 where a status would be.
    assert counts == {404: 2, 200: 3, 304: 1, 1: 1, None: 3}


@pytest.mark.parametrize("line_format", ["current", "extended", "basic"])
def test_reports_are_the_same_from_one_read_and_separately(spark, log, tmp_path, line_format):
    common = ["report", "--log", log, "--format", line_format, "--out"]
    main([*common, str(tmp_path / "at-once")])
    main([*common, str(tmp_path / "singly"), "--separately"])
    names = sorted(p.name for p in (tmp_path / "singly").iterdir())
    assert sorted(p.name for p in (tmp_path / "at-once").iterdir()) == ["_counts", *names]
    for name in names:
        if not name.startswith("preview"):
            rows = lambda root: sorted(map(str, spark.read.parquet(str(tmp_path / root / name)).collect()))
            assert rows("at-once") == rows("singly"), name


def test_alerts_from_one_read(spark, log, tmp_path):
    out = str(tmp_path / "out")
    main(["alerts", "--source", "text", "--option", f"path={log}", "--checkpoint", str(tmp_path / "checkpoint"),
          "--out", out, "--state-partitions", "2", "--until-caught-up", "--one-read"])
    lines = spark.createDataFrame([(v,) for v in LINES.values() if v], "value STRING")
    expected = op.all_alerts(op.parse_stream_tokens(lines))
    changelog = read_changelog(spark, f"{out}/all_alerts", expected.schema).drop("batch_id")
    assert sorted(changelog.collect()) == sorted(expected.collect()) != []


def test_alerts_told_once(spark, log, tmp_path):
    out = str(tmp_path / "out")
    main(["alerts", "--source", "text", "--option", f"path={log}", "--checkpoint", str(tmp_path / "checkpoint"),
          "--out", out, "--state-partitions", "2", "--until-caught-up", "--once"])
    lines = spark.createDataFrame([(v,) for v in LINES.values() if v], "value STRING")
    expected = op.all_alerts(op.parse_stream_tokens(lines))
    changelog = read_changelog(spark, f"{out}/alerts_once", expected.schema).drop("batch_id")
    assert sorted(changelog.collect()) == sorted(expected.collect()) != []


def test_compact(spark, tmp_path, capsys):
    from hitscope.streaming import append_batch

    sink = append_batch(path=str(tmp_path))
    for n in range(3):
        sink(spark.createDataFrame([(200, n)], "status INT, requests BIGINT"), n)
    main(["compact", "--path", str(tmp_path), "--keys", "status", "--schema", "status INT, requests BIGINT"])
    assert capsys.readouterr().out == "1\n"
    changelog = read_changelog(spark, str(tmp_path), spark.createDataFrame([], "status INT, requests BIGINT").schema)
    assert sorted(tuple(r) for r in changelog.collect()) == [(200, 1, 1), (200, 2, 2)]
