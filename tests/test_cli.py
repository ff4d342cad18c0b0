"""Commands on small files."""

import json

from logsift import cli


def test_commands(spark, tmp_path, capsys):
    t = str(tmp_path)
    assert cli.main(["generate-sample", f"{t}/s", "--minutes", "4", "--scale", "0.05"]) == 0
    assert cli.main(["run", f"{t}/s/logs", "--changes", f"{t}/s/changes", "--out", f"{t}/o"]) == 0
    assert cli.main(["estimate", f"{t}/s/logs"]) == 0
    assert cli.main(["export-golden", f"{t}/s/logs", f"{t}/g"]) == 0
    assert cli.main(["replay", f"{t}/s/logs", f"{t}/p"]) == 0
    assert json.loads(spark.read.text(f"{t}/p").first()["value"])["resourceLogs"]
    rows = [
        {"service": "a", "level": "ERROR", "body": "db pool exhausted", "labels": {"actionable": True, "benign": False, "category": "capacity", "severity": 3}},
        {"service": "a", "level": "DEBUG", "body": "GET /healthz status=200", "count": 99, "labels": {"actionable": True, "benign": True, "category": "none", "severity": 0}},
    ]
    (tmp_path / "golden.jsonl").write_text("\n".join(map(json.dumps, rows)))
    assert cli.main(["eval", f"{t}/golden.jsonl"]) == 0
    assert cli.main(["eval", f"{t}/golden.jsonl", "--max-false-suppression", "0.1"]) == 1
    assert "routing" in capsys.readouterr().out
