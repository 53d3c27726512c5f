"""The README's "Using it on existing tables" example runs as written against
the tables the jobs write (paths pointed at a scratch run)."""

import os
import re
import sys

from .conftest import SF001

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(REPO, "tools"))

import song_workload as sw  # noqa: E402


def _example() -> str:
    text = open(os.path.join(REPO, "README.md")).read()
    section = text.split("## Using it on existing tables", 1)[1].split("\n## ", 1)[0]
    return re.search(r"```python\n(.*?)```", section, re.S).group(1)


def test_readme_example_runs(spark, capsys):
    from facetspark.plans import jobs
    from facetspark.session import scratch_dir

    csv_path = sw.export_csv(spark, SF001)
    out = scratch_dir(spark, "readme-run")
    jobs.run_all(spark, csv_path, out)
    code = _example().replace('"out/', f'"{out}/').replace('"exports/songs/"', repr(csv_path))
    ns = {"spark": spark}
    exec(compile(code, "README.md", "exec"), ns)
    shown = capsys.readouterr().out
    assert "n_songs" in shown and "emotion" in shown.lower()
    assert ns["res"]["share_time_signature"].count() > 0
    written = spark.read.option("header", True).csv(f"{out}/time_signature_csv")
    assert written.count() == ns["res"]["share_time_signature"].count()
