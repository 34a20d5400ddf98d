"""The library without its optional text part."""

import pathlib
import shutil
import subprocess
import sys

REPO = pathlib.Path(__file__).resolve().parents[1]


def test_the_rest_imports_without_the_text_part(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e, bench; n = set(e.queries()); print(len(n), any(x.startswith('op') and '_' in x and x[2].isdigit() for x in n), 'pipeline' in n)"
    run = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)})
    assert run.returncode == 0, run.stderr[-2000:]
    count, operators, pipeline = run.stdout.split()[-3:]
    assert int(count) > 70 and operators == "False" and pipeline == "False"
