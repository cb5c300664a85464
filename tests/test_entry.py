"""The entry file with and without its optional parts."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(len(e.queries()), 'op1_language_id' in e.queries(), 'pipeline' in e.queries(), 'daily_run' in e.queries())"


@pytest.mark.parametrize("without,has_ops,has_pipeline", [((), None, None), (("feedlake/llm",), False, False), (("feedlake/llm", "corpus_pipeline.py"), False, False),
                                                          (("corpus_pipeline.py",), None, False)])
def test_import_without_optional_parts(tmp_path, without, has_ops, has_pipeline):
    copy = tmp_path / "repo"
    shutil.copytree(os.path.join(ROOT, "feedlake"), copy / "feedlake", ignore=shutil.ignore_patterns("__pycache__", *[w.split("/")[1] for w in without if "/" in w]))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in without and os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), copy / name)
    out = subprocess.run([sys.executable, "-c", NAMES], cwd=copy, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": str(copy)})
    assert out.returncode == 0, out.stderr
    count, ops, pipeline, run = out.stdout.split()
    assert int(count) > 60 and run == "True"
    present = os.path.isdir(os.path.join(ROOT, "feedlake/llm"))
    assert ops == str(present if has_ops is None else has_ops)
    if has_pipeline is not None:
        assert pipeline == str(has_pipeline)
