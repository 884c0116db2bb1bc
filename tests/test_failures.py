"""Task failures (every task's first attempt raises) do not change results:
recomputed map tasks land in the same range partitions, reducers re-read
shuffle output, written intermediates are overwritten by the retry."""

import json
import os
import subprocess
import sys
import tempfile

from core_paths import ROOT, SF_SMALL

HELPER = os.path.join(os.path.dirname(__file__), "helpers", "failure_run.py")


def _run(inject: bool) -> dict:
    ckpt = tempfile.mkdtemp(prefix="vidpulse-fail-")
    out = subprocess.run([sys.executable, HELPER, ROOT, SF_SMALL, "1" if inject else "0", ckpt],
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_results_survive_task_failures():
    clean, failing = _run(False), _run(True)
    assert clean["n"] > 0
    assert failing == clean
