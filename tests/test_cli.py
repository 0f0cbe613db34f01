"""The command line, run as a user would (separate process)."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMOKE


def _run(*args: str) -> dict:
    out = subprocess.run(
        [sys.executable, "-m", "peerlens", *args],
        cwd=ROOT,
        capture_output=True,
        text=True,
        timeout=600,
        env={**os.environ, "BENCH_CPUS": "4"},
    )
    assert out.returncode == 0, out.stderr[-2000:]
    line = next(ln for ln in out.stdout.splitlines() if ln.startswith("{"))
    return json.loads(line)


def test_cli_full_run_then_one_stage(scratch):
    root = f"{scratch}/run"
    full = _run("run", "--fixtures", SF_SMOKE, "--root", root, "--year", "1998")
    assert full["row_counts"]["gold/fraud_risk_indicators"] == 226
    assert set(full["seconds"]) == {"bronze", "silver", "quality", "gold", "reports"}
    again = _run("run", "--root", root, "--year", "1998", "--stage", "reports")
    assert again["row_counts"]["report_state_reimbursement"] == 25
    assert set(again["seconds"]) == {"reports"}
