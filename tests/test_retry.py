import os
import subprocess
import sys


def test_retried_task_does_not_double_the_count():
    script = os.path.join(os.path.dirname(__file__), "retry_job.py")
    out = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=300)
    line = [x for x in out.stdout.splitlines() if x.startswith("ROWS")]
    assert line, out.stderr[-2000:]
    assert line[0].split()[1:] == ["10000", "10000", "1"]
