import subprocess
import sys


def test_invalid_execution_date_fails_before_any_work(tmp_path):
    """An invalid EXECUTION_DATE exits with status 1 before a session
    is built or anything is written."""
    env = {"EXECUTION_DATE": "not-a-date", "PATH": "/usr/bin:/bin"}
    p = subprocess.run([sys.executable, "-m", "tidemark", "daily", "--lake", str(tmp_path / "lake"),
                        "--objects", str(tmp_path / "objects")],
                       capture_output=True, text=True, env=env, timeout=120,
                       cwd=__file__.rsplit("/tests/", 1)[0])
    assert p.returncode == 1
    assert "the execution date" in p.stdout + p.stderr
    assert not (tmp_path / "lake").exists()
