import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)
os.environ.setdefault("PYTHONPATH", ROOT)


@pytest.fixture(scope="session")
def spark():
    from tributary.session import build_session

    ckpt = tempfile.mkdtemp(prefix="tributary-test-ckpt-")
    s = build_session(
        "local[*]", app_name="tributary-tests", shuffle_partitions=8,
        extra_conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                    "spark.checkpoint.dir": ckpt},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    """A fresh folder per test."""
    return str(tmp_path)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def plan_text(df):
    """The physical plan as ``df.explain()`` prints it."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
