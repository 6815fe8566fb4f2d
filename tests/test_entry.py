import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry


def test_names():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and "panel_coverage" in q


def test_imports_without_the_optional_folder(tmp_path):
    root = os.path.dirname(entry.__file__)
    os.makedirs(tmp_path / "coverlark")
    for name in os.listdir(f"{root}/coverlark"):
        if name != "llm":
            os.symlink(f"{root}/coverlark/{name}", tmp_path / "coverlark" / name)
    os.symlink(f"{root}/__spark_entry__.py", tmp_path / "__spark_entry__.py")
    code = "import __spark_entry__ as e; assert 'panel_coverage' in e.queries() and not any(k.startswith('op') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_flagship(spark):
    assert entry.entry(spark).count() == 3
