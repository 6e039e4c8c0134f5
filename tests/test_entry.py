"""The driver contract: names, and what happens where the training-data operators cannot be imported."""

import subprocess
import sys


def test_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_a_missing_library_costs_only_the_operators_that_need_it():
    code = "import sys; sys.modules['ahocorasick'] = None; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len([n for n in e.queries() if not n.startswith('p')]))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and int(done.stdout) > 90, done.stderr
