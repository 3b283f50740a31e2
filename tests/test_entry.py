"""The driver contract, loaded the way an outside harness may load it."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_loads_by_path_from_another_folder(tmp_path):
    code = (
        "import importlib.util\n"
        f"spec = importlib.util.spec_from_file_location('entry_mod', {os.path.join(ROOT, '__spark_entry__.py')!r})\n"
        "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
        "q, o = m.queries(), m.oracle_sql()\n"
        "own = lambda d: sorted(k for k in d if k != 'pipeline' and not k.startswith('op'))\n"
        "assert own(q) == own(o), set(own(q)) ^ set(own(o))\n"
        "print(len(own(q)))\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.strip().splitlines()[-1] == "68"
