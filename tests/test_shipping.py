"""The distance kernel must run on workers that do not have this package."""

import subprocess
import sys

import numpy as np
from pyspark import cloudpickle

from tessera.functions import kernels


def test_kernel_code_is_pickled_by_value(tmp_path):
    blob = tmp_path / "fn.pkl"
    blob.write_bytes(cloudpickle.dumps(kernels.distances))
    code = (
        "import pickle, sys, numpy as np\n"
        "sys.path = [p for p in sys.path if 'repo' not in p]\n"
        f"f = pickle.loads(open({str(blob)!r}, 'rb').read())\n"
        "print(f(np.zeros((1, 2)), np.ones((1, 2)))[0, 0])\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert float(out.stdout.strip()) == np.sqrt(2.0)
