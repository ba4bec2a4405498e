"""Conversion (C7) throughput on generated 120x120 rasters for several local core counts.

Usage: python tools/convert_scaling.py [patches] [cores ...]   (default: 256 patches, 1 2 4)
Each core count runs in its own process (a session's master cannot change) and
prints one JSON line per run.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CHILD = """
import json, sys
sys.path.insert(0, {root!r})
import bench
from rasterprep.session import local_session
spark = local_session({cores}, shuffle_partitions={parts}, app="rasterprep-scaling")
out = bench.bench_convert(spark, {patches})
out["cores"] = {cores}
print(json.dumps(out))
spark.stop()
"""


def main() -> None:
    patches = int(sys.argv[1]) if len(sys.argv) > 1 else 256
    cores = [int(c) for c in sys.argv[2:]] or [1, 2, 4]
    for c in cores:
        code = CHILD.format(root=ROOT, cores=c, parts=max(2, 2 * c), patches=patches)
        res = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=1800)
        lines = [ln for ln in res.stdout.splitlines() if ln.startswith("{")]
        print(lines[-1] if lines else json.dumps({"cores": c, "error": res.stderr[-500:]}), flush=True)


if __name__ == "__main__":
    main()
