"""python tools/check.py [scale] [name or prefix ...]: compare queries with their SQL twins."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from compare import connect, difference  # noqa: E402
from lakewarden.plans import oracles, queries  # noqa: E402
from lakewarden.session import local_session  # noqa: E402


def main() -> None:
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{scale}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in queries():
        if wanted and not any(name == w or name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            lines = [l for l in str(error).splitlines() if l.strip()]
            problem = f"{type(error).__name__} " + "\n    ".join(lines[:6])
            if not lines:
                problem += traceback.format_exc()
        mark = "" if name in oracles() else " (rows only)"
        took = time.time() - start
        if problem:
            bad += 1
            print(f"FAIL {name}{mark} {took:.1f}s {problem}", flush=True)
        else:
            print(f"ok   {name}{mark} {took:.1f}s", flush=True)
    print(f"{bad} failing")
    spark.stop()


main()
