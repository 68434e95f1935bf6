"""Record the DuckDB output types of every oracle query (run after editing SQL).

    python tools/gen_oracle_types.py [sf_dir]
"""
from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaffer.plans.catalog import QUERIES  # noqa: E402
from gaffer.plans.oracle_types import _PATH  # noqa: E402
from tools.check_oracle import duck  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    con = duck(sf_dir)
    out = {}
    for name, (_, sql) in QUERIES.items():
        if sql is None:
            continue
        rel = con.sql(sql)
        out[name] = [[c, str(t)] for c, t in zip(rel.columns, rel.types)]
    with open(_PATH, "w") as f:
        json.dump(out, f, indent=1, sort_keys=True)
    print(f"wrote {len(out)} queries to {_PATH}")


if __name__ == "__main__":
    main()
