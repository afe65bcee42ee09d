"""Print the formatted physical plans of representative queries (used to write PLANS.md).

Usage: python tools/show_plans.py [sf_dir] [query ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.plans.queries import QUERIES  # noqa: E402
from tidewater.session import build_session  # noqa: E402

DEFAULT = ["scd2_corrected", "extract_delta_events", "latest_per_key", "calendar_activity"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    spark = build_session("local[8]", 16)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()  # final (adaptive) plan
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        plan = buf.getvalue()
        print(f"## {name}\n\n```\n{plan.strip()}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
