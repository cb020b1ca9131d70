"""Print the physical operator tree (explain "formatted", tree part only) and
the scan pushdown lines of selected queries.

Usage: python scripts/explain_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from indicast.plans.queries import QUERIES  # noqa: E402
from indicast.plans import stages as S  # noqa: E402
from indicast.session import build_session  # noqa: E402

DEFAULT = ["w1_dedup_priority", "c6_all_flags_raw", "p6_drop_counters", "a1_coverage"]


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n")[0]
    push = [ln for ln in text.splitlines() if ln.startswith(("PushedFilters", "ReadSchema"))]
    return head + "\n" + "\n".join(push)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    spark = build_session()
    print("### harmonize (unmaterialised)\n```")
    print(tree(S.harmonized(spark, sf, materialized=False)))
    print("```")
    for n in names:
        print(f"### {n}\n```")
        print(tree(QUERIES[n](spark, sf)))
        print("```")


if __name__ == "__main__":
    main()
