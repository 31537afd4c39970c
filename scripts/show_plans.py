"""Print the formatted physical plan of registered queries.

Usage: python scripts/show_plans.py [sf_dir] [name ...]
Shows exchanges, broadcasts, pushed filters and read schemas per query.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vellum.plans import registry  # noqa: E402
from vellum.session import local_session  # noqa: E402

DEFAULT = ["search_topk", "batch_search", "index_documents", "changed_files", "last_wins", "section_blocks_per_file"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = local_session(8)
    for name in names:
        print("=" * 100)
        print(name)
        registry.QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
