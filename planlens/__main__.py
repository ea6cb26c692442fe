"""``python -m planlens DATA_DIR``: land, build and check the model."""

from __future__ import annotations

import argparse

from planlens.plans.build import build
from planlens.session import build_session, folder_bytes, shuffle_partitions


def main() -> None:
    parser = argparse.ArgumentParser(prog="planlens", description=__doc__)
    parser.add_argument("data_dir", help="folder holding the four extracts")
    arguments = parser.parse_args()
    spark = build_session()
    partitions = shuffle_partitions(folder_bytes(spark, arguments.data_dir))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    results = build(spark, arguments.data_dir)
    results.orderBy("status", "check_name").show(results.count(), truncate=False)


if __name__ == "__main__":
    main()
