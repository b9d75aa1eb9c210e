"""Times the winner search on skewed tables made by rule; BENCH_ROWS sets their size."""

import os
import time

from codays.operators.contenders import most_frequent_pair
from codays.session import local_session, release, staged

ROWS = int(os.environ.get("BENCH_ROWS", "300000"))
# latitude, longitude and day of row ``id``
TABLES = {
    "a third of all rows on one day": ("id % 997", "id div 997", "if(id % 3 = 0, 0, hash(id) % 700)"),
    "a third of all rows in one cell": ("if(id % 3 = 0, 0, id % 997)", "if(id % 3 = 0, 0, hash(id) % 50)", "hash(id, 1) % 9000"),
    "a long tail of cells": ("int(pow(1 / (rand(1) + 1e-6), 0.9)) % 5000", "0", "hash(id) % 2000"),
}


def main() -> None:
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    for name, (lat, lon, day) in TABLES.items():
        table = spark.range(ROWS).selectExpr(
            f"double({lat}) AS lat", f"double({lon}) AS lon", f"concat('d', {day}) AS date"
        )
        unique = staged(table.distinct(), "unique")
        start = time.perf_counter()
        winner = most_frequent_pair(unique).first()
        print(f"{name}: {unique.count()} rows, {winner}, {time.perf_counter() - start:.1f} s", flush=True)
        release(spark)


if __name__ == "__main__":
    main()
