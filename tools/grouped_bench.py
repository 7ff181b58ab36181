"""Why ``blocks.grouped_rows`` exists: the halo plan's grouped map against ``applyInPandas``.

    python tools/grouped_bench.py [groups] [rows per group] [payload bytes]

Both have one exchange and one sort; ``grouped_rows`` calls Python once per
Arrow batch, ``applyInPandas`` once per group.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    import pandas as pd
    from pyspark.sql import functions as F

    from tessera.operators.blocks import grouped_rows
    from tessera.session import get_spark
    groups, per, size = (int(a) for a in (sys.argv[1:] + ["20000", "5", "512"][len(sys.argv) - 1:]))
    spark = get_spark("local[4]", 8)
    df = spark.range(groups * per).select((F.col("id") % groups).alias("k"), F.lit(b"x" * size).alias("p"))
    one = lambda pdf: (int(pdf["k"].iloc[0]), int(sum(map(len, pdf["p"]))))
    plans = {"grouped_rows": grouped_rows(df, ["k"], one, "k long, n long", ["k", "n"]),
             "applyInPandas": df.groupBy("k").applyInPandas(lambda pdf: pd.DataFrame([one(pdf)], columns=["k", "n"]), "k long, n long")}
    for turn in range(2):
        for name, plan in plans.items():
            t = time.time()
            plan.write.format("noop").mode("overwrite").save()
            print(name, "warm-up" if not turn else "", round(time.time() - t, 2), "s", flush=True)


if __name__ == "__main__":
    main()
