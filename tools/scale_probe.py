"""Scale probe: the sf0.1 orders replicated R times as distinct series.

The observations are derived on Spark from the given orders table (each
order appears once per replica, under series "<priority>#<replica>"), so the
panel grows to 5*R series.  Times the panel + features, the naive-model
metrics and the row-position index for each R.

usage: python tools/scale_probe.py [R ...]   (default 1 10 100)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera import schema as S  # noqa: E402
from tessera.operators import evaluate as ev, features as feat, panel as pnl  # noqa: E402
from tessera.plans.sql import NAIVE_MODELS  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.sources import tables  # noqa: E402


def main():
    reps = [int(a) for a in sys.argv[1:]] or [1, 10, 100]
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session()
    base = tables.orders_observations(spark, sf)
    out = {}
    for r in reps:
        obs = (base.withColumn("_rep", F.explode(F.sequence(F.lit(1), F.lit(r))))
               .withColumn(S.SERIES, F.concat_ws("#", S.SERIES, F.col("_rep").cast("string")))
               .drop("_rep"))
        res = {}
        t0 = time.perf_counter()
        proc = feat.processed_panel(pnl.build_panel(obs))
        proc.write.format("noop").mode("overwrite").save()
        res["processed_panel_s"] = round(time.perf_counter() - t0, 2)
        t0 = time.perf_counter()
        ev.metrics(ev.to_long(proc, NAIVE_MODELS)).collect()
        res["metrics_s"] = round(time.perf_counter() - t0, 2)
        t0 = time.perf_counter()
        pnl.with_global_index(proc.select(S.SERIES, S.DT)).write.format("noop").mode("overwrite").save()
        res["global_index_s"] = round(time.perf_counter() - t0, 2)
        res["observations"] = base.count() * r
        res["panel_rows"] = 12025 * r
        out[r] = res
        print(json.dumps({"replicas": r, **res}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
