"""Pair counting on `events` three ways, same session, warm, best of N:

* plain:    self-join on user with the hour range as a residual condition
* bucketed: equi-join on (user, hour bucket) with the probe side in {b, b-1}
* counts:   this engine's count form (rules.city_pair_rows): no pairs built

A pair is (e1, e2) of one user with e1.ts < e2.ts <= e1.ts + 1h and a
different event_type (standing in for the city).

usage: python tools/pair_bench.py [sf_dir] [cpus] [repeat]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

HOUR = 3600 * 1_000_000


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 4
    repeat = int(sys.argv[3]) if len(sys.argv) > 3 else 3
    from ledgerwatch.functions import epoch_micros
    from ledgerwatch.operators.rules import city_pair_rows
    from ledgerwatch.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts", "event_type")
    hot = int(os.environ.get("PAIR_BENCH_HOT", "0"))
    if hot:
        # Skewed variant: add one user with `hot` events of one type inside one
        # hour (derived from the events rows, so it grows with the table).
        extra = (ev.limit(hot)
                   .select(F.lit(-1).cast("long").alias("user_id"),
                           (F.lit("2024-01-05 10:00:00").cast("timestamp_ntz")
                            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                 (F.monotonically_increasing_id() % 3600).cast("decimal(18,6)")))
                           .alias("ts"),
                           F.lit("view").alias("event_type")))
        ev = ev.unionByName(extra)

    def plain():
        a, b = ev.alias("a"), ev.alias("b")
        j = a.join(b, (F.col("a.user_id") == F.col("b.user_id")) & (F.col("b.ts") > F.col("a.ts"))
                   & (F.col("b.ts") - F.col("a.ts") <= F.expr("INTERVAL 1 HOUR"))
                   & (F.col("a.event_type") != F.col("b.event_type")))
        return j.count()

    def bucketed():
        x = ev.withColumn("_us", epoch_micros("ts")).withColumn("_b", F.expr(f"_us div {HOUR}L"))
        a = x.alias("a")
        b = x.withColumn("_b", F.explode(F.array(F.col("_b"), F.col("_b") - 1))).alias("b")
        j = a.join(b, (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a._b") == F.col("b._b"))
                   & (F.col("b.ts") > F.col("a.ts")) & (F.col("b._us") - F.col("a._us") <= HOUR)
                   & (F.col("a.event_type") != F.col("b.event_type")))
        return j.count()

    def counts():
        r = ev.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("card_num"),
                      F.col("ts").alias("trans_date"), F.col("event_type").alias("terminal_city"))
        cells = r.groupBy("card_num", "trans_date", "terminal_city").agg(F.count(F.lit(1)).alias("n_rows"))
        return city_pair_rows(cells).agg(F.sum("later_partners")).first()[0]

    out = {}
    for name, fn in (("plain", plain), ("bucketed", bucketed), ("counts", counts)):
        fn()  # warm-up
        best, pairs = None, None
        for _ in range(repeat):
            t0 = time.perf_counter()
            pairs = fn()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        out[name] = {"pairs": int(pairs), "sec": round(best, 3)}
    print(json.dumps({"sf_dir": sf_dir, "cpus": cpus, "repeat": repeat, "hot_events": hot, **out}))
    spark.stop()


if __name__ == "__main__":
    main()
