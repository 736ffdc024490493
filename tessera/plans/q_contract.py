"""Data contract of incoming orders, and outlying days of the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import contract as ct
from tessera.plans import sql as Q
from tessera.plans.common import orders_panel
from tessera.plans.registry import query, round_doubles
from tessera.sources import tables

# FIXED VALUES: the contract of the orders table (dates as seconds since 1970)
ORDER_RULES = [
    ct.rule("customer", "o_custkey", "range", low=1.0, high=1400.0),
    ct.rule("date", "o_orderdate", "range", low=789_091_200.0, high=994_000_000.0),
    ct.rule("day given", "o_orderdate", "present"),
    ct.rule("key", "o_orderkey", "unique"),
    ct.rule("price", "o_totalprice", "range", low=2000.0, high=490_000.0),
    ct.rule("price given", "o_totalprice", "present"),
    ct.rule("priority", "o_orderpriority", "pattern", pattern="[1-5]-[A-Z]+"),
    ct.rule("status", "o_orderstatus", "allowed", allowed=["F", "O"]),
]

_BROKEN = """bits AS (SELECT *,
  CASE WHEN o_custkey < 1 OR o_custkey > 1400 THEN 1 ELSE 0 END + CASE WHEN epoch(o_orderdate) < 789091200 OR epoch(o_orderdate) > 994000000 THEN 2 ELSE 0 END
  + CASE WHEN o_orderdate IS NULL THEN 4 ELSE 0 END
  + CASE WHEN o_orderkey IS NOT NULL AND count(*) OVER (PARTITION BY o_orderkey) > 1 THEN 8 ELSE 0 END
  + CASE WHEN o_totalprice < 2000 OR o_totalprice > 490000 THEN 16 ELSE 0 END + CASE WHEN o_totalprice IS NULL THEN 32 ELSE 0 END
  + CASE WHEN NOT regexp_full_match(o_orderpriority, '[1-5]-[A-Z]+') THEN 64 ELSE 0 END
  + CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 128 ELSE 0 END AS broken FROM orders)"""


def _checked(spark, sf_dir):
    return ct.checked(tables.read_table(spark, sf_dir, "orders"), ct.rule_table(spark, ORDER_RULES))


@query("quarantine", f"""WITH {_BROKEN}
SELECT o_orderkey, CAST(broken AS BIGINT) AS broken,
  array_to_string(list_filter([CASE WHEN broken & 1 > 0 THEN 'customer' END, CASE WHEN broken & 2 > 0 THEN 'date' END,
    CASE WHEN broken & 4 > 0 THEN 'day given' END, CASE WHEN broken & 8 > 0 THEN 'key' END, CASE WHEN broken & 16 > 0 THEN 'price' END,
    CASE WHEN broken & 32 > 0 THEN 'price given' END, CASE WHEN broken & 64 > 0 THEN 'priority' END,
    CASE WHEN broken & 128 > 0 THEN 'status' END], lambda x: x IS NOT NULL), ', ') AS rules
FROM bits WHERE broken > 0""")
def quarantine(spark, sf_dir):
    """Orders that break a rule of the contract, with the bits and names of the rules."""
    marked, names = _checked(spark, sf_dir)
    return ct.quarantined(marked, names).select("o_orderkey", "broken", F.array_join("broken_rules", ", ").alias("rules"))


@query("contract_balance", f"""WITH {_BROKEN}
SELECT CASE WHEN broken = 0 THEN 'accepted' ELSE 'quarantined' END AS outcome, count(*) AS n FROM bits GROUP BY 1""")
def contract_balance(spark, sf_dir):
    """How many orders went where; both together are the table."""
    marked, names = _checked(spark, sf_dir)
    sides = [(ct.accepted(marked), "accepted"), (ct.quarantined(marked, names), "quarantined")]
    both = [d.select(F.lit(name).alias("outcome")) for d, name in sides]
    return both[0].unionByName(both[1]).groupBy("outcome").agg(F.count("*").alias("n"))


@query("outlier_days", f"""WITH {Q.panel_ctes()},
near AS (SELECT series_id, dt, CAST(y AS DOUBLE) AS y, list_sort(list(CAST(y AS DOUBLE)) OVER (PARTITION BY series_id ORDER BY dt
           ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)) AS l FROM panel),
m AS (SELECT *, l[CAST(ceil(len(l) / 2) AS INTEGER)] AS median FROM near),
d AS (SELECT *, 1.4826 * list_sort(list_transform(l, lambda v: abs(v - median)))[CAST(ceil(len(l) / 2) AS INTEGER)] AS deviation FROM m)
SELECT series_id, dt, CAST(y AS BIGINT) AS y, median, round(deviation, 4) AS deviation FROM d WHERE abs(y - median) > 3 * deviation""")
def outlier_days(spark, sf_dir):
    """Days further than three scaled median deviations from the median of the two weeks around them."""
    found = ct.hampel(orders_panel(spark, sf_dir)).where("is_outlier")
    return round_doubles(found.select(S.SERIES, S.DT, S.Y, "median", "deviation"), 4)
