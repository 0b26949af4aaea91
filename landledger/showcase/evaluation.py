"""Preparing and judging a price model, on the sales of the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from landledger.operators import evaluation, rollup
from landledger.showcase.prices import COLUMNS, PRICED, sale_lines
from landledger.showcase.registry import query

CUT = dt.date(1996, 1, 1)

SPLIT = f"""{PRICED},
train AS (SELECT * FROM priced WHERE sale_date < DATE '1996-01-01' AND nation < 20),
test AS (SELECT * FROM priced WHERE sale_date >= DATE '1996-01-01'),
medians AS (SELECT nation, quantile_disc(price_per_sqm, 0.5) AS own FROM train GROUP BY nation),
predicted AS (
  SELECT sale_id, region, price_per_sqm, own IS NOT NULL AS predicted_from_area,
    coalesce(own, (SELECT quantile_disc(price_per_sqm, 0.5) FROM train)) AS predicted
  FROM test LEFT JOIN medians USING (nation))
"""


def predictions(t):
    """Nations from 20 on have no training sales."""
    sales = evaluation.chronological_split(rollup.priced_transactions(sale_lines(t), COLUMNS), "sale_date", CUT)
    train = sales.filter((F.col("part") == evaluation.TRAIN) & (F.col("nation") < 20))
    test = sales.filter(F.col("part") == evaluation.TEST)
    return evaluation.naive_baseline(train, test, "nation", rollup.PRICE)


@query(
    "eligible_sales",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def eligible_sales(t):
    kept = evaluation.eligible(t.orders, {"o_orderstatus": ["F"], "o_orderpriority": ["1-URGENT", "2-HIGH"]})
    return kept.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "chronological_split",
    """SELECT o_orderkey, CASE WHEN o_orderdate < DATE '1996-01-01' THEN 'train'
      WHEN CAST(o_orderdate AS DATE) <= DATE '1997-06-30' THEN 'test' END AS part FROM orders""",
)
def chronological_split(t):
    dated = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return evaluation.chronological_split(dated, "day", CUT, dt.date(1997, 6, 30)).drop("day")


@query(
    "as_of_label",
    """SELECT p.event_id, c.event_id AS label_id, c.value AS label_value FROM
      (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') p
      LEFT JOIN LATERAL (SELECT event_id, value FROM events e WHERE event_type = 'click' AND e.user_id = p.user_id
        AND CAST(e.ts AS DATE) <= CAST(p.ts AS DATE)
        ORDER BY CAST(e.ts AS DATE) DESC, event_id DESC LIMIT 1) c ON TRUE""",
)
def as_of_label(t):
    """The newest click of a user on or before the day of each purchase."""
    day = F.col("ts").cast("date").alias("day")
    sales = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", day)
    labels = t.events.filter("event_type = 'click'").select(
        "user_id", day, F.col("event_id").alias("label_id"), F.col("value").alias("label_value")
    )
    found = evaluation.as_of(sales, labels, "user_id", "day", "user_id", "day", ["label_id", "label_value"], ["label_id"])
    return found.drop("user_id", "day")


@query("naive_baseline", f"WITH {SPLIT} SELECT sale_id, predicted, predicted_from_area FROM predicted")
def naive_baseline(t):
    return predictions(t).select("sale_id", "predicted", "predicted_from_area")


@query(
    "error_measures",
    f"""WITH {SPLIT} SELECT region, count(*) AS n,
      round(avg(abs(predicted - price_per_sqm)), 4) AS mae,
      round(sqrt(avg((predicted - price_per_sqm) ** 2)), 4) AS rmse,
      round(avg(abs((predicted - price_per_sqm) / price_per_sqm) * 100), 4) AS mape,
      round(1 - sum((predicted - price_per_sqm) ** 2) / (var_pop(price_per_sqm) * count(*)), 6) AS r2
    FROM predicted GROUP BY region""",
)
def error_measures(t):
    measures = evaluation.error_measures(predictions(t), rollup.PRICE, "predicted", ["region"])
    digits = {"mae": 4, "rmse": 4, "mape": 4, "r2": 6}
    return measures.withColumns({c: F.round(c, d) for c, d in digits.items()})
