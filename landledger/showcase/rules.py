"""The quality engine on the plain tables, with rules of each kind."""

from __future__ import annotations

from pyspark.sql import functions as F

from landledger.operators import quality as q
from landledger.showcase.registry import query

EVENT_RULES = [
    q.one_of("e1", "event_type", ["view", "click", "purchase", "signup"], q.HARD_FAIL),
    q.Rule("e2", "value is positive", q.HARD_FAIL, "value <= 0"),
    q.Rule("e3", "value is unusually high", q.WARNING, "value > 300"),
    q.NoDuplicates("e4", "no repeated readings"),
    q.Coverage("user", "user_id", 1.0),
]


@query(
    "quality_rules_events",
    """WITH readings AS (SELECT user_id, event_type, round(value, 0) AS value FROM events)
    SELECT 'e1' AS rule_id, 'event_type: one of 4 known values or nothing' AS description, 'HARD FAIL' AS severity,
      count(*) FILTER (WHERE event_type = 'error') AS violation_count,
      count(*) FILTER (WHERE event_type = 'error') = 0 AS passed FROM readings
    UNION ALL SELECT 'e2', 'value is positive', 'HARD FAIL', count(*) FILTER (WHERE value <= 0),
      count(*) FILTER (WHERE value <= 0) = 0 FROM readings
    UNION ALL SELECT 'e3', 'value is unusually high', 'WARNING', count(*) FILTER (WHERE value > 300), TRUE FROM readings
    UNION ALL SELECT 'e4', 'no repeated readings', 'HARD FAIL', count(*) - count(DISTINCT readings),
      count(*) = count(DISTINCT readings) FROM readings
    UNION ALL SELECT '5-user', 'user_id: present in 100% or more of the rows, here in 100.0%', 'HARD FAIL', 0, TRUE""",
)
def quality_rules_events(t):
    return q.quality_report(t.events.selectExpr("user_id", "event_type", "round(value, 0) AS value"), EVENT_RULES)


@query(
    "quality_rules_by_type",
    """SELECT event_type, r.* FROM (
      SELECT event_type, count(*) FILTER (WHERE value <= 0) AS low, count(*) FILTER (WHERE value > 300) AS high
      FROM events GROUP BY event_type), LATERAL (
      SELECT 'e2' AS rule_id, 'value is positive' AS description, 'HARD FAIL' AS severity,
        low AS violation_count, low = 0 AS passed
      UNION ALL SELECT 'e3', 'value is unusually high', 'WARNING', high, TRUE) r""",
)
def quality_rules_by_type(t):
    return q.quality_report(t.events, EVENT_RULES[1:3], by=["event_type"])


@query(
    "violating_rows",
    "SELECT event_id, event_type, value FROM events WHERE event_type = 'error'",
)
def violating_rows(t):
    return q.violating_rows(t.events.select("event_id", "event_type", "value"), EVENT_RULES[0])


@query(
    "violating_values",
    """SELECT event_type, CAST(user_id % 10 AS BIGINT) AS last_digit, count(*) AS violation_count
    FROM events WHERE value > 300 GROUP BY ALL""",
)
def violating_values(t):
    digit = F.pmod("user_id", F.lit(10)).cast("bigint").alias("last_digit")
    return q.violating_values(t.events, EVENT_RULES[2], ["event_type", digit])
