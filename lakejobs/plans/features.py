"""Feature queries: time windows, point-in-time lookups and match history."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.operators import match_features as mf
from lakejobs.operators.ordered import asof_join
from lakejobs.registry import query

MATCHES = ("matches",)

SIDES_SQL = """sides AS (
  SELECT match_id, match_date, 'home' AS side, home_team AS team, away_team AS opponent, home_score AS gf, away_score AS ga, tournament FROM matches
  UNION ALL SELECT match_id, match_date, 'away', away_team, home_team, away_score, home_score, tournament FROM matches),
long AS (SELECT *, CASE WHEN gf > ga THEN 2 WHEN gf = ga THEN 1 ELSE 0 END AS res FROM sides)"""

FORM_SQL = """
w AS (SELECT *, exp(-0.15 * greatest(date_diff('day', d, origin), 1) / 365.0) AS wt,
             CASE res WHEN 2 THEN 3 WHEN 1 THEN 1 ELSE 0 END AS pts FROM item)
SELECT {keys}, round(sum(wt * CAST(res = 2 AS INT)) / sum(wt), 4) AS form_w_wins, round(sum(wt * CAST(res = 1 AS INT)) / sum(wt), 4) AS form_w_draws,
       round(sum(wt * CAST(res = 0 AS INT)) / sum(wt), 4) AS form_w_losses, round(sum(wt * gf) / sum(wt), 4) AS form_w_gf,
       round(sum(wt * ga) / sum(wt), 4) AS form_w_ga, round(sum(wt * pts) / sum(wt), 4) AS form_w_pts,
       CASE WHEN max(n) >= 6 THEN round(CAST(sum(pts) FILTER (i > n - 5) AS BIGINT) / 5.0
            - CAST(sum(pts) FILTER (i <= n - 5) AS BIGINT) / CAST(max(n) - 5 AS DOUBLE), 4) ELSE CAST(0 AS DOUBLE) END AS form_momentum,
       CAST(max(n) AS INTEGER) AS form_matches
FROM w GROUP BY ALL"""


@query("win_last_n_decayed", views=MATCHES, sql=f"""
WITH {SIDES_SQL},
h AS (SELECT match_id, team, side, match_date AS origin, list({{'d': match_date, 'gf': gf, 'ga': ga, 'res': res}}) OVER
        (PARTITION BY team ORDER BY match_date, match_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS past FROM long),
item AS (SELECT match_id, team, side, origin, len(past) AS n, unnest(past, recursive := true), generate_subscripts(past, 1) AS i FROM h),
{FORM_SQL.format(keys='match_id, team, side')}
UNION ALL SELECT match_id, team, side, 0, 0, 0, 0, 0, 0, 0, 0 FROM h WHERE past IS NULL OR len(past) = 0""")
def win_last_n_decayed(t):
    return mf.recent_form(t.matches)


@query("agg_streaks_profile", views=MATCHES, sql=f"""
WITH {SIDES_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY match_date DESC, match_id DESC) AS back, count(*) OVER (PARTITION BY team) AS all_n FROM long),
item AS (SELECT team, match_date AS d, DATE '2001-09-01' AS origin, gf, ga, res, least(all_n, 10) AS n, least(all_n, 10) - back + 1 AS i FROM ranked WHERE back <= 10),
{FORM_SQL.format(keys='team')}""")
def agg_streaks_profile(t):
    return mf.team_profile(t.matches, "2001-09-01")


@query("win_h2h_smoothed", views=MATCHES, sql="""
WITH p AS (SELECT *, least(home_team, away_team) AS low, greatest(home_team, away_team) AS high,
                  CASE WHEN home_team < away_team THEN home_score - away_score ELSE away_score - home_score END AS lead FROM matches),
m AS (SELECT a.match_id, CASE WHEN a.home_team = a.low THEN b.lead ELSE -b.lead END AS own_lead,
             row_number() OVER (PARTITION BY a.match_id ORDER BY b.match_date DESC, b.match_id DESC) AS back
      FROM p a JOIN p b ON a.low = b.low AND a.high = b.high AND (b.match_date, b.match_id) < (a.match_date, a.match_id)),
s AS (SELECT match_id, count(*) AS n, count(*) FILTER (own_lead > 0) AS wins, CAST(sum(own_lead) AS BIGINT) AS total FROM m WHERE back <= 10 GROUP BY 1)
SELECT match_id, CAST(coalesce(n, 0) AS INTEGER) AS h2h_matches, round((coalesce(wins, 0) + 1.0) / CAST(coalesce(n, 0) + 2 AS DOUBLE), 4) AS h2h_smoothed_win_rate,
       CASE WHEN n IS NULL THEN CAST(0 AS DOUBLE) ELSE round(total / CAST(n AS DOUBLE), 4) END AS h2h_avg_goal_diff
FROM matches LEFT JOIN s USING (match_id)""")
def win_h2h_smoothed(t):
    return mf.head_to_head(t.matches)


@query("win_running_experience", views=MATCHES, sql=f"""
WITH {SIDES_SQL},
k AS (SELECT *, CASE tournament WHEN 'FIFA World Cup' THEN 'World Cup' WHEN 'FIFA World Cup qualification' THEN 'WC Qualifier'
                WHEN 'Copa América' THEN 'Continental Final' WHEN 'UEFA Nations League' THEN 'Nations League' ELSE 'Friendly' END AS kind FROM long)
SELECT match_id, team, side, kind, count(*) OVER (PARTITION BY team, kind ORDER BY match_date, match_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS experience FROM k""")
def win_running_experience(t):
    return mf.experience(t.matches)


@query("win_running_rate", views=MATCHES, sql=f"""
WITH {SIDES_SQL},
g AS (SELECT l.*, a.n_regionkey <> b.n_regionkey AS crossing FROM long l JOIN nation a ON l.team = a.n_nationkey JOIN nation b ON l.opponent = b.n_nationkey)
SELECT match_id, team, side, CAST(round(CAST(count(*) FILTER (crossing AND res = 2) OVER e / CAST(greatest(count(*) FILTER (crossing) OVER e, 1) AS DOUBLE) AS DECIMAL(20,10)), 4) AS DOUBLE) AS cross_win_rate
FROM g WINDOW e AS (PARTITION BY team ORDER BY match_date, match_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def win_running_rate(t):
    groups = t.nation.select(F.col("n_nationkey").alias("team"), F.col("n_regionkey").alias("group"))
    return mf.cross_group_rate(t.matches, groups)


@query("win_elo")
def win_elo(t):
    """Sequential ratings; compared with a plain loop in the tests (no SQL form)."""
    return mf.elo_history(t.matches)


@query("win_time_buckets", """
WITH hops AS (SELECT unnest([0, 15, 30, 45]) AS back),
slide AS (SELECT event_type, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01') - to_minutes(CAST(back AS BIGINT)) + INTERVAL 60 MINUTE AS until, value FROM events, hops),
tumble AS (SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL 30 MINUTE AS until FROM events)
SELECT 'sliding' AS kind, event_type, until, count(*) AS n, round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS mean_value, FALSE AS is_weekend FROM slide GROUP BY ALL
UNION ALL SELECT 'tumbling', event_type, until, count(*), CAST(NULL AS DOUBLE), dayofweek(until) IN (0, 6) FROM tumble GROUP BY ALL""")
def win_time_buckets(t):
    """Sliding hour means every 15 minutes and tumbling half-hour counts, both keyed by the window end."""
    return window_features(t.events)


def window_features(events):
    mean = F.round(F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count("*"), 4)
    sliding = events.groupBy("event_type", F.window("ts", "1 hour", "15 minutes").alias("w")).agg(
        F.count("*").alias("n"), mean.alias("mean_value")
    ).select(F.lit("sliding").alias("kind"), "event_type", F.col("w.end").alias("until"), "n", "mean_value",
             F.lit(False).alias("is_weekend"))
    tumbling = events.groupBy("event_type", F.window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select(
        F.lit("tumbling").alias("kind"), "event_type", F.col("w.end").alias("until"), "n",
        F.lit(None).cast("double").alias("mean_value"), F.dayofweek("w.end").isin(1, 7).alias("is_weekend"))
    return sliding.unionByName(tumbling)


@query("join_asof_feature", """
WITH f AS (SELECT user_id, ts AS feature_ts, value AS feature_value FROM events WHERE event_type = 'click'),
e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT e.event_id, e.user_id, e.ts, f.feature_ts, f.feature_value FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.feature_ts""")
def join_asof_feature(t):
    """Newest click of the user at or before each purchase."""
    features = t.events.where("event_type = 'click'").select(
        "user_id", F.col("ts").alias("feature_ts"), F.col("value").alias("feature_value"))
    labels = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return asof_join(labels, features, ["user_id"], "ts", "feature_ts", ["feature_ts", "feature_value"])
