"""Queries of §M: decision panels, folds and evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelake.operators import panel as M
from outcomelake.operators.positions import compute_player_stats, select_top_n
from outcomelake.plans.fixtures import market_outcomes, markets, trades
from outcomelake.plans.positions_queries import rounded
from outcomelake.plans.registry import query
from outcomelake.session import materialize, shared_folder

WINDOW, HORIZON, FRAC = 7, 1, 0.5
_MEANS = ("mean_buy_price_t1", "mean_buy_price_t2", "mean_sell_price_t1", "mean_sell_price_t2", "consensus_score")

_PLAYERS = "SELECT player FROM stats ORDER BY score_c DESC NULLS LAST, player LIMIT 8"
_ACTIVE = f"""
  SELECT t.*, maker IN ({_PLAYERS}) AS maker_active, taker IN ({_PLAYERS}) AS taker_active
  FROM trades t WHERE maker IN ({_PLAYERS}) OR taker IN ({_PLAYERS})"""
_GRID = f"""
  SELECT unnest(CASE WHEN lo < hi THEN generate_series(lo // 86400 * 86400, hi // 86400 * 86400, 86400)
                     ELSE [] END) AS decision_ts
  FROM (SELECT min(timestamp) + 7 * 86400 AS lo, max(timestamp) - 86400 AS hi FROM ({_ACTIVE}))"""
_CTES = f"""
  active AS (SELECT *, CASE WHEN nonusdc_side <> 'token1' THEN 0 WHEN maker_direction = 'BUY' THEN token_amount
                            ELSE -token_amount END AS signed_t1 FROM ({_ACTIVE})),
  grid AS ({_GRID}),
  win AS (SELECT g.decision_ts, a.* FROM grid g JOIN active a
          ON a.timestamp >= g.decision_ts - 7 * 86400 AND a.timestamp < g.decision_ts),
  per_player AS (SELECT decision_ts, market_id, player, sum(s) AS net, bool_or(t1) AS t1 FROM (
      SELECT decision_ts, market_id, maker AS player, signed_t1 AS s, nonusdc_side = 'token1' AS t1
      FROM win WHERE maker_active
      UNION ALL SELECT decision_ts, market_id, taker, signed_t1, nonusdc_side = 'token1' FROM win WHERE taker_active)
    GROUP BY 1, 2, 3),
  feats AS (SELECT * FROM (
    SELECT decision_ts, market_id,
      avg(price) FILTER (nonusdc_side = 'token1' AND maker_direction = 'BUY') AS mean_buy_price_t1,
      avg(price) FILTER (nonusdc_side = 'token2' AND maker_direction = 'BUY') AS mean_buy_price_t2,
      avg(price) FILTER (nonusdc_side = 'token1' AND maker_direction = 'SELL') AS mean_sell_price_t1,
      avg(price) FILTER (nonusdc_side = 'token2' AND maker_direction = 'SELL') AS mean_sell_price_t2,
      usd_(coalesce(sum(micro_(usd_amount)) FILTER (nonusdc_side = 'token1'), 0)) AS usd_volume_t1,
      usd_(coalesce(sum(micro_(usd_amount)) FILTER (nonusdc_side = 'token2'), 0)) AS usd_volume_t2,
      usd_(sum(micro_(signed_t1))) AS net_token1_position,
      CAST(count(*) FILTER (nonusdc_side = 'token1' AND maker_direction = 'BUY') AS DOUBLE) AS n_buys_t1,
      CAST(count(*) FILTER (nonusdc_side = 'token1' AND maker_direction = 'SELL') AS DOUBLE) AS n_sells_t1,
      CAST(count(*) FILTER (nonusdc_side = 'token2' AND maker_direction = 'BUY') AS DOUBLE) AS n_buys_t2,
      CAST(count(*) FILTER (nonusdc_side = 'token2' AND maker_direction = 'SELL') AS DOUBLE) AS n_sells_t2,
      arg_max(price, (timestamp, orderfilled_id)) FILTER (nonusdc_side = 'token1') AS last_price_t1
    FROM win GROUP BY 1, 2)
    JOIN (SELECT decision_ts, market_id, CAST(count(*) AS DOUBLE) AS n_players_active,
                 count(*) FILTER (t1 AND net > 0) / nullif(CAST(count(*) FILTER (t1) AS DOUBLE), 0) AS consensus_score
          FROM per_player GROUP BY 1, 2) USING (decision_ts, market_id)),
  panel AS (SELECT f.*, m.ticker, m.question, o.resolved_at AS closed_ts,
                   CASE WHEN o.resolved_at >= decision_ts AND o.resolved_at < decision_ts + 86400
                        THEN CASE winner_token WHEN 'token1' THEN 'YES' ELSE 'NO' END ELSE 'PASS' END AS target
            FROM feats f LEFT JOIN market_outcomes o USING (market_id) LEFT JOIN markets m ON m.id = f.market_id
            WHERE n_players_active >= ceil(0.5 * (SELECT count(*) FROM ({_PLAYERS}))))"""
_VIEWS = ("trades", "stats", "market_outcomes", "markets")


def _sql(tail: str) -> str:
    """``tail`` over the panel CTEs, which follow the fixture CTEs."""
    from outcomelake.plans.fixtures import expand_macros, with_ctes

    head = with_ctes("SELECT 1", *_VIEWS).rsplit("\nSELECT 1", 1)[0]
    return expand_macros(f"{head},\n{_CTES}\n{tail}")


def _players(spark, sf):
    return select_top_n(compute_player_stats(trades(spark, sf)), n=8, min_win_rate=-1.0, min_n_bets=1)


def _panel_inputs(spark, sf):
    """The panel's players and fills, stored because every step reads them."""
    players = materialize(_players(spark, sf), "players")
    active = materialize(M.mark_panel_players(trades(spark, sf), players), "active")
    return players, active, M.decision_grid(M.panel_bounds(active, WINDOW, HORIZON))


def _panel(spark, sf):
    players, active, grid = _panel_inputs(spark, sf)
    features = M.active_fraction_gate(M.panel_features(active, grid, WINDOW), players, FRAC)
    outcomes = market_outcomes(spark, sf)
    closings = outcomes.withColumnRenamed("resolved_at", "closed_ts")
    return players, M.label_panel(features, markets(spark, sf), outcomes, closings, WINDOW, HORIZON)


@query("m01_decision_grid", _sql("SELECT decision_ts FROM grid"))
def _(spark, sf):
    return _panel_inputs(spark, sf)[2]


@query("m02_panel_windows", _sql("""
  SELECT decision_ts, market_id, count(*) AS n_trades, usd_(sum(micro_(usd_amount))) AS usd_volume
  FROM win GROUP BY 1, 2"""))
def _(spark, sf):
    from outcomelake.functions import from_micros, micros

    _, active, grid = _panel_inputs(spark, sf)
    daily = active.groupBy((F.col("timestamp") - F.col("timestamp") % 86_400).alias("day"), "market_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(micros("usd_amount")).alias("u")
    )
    return M.in_decision_windows(daily, grid, WINDOW).groupBy("decision_ts", "market_id").agg(
        F.sum("n").alias("n_trades"), from_micros(F.sum("u")).alias("usd_volume")
    )


def _feature_list(digits: int = 9) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" if c in _MEANS else c for c in M.FEATURE_NAMES)


@query("m03_panel_features", _sql(f"SELECT decision_ts, market_id, {_feature_list()} FROM feats"))
def _(spark, sf):
    _, active, grid = _panel_inputs(spark, sf)
    return rounded(M.panel_features(active, grid, WINDOW), *_MEANS, digits=9)


@query("m04_active_players", _sql("""
  SELECT decision_ts, market_id, n_players_active, round(consensus_score, 9) AS consensus_score FROM feats"""))
def _(spark, sf):
    _, active, grid = _panel_inputs(spark, sf)
    out = M.panel_features(active, grid, WINDOW)
    return rounded(out.select("decision_ts", "market_id", "n_players_active", "consensus_score"),
                   "consensus_score", digits=9)


@query("m05_active_fraction_gate", _sql("""
  SELECT decision_ts, market_id, n_players_active FROM feats
  WHERE n_players_active >= ceil(0.5 * (SELECT count(*) FROM (SELECT player FROM stats ORDER BY score_c
    DESC NULLS LAST, player LIMIT 8)))"""))
def _(spark, sf):
    players, active, grid = _panel_inputs(spark, sf)
    gated = M.active_fraction_gate(M.panel_features(active, grid, WINDOW), players, FRAC)
    return gated.select("decision_ts", "market_id", "n_players_active")


def _epochs(df):
    out = df
    for c in ("decision_date", "window_start", "window_end", "target_resolved_at"):
        out = out.withColumn(c, F.coalesce(F.unix_seconds(c), F.lit(-1)))
    return rounded(out.withColumn("target_binary", F.coalesce("target_binary", F.lit(-1))), *_MEANS, digits=9)


_LABELLED = f"""
  SELECT decision_ts AS decision_date, market_id, ticker, question, decision_ts - 7 * 86400 AS window_start,
         decision_ts AS window_end, {_feature_list()}, target,
         CAST(CASE target WHEN 'YES' THEN 1 WHEN 'NO' THEN 0 ELSE -1 END AS BIGINT) AS target_binary,
         target <> 'PASS' AS resolves_within_horizon, coalesce(closed_ts, -1) AS target_resolved_at{{extra}}
  FROM panel"""
_IS_TEST = """(SELECT decision_ts, i >= greatest(1, CAST(floor(n * 0.8) AS BIGINT)) OR n < 2 AS is_test
  FROM (SELECT decision_ts, row_number() OVER (ORDER BY decision_ts) - 1 AS i, count(*) OVER () AS n
        FROM (SELECT DISTINCT decision_ts FROM panel)))"""


@query("m06_panel_targets", _sql(_LABELLED.format(extra="")))
def _(spark, sf):
    return _epochs(_panel(spark, sf)[1])


@query("m07_temporal_split", _sql(f"""
  SELECT decision_ts AS decision_date, market_id, target, is_test FROM panel JOIN {_IS_TEST} USING (decision_ts)"""))
def _(spark, sf):
    split = M.temporal_split(materialize(_panel(spark, sf)[1], "panel"), 0.2)
    return split.select(F.unix_seconds("decision_date").alias("decision_date"), "market_id", "target", "is_test")


_META = ", ".join(
    f"count(*) FILTER ({'' if t == 'test' else 'NOT '}is_test{c}) AS n_{t}_{n}"
    for t in ("train", "test")
    for n, c in (("rows", ""), ("yes", " AND target = 'YES'"), ("no", " AND target = 'NO'"),
                 ("pass", " AND target = 'PASS'"))
)


@query("m08_dataset_meta", _sql(f"""
  SELECT '*' AS category, 7 AS window_days, 1 AS horizon_days, 0.5::DOUBLE AS min_active_frac,
         (SELECT count(*) FROM ({_PLAYERS})) AS n_players,
         strftime(to_timestamp(min(decision_ts) FILTER (is_test)) AT TIME ZONE 'UTC', '%Y-%m-%d') AS split_date, {_META},
         14 AS n_features, '{",".join(M.FEATURE_NAMES)}' AS feature_names
  FROM panel JOIN {_IS_TEST} USING (decision_ts)"""))
def _(spark, sf):
    players = materialize(_players(spark, sf), "players")
    return M.build_dataset(
        trades(spark, sf), markets(spark, sf), players, market_outcomes(spark, sf),
        window_days=WINDOW, horizon_days=HORIZON, min_active_frac=FRAC,
    ).meta


@query("m09_load_split", _sql(f"""
  SELECT market_id, decision_ts AS decision_date, is_test, target,
         round({' + '.join(f'coalesce({c}, -1)' for c in M.FEATURE_NAMES)}, 6) AS feature_sum
  FROM panel JOIN {_IS_TEST} USING (decision_ts)"""))
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    players = materialize(_players(spark, sf), "players")
    panel = M.build_dataset(
        trades(spark, sf), markets(spark, sf), players, market_outcomes(spark, sf),
        window_days=WINDOW, horizon_days=HORIZON, min_active_frac=FRAC,
    )
    root = shared_folder(spark, "panels")
    M.save_split(panel, root, "all", WINDOW, HORIZON)
    split = M.load_split(spark, root, "all", WINDOW, HORIZON)
    both = split.train.withColumn("is_test", F.lit(False)).unionByName(
        split.test.withColumn("is_test", F.lit(True))
    )
    total = F.aggregate(
        vector_to_array("features"), F.lit(0.0), lambda a, x: a + F.when(F.isnan(x), -1.0).otherwise(x)
    )
    return both.select(
        "market_id", F.unix_seconds("decision_date").alias("decision_date"), "is_test", "target",
        F.round(total, 6).alias("feature_sum"),
    )


_SNAPSHOTS = """
  SELECT market_id, winner_token, resolved_at, max(timestamp) AS decision_ts,
         arg_max(price, (timestamp, orderfilled_id)) AS market_price,
         CAST(winner_token = 'token1' AS BIGINT) AS target
  FROM trades JOIN market_outcomes USING (market_id)
  WHERE nonusdc_side = 'token1' AND timestamp < resolved_at - 86400 GROUP BY 1, 2, 3"""
_FOLDS = f"""
  SELECT fold, max(CASE WHEN i = a - 1 THEN d END) AS train_end_ts, max(CASE WHEN i = a THEN d END) AS test_start_ts,
         max(CASE WHEN i = b THEN d END) AS test_end_ts
  FROM (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n
        FROM (SELECT DISTINCT decision_ts AS d FROM ({_SNAPSHOTS})))
  JOIN (SELECT fold, 1 + fold * (n - 2) // 3 AS a, 1 + (fold + 1) * (n - 2) // 3 AS b
        FROM (VALUES (0), (1), (2)) AS f(fold), (SELECT count(DISTINCT decision_ts) AS n FROM ({_SNAPSHOTS}))
        WHERE n >= 4) ON i IN (a - 1, a, b) AND b > a GROUP BY fold"""
_SNAP_VIEWS = ("trades", "market_outcomes")


def _snapshots(spark, sf):
    return M.decision_snapshots(trades(spark, sf), market_outcomes(spark, sf))


def _snapshots_and_folds(spark, sf):
    snaps = materialize(_snapshots(spark, sf), "snapshots")
    return snaps, M.expanding_folds(snaps, "decision_ts", 3)


@query("m10_expanding_folds", f"SELECT CAST(fold AS BIGINT) AS fold, * EXCLUDE (fold) FROM ({_FOLDS})", _SNAP_VIEWS)
def _(spark, sf):
    folds = _snapshots_and_folds(spark, sf)[1]
    return folds.withColumn("fold", F.col("fold").cast("long"))


@query("m11_fold_players", """
  SELECT player, n_bets, round(win_rate, 6) AS win_rate, round(score_c, 6) AS score FROM (
    SELECT *, n_won + n_lost AS n_bets, n_won / CAST(n_won + n_lost AS DOUBLE) AS win_rate,
           n_won / CAST(n_won + n_lost AS DOUBLE) * ln(greatest(w, 1.0)) AS score_c
    FROM (SELECT player, count(*) FILTER (o = 'won') AS n_won, count(*) FILTER (o = 'lost') AS n_lost,
                 usd_(coalesce(sum(micro_(pnl)) FILTER (o = 'won'), 0)) AS w
          FROM (SELECT player, net_usd + net_tokens * CASE WHEN token_side = winner_token THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pnl,
                       CASE WHEN net_tokens = 0 THEN 'flat' WHEN (net_tokens > 0) = (token_side = winner_token)
                            THEN 'won' ELSE 'lost' END AS o
                FROM (SELECT player, market_id, token_side, usd_(sum(micro_(signed_tokens))) AS net_tokens,
                             usd_(sum(micro_(signed_usd))) AS net_usd
                      FROM positions WHERE timestamp < 1705622400 GROUP BY 1, 2, 3)
                JOIN market_outcomes USING (market_id) WHERE resolved_at < 1705622400)
          WHERE o <> 'flat' GROUP BY 1))
  WHERE win_rate > 0.3 AND n_bets >= 5 ORDER BY score_c DESC NULLS LAST, player LIMIT 10""",
       ("positions", "market_outcomes"))
def _(spark, sf):
    # 1705622400 is 2024-01-19 UTC, between the first and the last resolution.
    best = M.select_fold_players(
        trades(spark, sf), market_outcomes(spark, sf), 1705622400, n=10, min_win_rate=0.3, min_n_bets=5
    )
    return best.select("player", "n_bets", F.round("win_rate", 6).alias("win_rate"),
                       F.round("score", 6).alias("score"))


_SCORED = f"""
  SELECT t.fold, t.market_id, t.market_price, t.target AS y, model, CASE model WHEN 'market_price' THEN t.market_price ELSE rate END AS p
  FROM (SELECT f.*, s.* FROM ({_FOLDS}) f JOIN ({_SNAPSHOTS}) s
        ON s.decision_ts BETWEEN f.test_start_ts AND f.test_end_ts) t
  JOIN (SELECT fold, avg(target) AS rate FROM ({_FOLDS}) f JOIN ({_SNAPSHOTS}) s ON s.resolved_at < f.train_end_ts
        GROUP BY fold HAVING count(*) >= 8 AND count(DISTINCT target) = 2) USING (fold),
  (VALUES ('market_price'), ('majority')) AS m(model)"""


def _scored(spark, sf):
    snaps, folds = _snapshots_and_folds(spark, sf)
    return M.relational_baselines(M.fold_members(snaps, folds))


@query("m12_probability_metrics", f"""
  SELECT CAST(fold AS BIGINT) AS fold, model, count(*) AS support,
         round(avg(-ln(CASE WHEN y = 1 THEN q ELSE 1 - q END)), 9) AS log_loss,
         round(avg((q - y) * (q - y)), 9) AS brier
  FROM (SELECT *, greatest(0.000001::DOUBLE, least(1 - 0.000001::DOUBLE, p)) AS q FROM ({_SCORED})) GROUP BY 1, 2""",
       _SNAP_VIEWS)
def _(spark, sf):
    out = M.probability_metrics(_scored(spark, sf), by=["fold", "model"])
    return rounded(out, "log_loss", "brier", digits=9).withColumn("fold", F.col("fold").cast("long"))


@query("m13_evaluate_edge", f"""
  SELECT CAST(fold AS BIGINT) AS fold, market_id, market_price, y, round(p, 9) AS p,
         round(p - market_price, 9) AS edge, p - market_price > 0.05 AS take
  FROM ({_SCORED}) WHERE model = 'majority'""", _SNAP_VIEWS)
def _(spark, sf):
    majority = _scored(spark, sf).where("model = 'majority'").drop("model")
    out = M.evaluate_edge(majority, threshold=0.05)
    return rounded(out, "p", "edge", digits=9).withColumn("fold", F.col("fold").cast("long"))


@query("m14_decision_snapshots", _SNAPSHOTS, _SNAP_VIEWS)
def _(spark, sf):
    return _snapshots(spark, sf)


@query("m15_relational_baselines", f"""
  SELECT CAST(fold AS BIGINT) AS fold, market_id, market_price, y, model, round(p, 9) AS p FROM ({_SCORED})""",
       _SNAP_VIEWS)
def _(spark, sf):
    return rounded(_scored(spark, sf), "p", digits=9).withColumn("fold", F.col("fold").cast("long"))


def _logistic_sql(steps: int = 12) -> str:
    """Newton's steps one after the other, each an aggregate over all folds."""
    out = f"""
  WITH counts AS MATERIALIZED (
    SELECT fold, s.market_price AS x, s.target AS y, count(*) AS n FROM ({_FOLDS}) f JOIN ({_SNAPSHOTS}) s ON s.resolved_at < f.train_end_ts
    WHERE fold IN (SELECT fold FROM ({_SCORED})) GROUP BY 1, 2, 3),
  fit0 AS (SELECT DISTINCT fold, 0.0::DOUBLE AS b, 0.0::DOUBLE AS w FROM counts)"""
    for k in range(steps):
        out += f""",
  fit{k + 1} AS MATERIALIZED (
    SELECT fold, b - (hww * gb - hbw * gw) / (hbb * hww - hbw * hbw) AS b, w - (hbb * gw - hbw * gb) / (hbb * hww - hbw * hbw) AS w
    FROM (SELECT fold, b, w, sum(n * (p - y)) AS gb, sum(n * (p - y) * x) + w AS gw, sum(n * p * (1 - p)) AS hbb,
                 sum(n * p * (1 - p) * x) AS hbw, sum(n * p * (1 - p) * x * x) + 1 AS hww
          FROM (SELECT *, 1 / (1 + exp(-(b + w * x))) AS p FROM counts JOIN fit{k} USING (fold)) GROUP BY 1, 2, 3))"""
    return out + f"""
  SELECT CAST(fold AS BIGINT) AS fold, market_id, market_price, y, round(1 / (1 + exp(-(b + w * market_price))), 6) AS p
  FROM ({_SCORED}) JOIN fit{steps} USING (fold) WHERE model = 'majority'"""


@query("m15_logistic", f"SELECT * FROM ({_logistic_sql()})", _SNAP_VIEWS)
def _(spark, sf):
    snaps, folds = _snapshots_and_folds(spark, sf)
    out = M.logistic_baseline(materialize(M.fold_members(snaps, folds), "members")).drop("model")
    return rounded(out, "p", digits=6).withColumn("fold", F.col("fold").cast("long"))


@query("m15_model_baselines")
def _(spark, sf):
    snaps, folds = _snapshots_and_folds(spark, sf)
    members = materialize(M.fold_members(snaps, folds), "members")
    fitted = [M.model_baselines(members, r.fold) for r in folds.select("fold").orderBy("fold").collect()]
    scored = [f for f in fitted if f is not None]
    out = reduce(DataFrame.unionByName, scored)
    return M.probability_metrics(out, by=["fold", "model"])
