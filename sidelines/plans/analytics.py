"""The analytic queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sidelines.functions import scalars as S
from sidelines.operators.history import Following, Previous, Rolling, RowsInFrame, Running, with_staged_history
from sidelines.operators.ranking import ntile
from sidelines.session import written
from sidelines.operators.schedule import completed, team_long

MIN_MINUTES = 10
DECLINE_THRESHOLD = 0.05
TEAM_ORDER = ["game_date", "game_id"]
PLAYER_ORDER = ["game_date", "game_id"]


def rolling_team_win_pct(games: DataFrame, teams: DataFrame) -> DataFrame:
    """Each team's share of wins over its last 10 contests, the current one included."""
    rows = (team_long(completed(games)).select("team_id", "game_date", "game_id", "won")
            .withColumn("_won", F.col("won").cast("int")))
    rolled = with_staged_history(rows, "team_id", TEAM_ORDER,
                                 {"_pct": Rolling("_won", 10), "games_in_window": RowsInFrame(10)})
    return (rolled.join(teams.select("team_id", "abbreviation"), "team_id")
            .select("team_id", "abbreviation", "game_date", "game_id", "won",
                    S.round_half_up("_pct", 3).alias("rolling_10_win_pct"), "games_in_window")
            .orderBy("team_id", "game_date", "game_id"))


def player_efficiency_decline(stats: DataFrame, games: DataFrame, players: DataFrame) -> DataFrame:
    """Games in which a player's last-5 TS% is more than 0.05 below their average so far.

    The average runs over the whole career, not the season. Names are joined to the few rows that remain.
    """
    rows = (_long_outings(stats).select("player_id", "game_id", S.true_shooting().alias("_ts"))
            .join(games.select("game_id", "game_date"), "game_id"))
    rolled = with_staged_history(rows, "player_id", PLAYER_ORDER,
                                 {"_recent": Rolling("_ts", 5), "_base": Running("_ts")})
    return (rolled.filter(F.col("_recent") < F.col("_base") - DECLINE_THRESHOLD)
            .join(players.select("player_id", "full_name"), "player_id")
            .select("player_id", "full_name", "game_id", "game_date",
                    S.round_half_up("_ts", 3).alias("ts_pct"),
                    S.round_half_up("_recent", 3).alias("rolling_5_ts_pct"),
                    S.round_half_up("_base", 3).alias("season_to_date_ts_pct"),
                    S.round_half_up(F.col("_recent") - F.col("_base"), 3).alias("decline_gap"))
            .orderBy("decline_gap", "player_id", "game_id"))


def _long_outings(stats: DataFrame) -> DataFrame:
    return stats.filter(F.col("minutes") >= MIN_MINUTES)


def _home_and_away(games: DataFrame) -> DataFrame:
    """Per team: contests, wins and mean margin at home and away. One scan, one shuffle of partial sums.

    Teams that never played at home or never away are left out.
    """
    home = F.col("is_home")
    margin = F.col("team_score") - F.col("opponent_score")
    return (team_long(completed(games)).groupBy("team_id")
            .agg(F.count_if(home).alias("home_games"), F.count_if(home & F.col("won")).alias("home_wins"),
                 F.avg(F.when(home, margin)).alias("_home_margin"),
                 F.count_if(~home).alias("away_games"), F.count_if(~home & F.col("won")).alias("away_wins"),
                 F.avg(F.when(~home, margin)).alias("_away_margin"))
            .filter("home_games > 0 and away_games > 0"))


def _edge() -> Column:
    return S.safe_ratio("home_wins", "home_games") - S.safe_ratio("away_wins", "away_games")


def home_away_splits(games: DataFrame, teams: DataFrame) -> DataFrame:
    return (_home_and_away(games).join(teams.select("team_id", "abbreviation"), "team_id")
            .select("team_id", "abbreviation", "home_games", "home_wins",
                    S.round_half_up(S.safe_ratio("home_wins", "home_games"), 3).alias("home_win_pct"),
                    S.round_half_up("_home_margin", 2).alias("home_avg_margin"),
                    "away_games", "away_wins",
                    S.round_half_up(S.safe_ratio("away_wins", "away_games"), 3).alias("away_win_pct"),
                    S.round_half_up("_away_margin", 2).alias("away_avg_margin"),
                    S.round_half_up(_edge(), 3).alias("home_court_edge"))
            .orderBy(F.desc("home_court_edge"), "team_id"))


def home_edge(games: DataFrame, teams: DataFrame) -> DataFrame:
    return (_home_and_away(games).join(teams.select("team_id", "abbreviation"), "team_id")
            .select("abbreviation", S.round_half_up(_edge(), 3).alias("home_court_edge"))
            .orderBy(F.desc("home_court_edge"), "abbreviation"))


def team_shooting(stats: DataFrame) -> DataFrame:
    """Share of field goals made per team and contest: a ratio of sums."""
    return (stats.groupBy("game_id", "team_id")
            .agg(F.sum("fgm").alias("_made"), F.sum("fga").alias("_attempted"))
            .select("game_id", "team_id", S.safe_ratio("_made", "_attempted").alias("team_fg_pct")))


def days_rest(games: DataFrame) -> DataFrame:
    """Days since each team's previous contest. A team's first contest is dropped."""
    rows = team_long(completed(games)).select("team_id", "game_id", "game_date")
    return (with_staged_history(rows, "team_id", TEAM_ORDER, {"_previous": Previous("game_date")})
            .filter(F.col("_previous").isNotNull())
            .withColumn("days_rest", F.datediff("game_date", "_previous")).drop("_previous"))


def back_to_back_fatigue(games: DataFrame, stats: DataFrame) -> DataFrame:
    return (days_rest(games).join(team_shooting(stats), ["game_id", "team_id"])
            .groupBy(S.rest_bucket("days_rest", "back_to_back (1 day rest)").alias("rest_bucket"))
            .agg(F.count("*").alias("n_games"), S.round_half_up(F.avg("team_fg_pct"), 4).alias("avg_team_fg_pct"),
                 F.min("days_rest").alias("_sort"))
            .orderBy("_sort").drop("_sort"))


def back_to_back_summary(team_features: DataFrame, stats: DataFrame) -> DataFrame:
    """The same from the team feature table, for the dashboard."""
    return (team_features.filter(F.col("days_rest").isNotNull()).select("game_id", "team_id", "days_rest")
            .join(team_shooting(stats), ["game_id", "team_id"])
            .groupBy(S.rest_bucket("days_rest", "Back-to-back (1 day rest)").alias("rest_bucket"))
            .agg(F.min("days_rest").alias("sort_key"), F.count("*").alias("n_games"),
                 S.round_half_up(F.avg("team_fg_pct"), 4).alias("avg_team_fg_pct"))
            .orderBy("sort_key"))


def load_and_next(stats: DataFrame, games: DataFrame, tracking: DataFrame) -> DataFrame:
    """Each long outing's load and the TS% of the player's next one."""
    rows = (_long_outings(stats)
            .select("player_id", "game_id", "minutes", S.true_shooting().alias("ts_pct"))
            .join(tracking.select("player_id", "game_id", "distance_miles"), ["player_id", "game_id"], "left")
            .join(games.select("game_id", "game_date"), "game_id")
            .select("player_id", "game_id", "game_date", S.load_index().alias("load_index"), "ts_pct"))
    return with_staged_history(rows, "player_id", PLAYER_ORDER, {"next_ts_pct": Following("ts_pct")})


def correlation(x: str, y: str) -> Column:
    """Pearson's r over the rows that have both values; NULL, not an error, when one of them is constant."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def load_next_corr(stats, games, tracking) -> DataFrame:
    return (load_and_next(stats, games, tracking).filter(F.col("next_ts_pct").isNotNull())
            .agg(correlation("load_index", "next_ts_pct").alias("load_vs_next_game_ts_corr"),
                 F.count("*").alias("n_observations")))


def _next_by_quartile(rows: DataFrame) -> DataFrame:
    """Quartiles over all rows; then only rows with a next contest are averaged.

    The four columns are staged: the quartiles read them several times, and the histories behind them cost more than a copy.
    """
    staged = written(rows.select("load_index", "player_id", "game_id", "next_ts_pct"), "loads")
    ranked = ntile(staged, 4, "load_index", ["player_id", "game_id"], "load_quartile")
    return (ranked.filter(F.col("next_ts_pct").isNotNull()).groupBy("load_quartile")
            .agg(S.round_half_up(F.avg("next_ts_pct"), 3).alias("avg_next_game_ts_pct"), F.count("*").alias("n")))


def load_quartiles(stats, games, tracking) -> DataFrame:
    return _next_by_quartile(load_and_next(stats, games, tracking)).orderBy("load_quartile")


QUARTILE_LABELS = {1: "Q1 (lowest)", 2: "Q2", 3: "Q3", 4: "Q4 (highest)"}


def load_quartile_dashboard(player_features: DataFrame) -> DataFrame:
    """The same from the player feature table: all outings, short ones included, with labels."""
    rows = (player_features.filter(F.col("load_index").isNotNull())
            .select("player_id", "game_id", "game_date", "load_index", "ts_pct"))
    following = with_staged_history(rows, "player_id", PLAYER_ORDER, {"next_ts_pct": Following("ts_pct")})
    label = F.lit(None).cast("string")
    for quartile, text in QUARTILE_LABELS.items():
        label = F.when(F.col("load_quartile") == quartile, text).otherwise(label)
    return (_next_by_quartile(following).withColumn("load_quartile", label)
            .select("load_quartile", "n", "avg_next_game_ts_pct").orderBy("load_quartile"))


def _player_seasons(stats: DataFrame, games: DataFrame, players: DataFrame) -> DataFrame:
    """Player-season averages with the age on October 1. Players are joined to the aggregate, not to the games."""
    born = players.filter(F.col("birth_date").isNotNull()).select("player_id", "birth_date")
    return (stats.select("player_id", "game_id", "points", S.true_shooting().alias("_ts"))
            .join(games.select("game_id", "season"), "game_id")
            .groupBy("player_id", "season")
            .agg(F.avg("points").alias("avg_pts"), F.avg("_ts").alias("avg_ts_pct"))
            .join(born, "player_id")
            .withColumn("age_at_season_start", S.whole_years("birth_date", S.season_start("season"))))


def _by_age(seasons: DataFrame, **extra: Column) -> DataFrame:
    return (seasons.filter(F.col("age_at_season_start").between(20, 40)).groupBy("age_at_season_start")
            .agg(F.countDistinct("player_id").alias("n_players"),
                 S.round_half_up(F.avg("avg_pts"), 2).alias("league_avg_pts_at_age"),
                 S.round_half_up(F.avg("avg_ts_pct"), 3).alias("league_avg_ts_pct_at_age"),
                 *[column.alias(name) for name, column in extra.items()])
            .orderBy("age_at_season_start"))


def aging_curve(stats: DataFrame, games: DataFrame, players: DataFrame) -> DataFrame:
    """Averages by age and the change against each player's previous recorded season.

    The window runs over player-season averages, so its groups are as long as a career has seasons.
    """
    career = W.partitionBy("player_id").orderBy("season")
    seasons = _player_seasons(stats, games, players).withColumns({
        "_pts_change": F.col("avg_pts") - F.lag("avg_pts").over(career),
        "_ts_change": F.col("avg_ts_pct") - F.lag("avg_ts_pct").over(career)})
    return _by_age(seasons, avg_yoy_pts_change=S.round_half_up(F.avg("_pts_change"), 2),
                   avg_yoy_ts_pct_change=S.round_half_up(F.avg("_ts_change"), 3))


def aging_summary(stats: DataFrame, games: DataFrame, players: DataFrame) -> DataFrame:
    return _by_age(_player_seasons(stats, games, players))


def form_buckets(team_features: DataFrame) -> DataFrame:
    """How often teams win when they come in hot, average or cold. Rows between the bands are left out."""
    form = F.col("rolling_win_pct")
    bucket = (F.when(form >= 0.7, "hot (>= .700)").when(form.between(0.45, 0.55), "average (.450-.550)")
              .when(form <= 0.3, "cold (<= .300)"))
    return (team_features.select(bucket.alias("form_bucket"), "won").filter(F.col("form_bucket").isNotNull())
            .groupBy("form_bucket")
            .agg(F.count("*").alias("n_games"), S.round_half_up(F.avg(F.col("won").cast("int")), 4).alias("win_rate"))
            .orderBy("form_bucket"))
