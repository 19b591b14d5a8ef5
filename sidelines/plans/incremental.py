"""Feature tables that are kept up to date: a night's contests change the rows after them, and only these are written.

What a block of an entity's history passes on to later ones (its last rows and exact sums, see ``operators.history``) is
kept as a state table, a row per entity and block. A change names contests. The blocks that hold them, or held them when
the features were last built, are summarised anew; the state of the blocks before them is read, not their rows. From
there on the rows of the entities concerned are computed again: a contest that arrives late rewinds to its block. Sums
are exact, so the tables equal a full build to the last bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sidelines.operators.history import KEY, History
from sidelines.plans import features
from sidelines.sources.snapshots import SnapshotTable
from sidelines.session import written

TEAM_TABLE, PLAYER_TABLE = "team_game_features", "player_game_features"
BUCKETS = 16
# What the opponent's features need of a team's row.
_FORM = ["game_id", "game_date", "season", "team_id", "opponent_id", "is_home", "won", "rolling_win_pct", "rolling_point_diff", "days_rest"]


class _Kept:
    """One feature table and its state; both lie in buckets by entity."""

    def __init__(self, spark: SparkSession, root: str, name: str, entity: str, history: History, like: DataFrame, result: T.StructType):
        self.spark, self.entity, self.history = spark, entity, history
        self.keys = [entity, "game_id"]
        self.table = SnapshotTable(spark, f"{root}/{name}", result, self.keys, buckets=BUCKETS, bucket_by=[entity])
        state = history.summaries(history.keyed(like)).schema
        self.state = SnapshotTable(spark, f"{root}/{name}_state", state, KEY, buckets=BUCKETS, bucket_by=KEY[:2])

    def rebuild(self, rows: DataFrame, result: DataFrame) -> None:
        self.state.replace(self.history.summaries(self.history.keyed(rows)))
        self.table.replace(result)

    def changed_blocks(self, now: DataFrame, before: DataFrame) -> DataFrame:
        """``KEY`` and ``since``, the first of the rows that changed in it: of the rows as they are and as they were."""
        at = F.struct(*[c for name in features.ORDER for c in (F.col(name).isNull(), F.col(name))])
        places = self.history.keyed(now).select(*KEY, at.alias("at")).union(self.history.keyed(before).select(*KEY, at.alias("at")))
        return written(places.groupBy(*KEY).agg(F.min("at").alias("since")), "changed-blocks")

    def renew(self, rows: DataFrame, changed: DataFrame) -> DataFrame:
        """The rolled rows from the first change of each entity on; the state is brought up to date.

        ``rows`` are all rows as they are now, of which those of the concerned entities are read.
        """
        first = changed.groupBy(*KEY[:2]).agg(F.min("since").alias("since"), F.min(F.struct(*KEY[2:])).alias("block"))
        keyed = self.history.keyed(rows)
        own = written(keyed.join(first, KEY[:2]).filter(F.struct(*KEY[2:]) >= F.col("block")).select(*keyed.columns, "since"), "concerned-rows")
        blocks = own.drop("since").join(changed.select(*KEY), KEY, "left_semi")
        summaries = written(self.history.summaries(blocks), "summaries")
        self.state.upsert(summaries)
        self.state.delete(changed.select(*KEY).join(summaries.select(*KEY), KEY, "left_anti"))
        known = self.state.read_where(first.select(*KEY[:2], *[F.lit(None).cast(self.state.schema[k].dataType).alias(k) for k in KEY[2:]]))
        edges = self.history.edges(known.join(first.select(*KEY[:2]), KEY[:2], "left_semi"))
        at = F.struct(*[c for name in features.ORDER for c in (F.col(name).isNull(), F.col(name))])
        return self.history.values(own, edges).filter(at >= F.col("since")).drop("since")

    def store(self, renewed: DataFrame, before: DataFrame) -> None:
        """Write the renewed rows; rows that were there and are not any more go."""
        renewed = written(renewed, "renewed")
        self.table.upsert(renewed)
        self.table.delete(before.select(*self.keys).join(renewed.select(*self.keys), self.keys, "left_anti"))


def _of(keys: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The rows of a few keys. Their number is bounded by a night's change, which the size check of the join sees."""
    return rows.join(keys.select(key).distinct(), key, "left_semi")


class FeatureTables:
    """``team_game_features`` and ``player_game_features`` under ``root``, with their states."""

    def __init__(self, spark: SparkSession, root: str, games: DataFrame, stats: DataFrame, tracking: DataFrame, players: DataFrame):
        """The tables are given as they are now."""
        self.games, self.stats, self.tracking, self.players = games, stats, tracking, players
        self.team_rows = features.team_rows(games)
        self.player_rows = features.player_rows(stats, games, tracking)
        # the schemas are taken from plans that start no job
        team, player = features.team_history(self.team_rows), features.player_history(self.player_rows)
        self.team = _Kept(spark, root, TEAM_TABLE, "team_id", team, self.team_rows,
                          features.with_opponents(features.with_rest(team.over(self.team_rows))).schema)
        self.player = _Kept(spark, root, PLAYER_TABLE, "player_id", player, self.player_rows,
                            features.with_players(player.over(self.player_rows), players).schema)

    def read(self, name: str) -> DataFrame:
        return {TEAM_TABLE: self.team, PLAYER_TABLE: self.player}[name].table.read()

    def rebuild(self) -> None:
        """Both tables and their states from the beginning."""
        self.team.rebuild(self.team_rows, features.team_game_features(self.games))
        self.player.rebuild(self.player_rows, features.player_game_features(self.stats, self.games, self.tracking, self.players))

    def update(self, changed_games: DataFrame, changed_players: DataFrame | None = None) -> None:
        """Take in the contests ``changed_games(game_id)``: new, corrected, moved or withdrawn, with their box scores and
        tracking rows. ``changed_players(player_id)`` have another name or birth date."""
        changed_games = written(changed_games.select("game_id").distinct(), "changed-games")
        self._update_teams(changed_games)
        self._update_players(changed_games, changed_players)

    def _update_teams(self, changed: DataFrame) -> None:
        stored = self.team.table.read()
        before = written(_of(changed, stored, "game_id"), "before")
        blocks = self.team.changed_blocks(_of(changed, self.team_rows, "game_id").select("team_id", *features.ORDER),
                                          before.select("team_id", *features.ORDER))
        form = written(features.with_rest(self.team.renew(self.team_rows, blocks)).select(*_FORM), "form")
        # the other side of a renewed row sees its form; its own stays as it is stored
        others = _of(form, stored, "game_id").select(*_FORM).join(form.select("game_id", "team_id"), ["game_id", "team_id"], "left_anti")
        others = others.join(before.select("game_id", "team_id"), ["game_id", "team_id"], "left_anti")
        self.team.store(features.with_opponents(form.unionByName(others)), before)

    def _update_players(self, changed: DataFrame, players: DataFrame | None) -> None:
        stored = self.player.table.read()
        before = written(_of(changed, stored, "game_id"), "before")
        columns = ["player_id", *features.ORDER, "season"]
        now = _of(changed, self.player_rows, "game_id").select(*columns)
        if players is not None:  # all of their rows
            now = now.union(_of(players, self.player_rows, "player_id").select(*columns))
        blocks = self.player.changed_blocks(now, before.select(*columns))
        self.player.store(features.with_players(self.player.renew(self.player_rows, blocks), self.players), before)

    def compact(self, most_deltas: int = 8) -> None:
        for kept in (self.team, self.player):
            for table in (kept.table, kept.state):
                table.compact(most_deltas)
                table.vacuum()
