"""The load jobs: bulk files, the landed feed and player biographies, validated and upserted by key."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sidelines.functions import scalars as S
from sidelines.operators import quality as Q
from sidelines.operators.keyed import first_per_key
from sidelines.schemas import BUCKETS, KEYS, PARTS, REFERENCES, SCHEMAS
from sidelines.sources import files
from sidelines.sources.conferences import conference_lookup
from sidelines.sources.snapshots import PLACE, SnapshotTable
from sidelines.session import written

STAT_COLUMNS = {"pts": "points", "reb": "rebounds", "oreb": "offensive_reb", "dreb": "defensive_reb",
                "ast": "assists", "stl": "steals", "blk": "blocks", "to": "turnovers", "pf": "fouls",
                "fgm": "fgm", "fga": "fga", "fg3m": "fg3m", "fg3a": "fg3a", "ftm": "ftm", "fta": "fta",
                "plus_minus": "plus_minus"}


class WarehouseTables:
    """The keyed tables under one folder. A bulk load brings teams and players along, so its rows are always held against them;
    with ``strict`` so are the rows of the landed feed, which otherwise need their contest only."""

    def __init__(self, spark: SparkSession, root: str, strict: bool = False):
        self.spark, self.root, self.strict = spark, root.rstrip("/"), strict

    def __getitem__(self, name: str) -> SnapshotTable:
        path, name = f"{self.root}/{name}", name.removesuffix(WAITING)
        return SnapshotTable(self.spark, path, SCHEMAS[name], KEYS[name], PARTS.get(name, "'all'"), BUCKETS.get(name, 1),
                             ["game_id"] if name in BUCKETS else None)

    def report(self, run: str, table: str, losses: DataFrame) -> None:
        """Append what a run left out of a table: ``losses(reason, n_rows)``."""
        rows = losses.select(F.lit(run).alias("run"), F.lit(table).alias("table_name"), "reason", "n_rows")
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/load_report")

    def load_report(self) -> DataFrame:
        """``(run, table_name, reason, n_rows)`` of all runs that reported something."""
        return self.spark.read.schema(LOAD_REPORT).parquet(f"{self.root}/load_report")


LOAD_REPORT = "run string, table_name string, reason string, n_rows long"
# What a row of a referenced table is called in the report.
REFERRED = {"games": "contest", "players": "player", "teams": "team"}
_SOUND = "reason is null and copy = 1"  # of judged rows
WAITING = "_waiting"  # behind a table's name: rows that name something that is not stored yet


def _store(tables: WarehouseTables, name: str, typed: DataFrame, run: str, delivery: str | None = None,
           referring: Collection[str] = (), wanted: DataFrame | None = None, staged: bool = False) -> DataFrame:
    """Report what the rules of a table and its keys leave out of ``typed``, and upsert the rest, which is returned.

    The rows are staged once, unless they are ``staged`` already. Those that name a row of the tables ``referring`` which is not stored are set aside and reported;
    those set aside before for which everything has arrived come with the rest. Of rows of contests, ``wanted(game_id)``, each
    contest once, says which count at all. Rows that are held against their contest alone are not staged, but upserted by the
    job that makes them, if no stored values and no rows that wait belong with them.
    """
    if name == "player_game_stats":
        typed = Q.numeric_stats(typed)
    rules = {"teams": lambda: Q.team_rules(), "players": lambda: Q.player_rules(), "games": lambda: Q.game_rules(typed),
             "player_game_stats": lambda: [Q.plausible_player_ids(), *Q.stats_rules(typed)],
             "player_tracking_stats": lambda: Q.tracking_rules(typed)}[name]()
    if name == "player_game_stats":  # a missing id is reported as such
        rules = [*rules[1:2], rules[0], *rules[2:]]
    references = {column: parent for column, parent in REFERENCES.get(name, {}).items() if parent in referring}
    table, waiting = tables[name], tables[f"{name}{WAITING}"]
    by_contest = wanted is not None or (list(references) == ["game_id"] and not staged)
    if by_contest:
        in_place = wanted is None or not references
        contests = tables["games"].read().select("game_id") if wanted is None else wanted
        judged = _judged_in_place(table, typed, contests, rules) if in_place else _judged_by_contest(typed, wanted, rules, KEYS[name])
        if in_place and wanted is not None:
            judged = judged.filter("known")
        if in_place and not table.lacks(typed) and not (references and waiting.holds_rows()):
            def told(left_out: DataFrame) -> None:
                tables.report(run, name, Q.judged_report(left_out))
                if references:
                    orphans = left_out.filter(_SOUND).select(*SCHEMAS[name].names)
                    _report_waiting(tables, name, orphans.withColumn("missing", F.lit(REFERRED["games"])), run)
                    waiting.upsert(orphans, unique=True)

            return table.upsert_placed(judged, f"{_SOUND} and known", told, delivery)
        judged = written(judged.drop(*PLACE), f"load-{name}")
        good = judged.filter(_SOUND).drop("reason", "copy")
        tables.report(run, name, Q.judged_report(judged))
        if wanted is None:
            good = good.withColumn("missing", F.when(~F.col("known"), REFERRED["games"])).drop("known")
        elif references:
            good = written(_with_missing(tables, good, references), f"judged-{name}")
        else:
            good = good.drop("known")
    else:
        rows = typed if staged else written(typed, f"load-{name}")
        sound = Q.clean(rows, rules)
        if "game_id" in references:  # one shuffle by contest serves the copies and the contests that are stored
            sound = sound.repartition("game_id")
        good = first_per_key(sound, KEYS[name], content_order(rows))
        if name == "games":
            good = with_home_win(good)
        # written at once: Catalyst would follow the hash that orders the copies through every cast of its columns
        good = written(_with_missing(tables, good, references) if references else good, f"sound-{name}")
        tables.report(run, name, Q.load_report(rows, rules, good))
    if references:
        good = _with_referred(tables, name, good, run, references)
    table.upsert(good, delivery, unique=True)
    return good


def _judged_by_contest(typed: DataFrame, wanted: DataFrame, rules: Collection[Q.Rule], keys: Collection[str]) -> DataFrame:
    """The rows of the ``wanted`` contests with ``reason``, and with ``copy``: 1 for the first sound row of its keys.

    One shuffle by contest serves the join and the copies. The join is an outer one, and rows without their contest go last: an
    inner one would ask for ids that are set before the shuffle, for which every line would be parsed again.
    """
    contests = wanted.select(F.col("game_id").alias("_wanted"))
    joined = typed.join(contests, F.col("game_id") == F.col("_wanted"), "left")
    window = W.partitionBy(*keys, F.col("reason").isNull()).orderBy(*content_order(typed))
    return (Q.with_reason(joined, rules).withColumn("copy", F.row_number().over(window))
            .filter(F.col("_wanted").isNotNull()).drop("_wanted"))


def _judged_in_place(table: SnapshotTable, typed: DataFrame, contests: DataFrame, rules: Collection[Q.Rule]) -> DataFrame:
    """The rows with ``known``, whether their contest is one of ``contests(game_id)``, each of which comes once, with ``reason``,
    and with ``copy``: 1 for the first sound row of its keys.

    One shuffle by the places that the rows would have in ``table`` serves the join, the copies and the upsert. The join is an
    outer one: an inner one would ask for ids that are set before the shuffle, for which every line would be parsed again. The
    ids of a place are hashed, so that the rows are sorted once, for the copies.
    """
    there = table.placed(contests.select("game_id")).withColumn("_known", F.lit(True)).hint("shuffle_hash")
    order = content_order(typed)
    rows = table.placed(typed).join(there, [*PLACE, "game_id"], "left")
    rows = Q.with_reason(rows, rules).withColumns({"_sound": F.col("reason").isNull(), "_content": F.xxhash64(*typed.columns)})
    contest_first = sorted(table.keys, key=lambda key: key != "game_id")
    window = W.partitionBy(*PLACE, *contest_first, "_sound").orderBy("_content", *order[1:])
    return (rows.withColumn("copy", F.row_number().over(window))
            .withColumn("known", F.coalesce("_known", F.lit(False))).drop("_known", "_sound", "_content"))


def _report_waiting(tables: WarehouseTables, name: str, orphans: DataFrame, run: str) -> None:
    reason = F.concat(F.lit("waits for its "), "missing").alias("reason")
    tables.report(run, name, orphans.groupBy(reason).agg(F.count("*").alias("n_rows")))


def _with_referred(tables: WarehouseTables, name: str, judged: DataFrame, run: str, references: dict[str, str]) -> DataFrame:
    """The ``judged`` rows, which have ``missing``, and those that have waited, as far as what they refer to is stored; the others
    wait, reported as new ones."""
    waiting, keys = tables[f"{name}{WAITING}"], KEYS[name]
    judged = judged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields if f.name in judged.columns],
                           "missing")
    kept, orphans = judged.filter("missing is null").drop("missing"), judged.filter("missing is not null")
    _report_waiting(tables, name, orphans, run)
    # a newer row takes the place of one that waits
    waited = waiting.read().join(judged.select(*keys), keys, "left_anti")
    released = written(_with_missing(tables, waited, references).filter("missing is null").drop("missing"), "released")
    what = " or ".join(dict.fromkeys(REFERRED[parent] for parent in references.values()))
    n = released.agg(F.count("*").alias("n_rows")).filter("n_rows > 0")
    tables.report(run, name, n.select(F.lit(f"has waited for its {what} and is kept now").alias("reason"), "n_rows"))
    told = waiting.keys_among(released.select(*keys).union(kept.select(*keys)))  # most rows have never waited
    waiting.upsert(orphans.drop("missing"), unique=True)
    if told is not None:
        waiting.delete(told)
    return _with_stored(tables[name], kept.unionByName(released, allowMissingColumns=True),
                        [c for c in released.columns if c not in kept.columns])


def _with_stored(table: SnapshotTable, rows: DataFrame, columns: Collection[str]) -> DataFrame:
    """``rows`` with the stored values of these columns where they have none: a delivery does not clear what it does not know."""
    if not columns:
        return rows
    held = table.read_where(rows).select(*table.keys, *[F.col(c).alias(f"_{c}") for c in columns])
    return (rows.join(held, table.keys, "left").withColumns({c: F.coalesce(c, f"_{c}") for c in columns})
            .drop(*[f"_{c}" for c in columns]))


def _with_missing(tables: WarehouseTables, rows: DataFrame, references: dict[str, str]) -> DataFrame:
    """Add ``missing``: what the first reference that is set and leads nowhere stands for; NULL if there is none."""
    columns, missing = rows.columns, []
    for column, parent in references.items():
        there = tables[parent].read().select(F.col(KEYS[parent][0]).alias(f"_{column}"))
        rows = rows.join(there, F.col(column) == F.col(f"_{column}"), "left")
        missing.append(F.when(F.col(column).isNotNull() & F.col(f"_{column}").isNull(), REFERRED[parent]))
    return rows.select(*columns, F.coalesce(*missing, F.lit(None)).alias("missing"))


def content_order(df: DataFrame) -> list[Column]:
    """Which copy of a key is first. Files have no row order in Spark, so the row's content decides."""
    return [F.xxhash64(*df.columns).asc(), *[F.col(c).asc_nulls_last() for c in df.columns]]


# --- bulk ---------------------------------------------------------------------------------------------------

def teams_from_bulk(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    merged = files.with_lookup(raw, lookup, "abbreviation")
    return merged.select(S.whole("team_id").alias("team_id"), "abbreviation",
                         files.col_or(raw, ["nickname", "name"]).alias("name"), "conference", "division")


def latest_team_per_player(raw: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """One row per player, of the last season; ties by the stated order, else by content."""
    if "season" not in raw.columns:
        return raw
    return first_per_key(raw, ["player_id"], [F.col("season").desc_nulls_first(), *(order or content_order(raw))])


def with_supplement(players: DataFrame, details: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Add players that only the box scores name; of several rows the first in the stated order, else by content. Rows of known
    players go before the others are ordered: they are most."""
    named = Q.clean(details, [Q.plausible_player_ids()]).withColumnRenamed("player_name", "full_name")
    columns = ["player_id", "full_name", "team_id"]
    if order is None:
        named = named.select(*columns)
    unknown = named.join(players.select("player_id"), "player_id", "left_anti")
    missing = first_per_key(unknown, ["player_id"], order or content_order(named)).select(*columns)
    return players.unionByName(missing, allowMissingColumns=True)


def players_from_bulk(raw: DataFrame) -> DataFrame:
    """One row per player of ``raw``, whose ``player_id`` is a number. Position and birth date are left out on purpose: an upsert
    must not clear what the bio job filled in."""
    return latest_team_per_player(raw).select(
        "player_id", files.col_or(raw, ["player_name", "full_name"]).alias("full_name"),
        S.whole(files.col_or(raw, "team_id")).alias("team_id"))


def games_from_bulk(raw: DataFrame, *more: str) -> DataFrame:
    return raw.select(
        S.pad_id("game_id").alias("game_id"), F.col("game_date_est").try_cast("date").alias("game_date"),
        S.season_of_year(S.whole("season", "int")).alias("season"),
        F.lit("Regular Season").alias("season_type"),
        S.whole("home_team_id").alias("home_team_id"),
        S.whole("visitor_team_id").alias("away_team_id"),
        S.whole("pts_home", "int").alias("home_score"), S.whole("pts_away", "int").alias("away_score"), *more)


def with_home_win(games: DataFrame) -> DataFrame:
    return games.withColumn("home_win", F.col("home_score") > F.col("away_score"))


def stats_from_bulk(raw: DataFrame, *more: str) -> DataFrame:
    started = F.col("start_position").isNotNull() if "start_position" in raw.columns else F.lit(False)
    return raw.select(
        S.whole("player_id").alias("player_id"), S.pad_id("game_id").alias("game_id"), S.whole("team_id").alias("team_id"),
        S.parse_minutes("min").alias("minutes"),
        *[files.col_or(raw, source).try_cast("double").alias(target) for source, target in STAT_COLUMNS.items()],
        started.alias("started"), *more)


def load_bulk(spark: SparkSession, folder: str, tables: WarehouseTables, run: str | None = None,
              through: str = "player_game_stats") -> str:
    """Teams, players, games and box scores, in the order of their references, up to the table ``through``. Returns the run's
    name in the report."""
    folder, run = folder.rstrip("/"), run or new_run()

    def read(name: str, table: str, shaped: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        rows, damaged = files.read_csv_checked(spark, f"{folder}/{name}.csv", shaped)
        tables.report(run, table, damaged)
        return rows

    def box_scores(raw: DataFrame) -> DataFrame:
        """What the tables up to ``through`` take from the box scores: all, or the players that they name."""
        if through == "player_game_stats":
            return Q.numeric_stats(stats_from_bulk(raw, "player_name", files.DAMAGED))
        ids = [S.whole(c).alias(c) for c in ("player_id", "team_id") if c in raw.columns]
        return raw.select(*ids, *[c for c in ("player_name",) if c in raw.columns], files.DAMAGED)

    def numbered(raw: DataFrame) -> DataFrame:
        return raw.withColumn("player_id", S.whole("player_id"))

    details, players = read("games_details", "player_game_stats", box_scores), read("players", "players", numbered)
    teams, lookup = read("teams", "teams"), conference_lookup(spark)
    unmapped = files.unmapped_keys(teams, lookup, "abbreviation")
    tables.report(run, "teams", unmapped.groupBy(F.concat(F.lit("no conference for "), "abbreviation").alias("reason"))
                  .agg(F.lit(0).cast("long").alias("n_rows")))  # the row is kept
    _store(tables, "teams", teams_from_bulk(teams, lookup), run)
    if through == "teams":
        return run
    latest = written(players_from_bulk(players), "latest-players")  # read more than once, and of a known size
    if "season" in players.columns:
        seasons = players.select(F.lit(1).alias("n")).unionAll(latest.select(F.lit(-1).alias("n"))).agg(F.sum("n").alias("n_rows"))
        tables.report(run, "players", seasons.filter("n_rows > 0").select(F.lit("earlier season").alias("reason"), "n_rows"))
    _store(tables, "players", with_supplement(latest, details), run, referring=REFERRED)
    if through == "players":
        return run
    games = read("games", "games", lambda raw: games_from_bulk(raw, files.DAMAGED))
    _store(tables, "games", games, run, referring=REFERRED, staged=True)
    if through == "games":
        return run
    _store(tables, "player_game_stats", details.drop("player_name"), run, referring=REFERRED, staged=True)
    return run


def new_run() -> str:
    return f"{datetime.now(UTC):%Y-%m-%dT%H:%M:%S}-{uuid.uuid4().hex[:8]}"


# --- the landed feed ----------------------------------------------------------------------------------------

def load_landed(spark: SparkSession, landing: str, tables: WarehouseTables, start: date, end: date,
                run: str | None = None) -> DataFrame:
    """Contests of a range of days, then the box scores and tracking rows of exactly these contests. Returns the ids of the
    contests that were loaded or got rows. Of a landing zone with folders by day only the range's are read."""
    landing, run, days = landing.rstrip("/"), run or new_run(), (start, end)

    def read(name: str, schema: T.StructType, counts: Collection[str] = ()) -> DataFrame:
        return files.read_landing(spark, f"{landing}/{name}", schema, counts, days)

    header = files.in_range(read("header", files.HEADER_FEED), "GAME_DATE", *days)
    lines = files.in_range(read("line_score", files.LINE_SCORE_FEED), "GAME_DATE", *days)
    referring = REFERRED if tables.strict else ()
    games = _store(tables, "games", files.merge_scoreboard(header, lines), run, referring=referring).select("game_id")
    # the rows of a contest that has to wait wait themselves
    wanted = header.select(S.pad_id("GAME_ID").alias("game_id")).distinct() if tables.strict else games
    box = files.canonical_box(read("box", files.BOX_FEED, files.BOX_COUNTS))
    tracking = files.canonical_tracking(read("tracking", files.TRACKING_FEED, files.TRACKING_COLUMNS))
    stats = _store(tables, "player_game_stats", box, run, referring=referring, wanted=wanted).select("game_id")
    tracked = _store(tables, "player_tracking_stats", tracking, run, referring=referring, wanted=wanted).select("game_id")
    return games.union(stats).union(tracked).distinct() if tables.strict else games


def take_in(tables: WarehouseTables, header: DataFrame, lines: DataFrame, box: DataFrame, tracking: DataFrame, run: str) -> DataFrame:
    """What has landed since the last time, in any order; returns the ids of the contests it concerns.

    Scores may come without their header: then the stored contest of that day and team gets them, and keeps the other side's;
    a contest whose header comes later gets the day's stored scores. Box scores and tracking rows wait for their contest.
    """
    referring = REFERRED if tables.strict else ("games",)
    lines = written(lines, "landed-lines")
    nowhere = [Q.required("GAME_DATE", "TEAM_ID")]
    tables.report(run, "line_scores", Q.reject_report(lines, nowhere))
    lines = _last_scores(tables["line_scores"], Q.clean(lines, nowhere), header)
    stored = tables["games"].read().join(lines.select(F.col("GAME_DATE").alias("game_date")).distinct(), "game_date", "left_semi")
    stored = written(stored, "contests-of-the-days")
    known = stored.select(F.col("game_date").alias("GAME_DATE"), F.col("game_id").alias("GAME_ID"),
                          F.col("home_team_id").alias("HOME_TEAM_ID"), F.col("away_team_id").alias("VISITOR_TEAM_ID"))
    ids = header.select(S.pad_id("GAME_ID").alias("GAME_ID"))
    header = header.unionByName(known.join(ids, "GAME_ID", "left_anti"))
    before = [stored.filter(F.col(score).isNotNull()).select(
        F.col("game_date").alias("GAME_DATE"), F.lit(-1).cast("long").alias("SEQ"), F.col(team).alias("TEAM_ID"),
        F.col(score).cast("double").alias("PTS")) for team, score in (("home_team_id", "home_score"), ("away_team_id", "away_score"))]
    scores = lines.unionByName(before[0]).unionByName(before[1])
    merged = files.merge_scoreboard(header, scores)
    both = F.col("home_score").isNotNull() & F.col("away_score").isNotNull()  # else the other side's score has yet to land
    merged = merged.withColumns({score: F.when(both, F.col(score)) for score in ("home_score", "away_score")})
    games = _store(tables, "games", merged, run, referring=referring).select("game_id")
    stats = _store(tables, "player_game_stats", files.canonical_box(box), run, referring=referring).select("game_id")
    tracked = _store(tables, "player_tracking_stats", files.canonical_tracking(tracking), run, referring=referring).select("game_id")
    return games.union(stats).union(tracked).distinct()


def _last_scores(table: SnapshotTable, lines: DataFrame, header: DataFrame) -> DataFrame:
    """Store the landed scores, of a team and day the last one, and return those of all days that ``lines`` or ``header`` name."""
    names = {"GAME_DATE": "game_date", "TEAM_ID": "team_id", "SEQ": "seq", "PTS": "points"}
    days = lines.select("GAME_DATE").union(header.select("GAME_DATE")).distinct().withColumnRenamed("GAME_DATE", "game_date")
    before = table.read_where(days.withColumn("team_id", F.lit(0))).join(days, "game_date", "left_semi")
    landed = lines.select(*[F.col(name).alias(column) for name, column in names.items()])
    last = first_per_key(landed.unionByName(before), KEYS["line_scores"], [F.col("seq").desc(), F.col("points").desc()])
    last = written(last, "last-scores")
    table.upsert(last.join(landed, KEYS["line_scores"], "left_semi"))
    return last.select(*[F.col(column).alias(name) for name, column in names.items()])


def upsert_box(tables: WarehouseTables, box: DataFrame, run: str, delivery: str | None = None) -> None:
    _store(tables, "player_game_stats", box, run, delivery, REFERRED if tables.strict else ())


# --- biographies --------------------------------------------------------------------------------------------

def bio_backlog(players: DataFrame, limit: int | None = None) -> DataFrame:
    """Players without a birth date, in a fixed order when only some are wanted."""
    waiting = players.filter(F.col("birth_date").isNull()).select("player_id", "full_name")
    return waiting if limit is None else waiting.orderBy("player_id").limit(limit)


def parsed_bio(bio: DataFrame) -> DataFrame:
    rows = bio.select(
        F.col("PLAYER_ID").alias("player_id"), S.short_position("POSITION").alias("position"),
        S.parse_birth_date("BIRTHDATE").alias("birth_date"), S.parse_height("HEIGHT").alias("height_inches"),
        S.parse_weight("WEIGHT").alias("weight_lbs"))
    return first_per_key(rows, ["player_id"], content_order(rows))


def apply_bio(players: DataFrame, bio: DataFrame) -> DataFrame:
    """Set the four bio columns of players without a birth date that the bio table knows."""
    columns = ["position", "birth_date", "height_inches", "weight_lbs"]
    found = bio.select("player_id", *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_found"))
    take = F.col("birth_date").isNull() & F.coalesce(F.col("_found"), F.lit(False))
    joined = players.join(found, "player_id", "left").withColumn("_take", take)
    return joined.select(*[F.when(F.col("_take"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
                           if c in columns else F.col(c) for c in players.columns])


def still_missing(players: DataFrame, bio: DataFrame) -> DataFrame:
    """Players that the bio table does not know: reported, and tried again by the next run."""
    return bio_backlog(players).join(bio.select("player_id"), "player_id", "left_anti")


def enrich_players(spark: SparkSession, bio_path: str, tables: WarehouseTables) -> DataFrame:
    players = tables["players"].read()
    bio = parsed_bio(files.read_landing(spark, bio_path, files.BIO_FEED))
    tables["players"].replace(apply_bio(players, bio))
    return still_missing(players, bio)
