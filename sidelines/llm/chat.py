"""Conversations in reply order without quotations: quoted passages are traced to the messages that they come from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sidelines.llm.common import beside_row, components, row_with
from sidelines.session import written

# A line before a quotation that only says whose it is.
ATTRIBUTION = r"(?i)(?:\b(?:wrote|writes|said|schrieb|a écrit|escribió)\b[^\n]{0,40}|-{3,}[^\n]{0,40}-{3,}\s*):?\s*$"
LINE = "struct<level:int,text:string>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def quote_lines(text: Column) -> Column:
    """``array<struct<level, text>>``: each line without its quote marks and how many they were; marks may be spaced."""
    def line(raw: Column) -> Column:
        marks = F.regexp_extract(raw, r"^[ \t>]*", 0)
        level = F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))
        return F.struct(level.cast("int").alias("level"),
                        F.when(level > 0, raw.substr(F.length(marks) + 1, F.length(raw))).otherwise(raw).alias("text"))

    return F.transform(F.split(text, "\r?\n"), line)


def _passages(lines: Column) -> Column:
    """Runs of lines of one level, their paragraphs (between empty lines), and single lines: ``array<struct<level, text>>``."""
    def runs(ls: Column, *same: Callable[[Column], Column]) -> Column:
        def begin(x: Column, i: Column) -> Column:
            changes = i == 0
            for of in same:
                changes = changes | (of(F.get(ls, i - 1)) != of(x))
            return F.when(changes, i)

        begins = F.filter(F.transform(ls, begin), lambda i: i.isNotNull())
        return _let(begins, lambda b: F.transform(b, lambda start, k: F.struct(
            F.get(ls, start)["level"].alias("level"),
            F.array_join(F.transform(F.slice(ls, start + 1, F.coalesce(F.get(b, k + 1), F.size(ls)) - start),
                                     lambda x: x["text"]), "\n").alias("text"))))

    def level(x: Column) -> Column:
        return x["level"]

    def is_empty(x: Column) -> Column:
        return ~F.rlike(x["text"], F.lit(r"[^\s\p{Z}]"))

    return _let(lines, lambda ls: F.array_distinct(F.concat(runs(ls, level), runs(ls, level, is_empty), ls)))


def normalised(text: Column) -> Column:
    """Lower case, with single blanks for anything but letters and digits: what mail programs change does not count.

    A text of signs alone, such as an emoji, is taken without its white space.
    """
    words = F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(words != "", words).otherwise(F.regexp_replace(text, r"[\s\p{Z}]+", ""))


def linked(messages: DataFrame, min_chars: int = 1) -> DataFrame:
    """``messages(conv_id, turn, role, text)``, all rows and columns, with the reply structure.

    ``content``: the text without quoted lines and the lines that introduce them; ``reply_to``: the turn whose own words are
    quoted most (in characters, by the outermost quotation that can be traced; then the later turn), null if none is;
    ``thread``: the smallest turn that is reached over such links; ``n_quoted``, ``n_linked``: quoted passages, and those
    that were traced. A passage is a run of lines of one quote level, a paragraph of it, or a single line, of at least
    ``min_chars`` normalised characters, that is any that is not empty; it comes from the first message of the conversation that has it in its own words, before the quoting one.

    A null text has an empty content. Messages without a conversation or turn are not linked; rows of one turn share their
    links; an empty table gives no rows. Originals are one row per passage, so that no pairs arise within a group.
    """
    rows = beside_row(messages, _conv=F.col("conv_id"), _turn=F.col("turn"), _text=F.coalesce(F.col("text"), F.lit("")))
    passages = (rows.filter("_conv is not null and _turn is not null")
                .select("_conv", "_turn", F.explode(_passages(quote_lines(F.col("_text")))).alias("p"))
                .select("_conv", "_turn", F.col("p.level").alias("level"), normalised(F.col("p.text")).alias("words"))
                .filter(F.length("words") >= min_chars)
                .select("_conv", "_turn", "level", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"),
                        F.length("words").alias("chars")).distinct())
    passages = written(passages, "passages")
    key = ["_conv", "h1", "h2"]
    origins = passages.filter("level = 0").groupBy(*key).agg(F.min("_turn").alias("origin"))
    quoted = passages.filter("level > 0")
    traced = quoted.join(origins, key).filter("origin < _turn")
    counts = (quoted.groupBy("_conv", "_turn").agg(F.count("*").alias("n_quoted"))
              .join(traced.groupBy("_conv", "_turn").agg(F.count("*").alias("n_linked")), ["_conv", "_turn"], "left"))
    best = (traced.groupBy("_conv", "_turn", "level", "origin").agg(F.sum("chars").alias("chars"))
            .groupBy("_conv", "_turn").agg(F.max(F.struct((-F.col("level")).alias("outer"), "chars", "origin")).alias("b"))
            .select("_conv", "_turn", F.col("b.origin").alias("reply_to")))
    best = written(best, "replies")
    roots = components(best.select(F.xxhash64("_conv", "_turn").alias("a"), F.xxhash64("_conv", "reply_to").alias("b")))
    ends = best.select("_conv", "_turn").union(best.select("_conv", "reply_to")).distinct()
    placed = ends.join(roots, F.xxhash64("_conv", "_turn") == F.col("node"))
    first = placed.groupBy("_conv", "root").agg(F.min("_turn").alias("thread"))
    threads = placed.join(first, ["_conv", "root"]).select("_conv", "_turn", "thread")
    found = (threads.join(best, ["_conv", "_turn"], "left").join(counts, ["_conv", "_turn"], "full")
             .withColumnsRenamed({"_conv": "of_conv", "_turn": "of_turn"}))
    rows = rows.join(found, (F.col("_conv") == F.col("of_conv")) & (F.col("_turn") == F.col("of_turn")), "left")
    none = F.lit(0).cast("long")
    return row_with(rows, messages.columns, content=own_words(F.col("_text")), reply_to=F.col("reply_to"),
                    thread=F.coalesce("thread", "_turn"), n_quoted=F.coalesce("n_quoted", none),
                    n_linked=F.coalesce("n_linked", none))


def own_words(text: Column) -> Column:
    """The lines of level 0, but for those that introduce a quotation, without empty lines at the ends."""
    def kept(ls: Column) -> Column:
        own = F.filter(ls, lambda x, i: (x["level"] == 0) & ~(
            (F.coalesce(F.get(ls, i + 1)["level"], F.lit(0)) > 0) & F.rlike(x["text"], F.lit(ATTRIBUTION))))
        return F.array_join(F.transform(own, lambda x: x["text"]), "\n")

    return F.btrim(_let(quote_lines(text), kept), F.lit("\n"))


def formatted(messages: DataFrame, min_chars: int = 1) -> DataFrame:
    """``conv_id, thread, turn, reply_to, role, content, n_quoted, n_linked, message``, ordered as a reader would reply.

    Within a conversation threads follow their first turn and messages their turn, so that an original comes before what
    quotes it. ``message`` is the content in chat markup. The order comes from a sort by ranges, which cuts a long
    conversation into several tasks; no conversation is gathered.
    """
    narrow = messages.select("conv_id", "turn", "role", "text")
    role = F.coalesce("role", F.lit("unknown"))
    message = F.concat(F.lit("<|"), role, F.lit("|>\n"), "content", F.lit("\n<|end|>"))
    return (linked(narrow, min_chars).select("conv_id", "thread", "turn", "reply_to", "role", "content", "n_quoted", "n_linked",
                                             message.alias("message"))
            .orderBy("conv_id", "thread", "turn"))
