"""Personal data in texts: patterns, and terms that give it away by the company they keep in the corpus.

The patterns find protected entities (addresses and numbers). A term discloses an entity if, over whole documents, the
pointwise mutual information of the two comes close to the information content of the entity: whoever reads the term can
then infer the entity. Such terms are generalised, or removed where the disclosure is nearly complete, wherever they stand
in the documents that hold the entity.

Nothing here leaves the JVM. Repeated groups in patterns are possessive, which Java runs as a loop and not by recursion.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sidelines.llm.common import beside_row, quoted, row_with
from sidelines.session import written

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("term", "hint")  # removed, generalised
# A match starts where no character of its first part comes before it, or where the last match ended.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Runs of letters and digits with marks between them; where a script does not part words by blanks, whole runs of it.
# Thai, Lao, Myanmar, Khmer, Chinese and Japanese, as ranges: a lookup of each character's script takes three times as long.
_UNSPACED = (r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
             r"\uf900-\ufaff\uff66-\uff9f\x{20000}-\x{323af}")
_PLAIN = rf"[a-zA-Z0-9\p{{L}}\p{{M}}\p{{N}}&&[^{_UNSPACED}]]++"
_TERM = rf"[{_UNSPACED}]++|{_PLAIN}(?:['\u2019-]{_PLAIN})*+"
_RUN = r"[a-zA-Z0-9\p{L}\p{M}\p{N}]++"
_SPACED_TERM = rf"{_RUN}(?:['\u2019-]{_RUN})*+"  # the same where there is no unspaced script
GRAM = 2  # characters of a run in an unspaced script that are one term
SPAN = "struct<start:int,end:int,match:string>"
STRIDE = 64  # matches whose places are added up together


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def spans(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, match>>``, in characters: the matches, and their places from the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast(f"array<{SPAN}>")

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["piece"])
        end = start + F.length(part["match"])
        span = F.struct(start.alias("start"), end.alias("end"), part["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def strides(parts: Column) -> Column:
        """Places within a stride, then moved by where it begins: a list that grows by each match would be copied as often."""
        own = F.transform(F.sequence(F.lit(0), ((F.size(parts) - 1) / STRIDE).cast("int")), lambda k: F.aggregate(
            F.slice(parts, k * STRIDE + 1, F.lit(STRIDE)), F.struct(F.lit(0).alias("at"), none.alias("out")), add))
        return _let(own, lambda own: F.flatten(F.zip_with(own, begins(own), lambda o, by: F.transform(
            o["out"], lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["match"].alias("match"))))))

    def begins(own: Column) -> Column:
        return F.aggregate(own, F.array(F.lit(0)), lambda at, o: F.concat(at, F.array(F.element_at(at, -1) + o["at"])),
                           lambda at: F.slice(at, F.lit(1), F.size(own)))

    pieces = F.split(text, pattern, -1)
    parts = F.zip_with(found, F.slice(pieces, F.lit(1), F.size(found)),
                       lambda m, p: F.struct(m.alias("match"), p.alias("piece")))
    return _let(parts, lambda parts: F.when(F.size(parts) > 0, strides(parts)).otherwise(none))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(char: Column, i: Column) -> Column:
        d = char.cast("int")
        return F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    values = F.transform(F.split(F.reverse(digits), ""), value)
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid_ip(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda part: _let(F.ltrim(part, F.lit("0")), lambda p: (
        (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))))


def base_spans(text: Column) -> dict[str, Column]:
    """The valid matches of each kind. A match that is not valid is dropped, and nothing within it is tried again."""
    def of(maybe: Column, pattern: str) -> Column:
        return F.when(maybe, spans(text, pattern)).otherwise(F.array().cast(f"array<{SPAN}>"))

    email = of(F.contains(text, F.lit("@")), _EMAIL)
    ip = F.filter(of(F.rlike(text, F.lit(r"[0-9]\.[0-9]")), _IP), lambda s: _valid_ip(s["match"]))
    card = F.filter(of(F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){15}")), _CARD),
                    lambda s: F.length(_digits(s["match"])).between(16, 19) & _luhn(_digits(s["match"])))
    phone = F.filter(of(F.rlike(text, F.lit(r"\+[0-9]")), _PHONE),
                     lambda s: F.length(_digits(s["match"])).between(8, 15))
    return dict(zip(KINDS, (email, ip, card, phone)))


def _masked(text: Column) -> Column:
    """The text with blanks in place of the valid matches of every kind, at the same places."""
    checks = {_EMAIL: lambda m: F.lit(True), _IP: _valid_ip,
              _CARD: lambda m: F.length(_digits(m)).between(16, 19) & _luhn(_digits(m)),
              _PHONE: lambda m: F.length(_digits(m)).between(8, 15)}
    for pattern, valid in checks.items():
        text = _let(text, _blanked(pattern, valid))
    return text


def _blanked(pattern: str, valid: Callable[[Column], Column]) -> Callable[[Column], Column]:
    def of(text: Column) -> Column:
        found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(
            valid(m), F.repeat(F.lit(" "), F.length(m))).otherwise(m))
        return F.array_join(F.zip_with(F.split(text, pattern, -1), found, lambda piece, m: F.concat(
            piece, F.coalesce(m, F.lit("")))), "")

    return of


def _terms(word: Column) -> Column:
    """``array<struct<text, start, end>>``: a word in lower case, or the overlapping n-grams of a run in an unspaced script."""
    def grams(chars: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(chars) - GRAM), lambda i: F.struct(
            F.array_join(F.slice(chars, i + 1, F.lit(GRAM)), "").alias("text"), (word["start"] + i).alias("start"),
            (word["start"] + i + GRAM).alias("end")))

    whole = F.array(F.struct(F.lower(word["match"]).alias("text"), word["start"].alias("start"), word["end"].alias("end")))
    unspaced = (F.length(word["match"]) > GRAM) & F.rlike(word["match"], F.lit(f"^[{_UNSPACED}]"))
    return F.when(unspaced, _let(F.regexp_extract_all(F.lower(word["match"]), F.lit("(?s)."), F.lit(0)), grams)).otherwise(whole)


def _spread(text: Column) -> Column:
    """The distinct terms of a text, hashed."""
    def grams(chars: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(chars) - GRAM + 1), lambda i: F.xxhash64(
            F.array_join(F.slice(chars, i, F.lit(GRAM)), "")))

    def of(match: Column) -> Column:
        unspaced = (F.length(match) > GRAM) & F.rlike(match, F.lit(f"^[{_UNSPACED}]"))
        return F.when(unspaced, _let(F.regexp_extract_all(match, F.lit("(?s)."), F.lit(0)), grams)).otherwise(F.array(F.xxhash64(match)))

    def found(pattern: str) -> Column:
        return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0)))

    # its characters have three bytes or more
    unspaced = (F.octet_length(text) > F.length(text) + 1) & F.rlike(text, F.lit(f"[{_UNSPACED}]"))
    return F.when(unspaced, F.array_distinct(F.flatten(F.transform(found(_TERM), of)))).otherwise(
        F.transform(found(_SPACED_TERM), lambda m: F.xxhash64(m)))


def _found(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with a key of the text, an array of spans per kind, the distinct ``entities``, and beside them all ``words``.

    Words are the terms of the whole text with their places, but for what lies within an entity; a text without entities
    has none.
    """
    rows = rows.withColumn("_t", F.coalesce(F.col(text), F.lit(""))).withColumn("tkey", F.xxhash64("_t"))
    rows = rows.withColumns(base_spans(F.col("_t")))

    def entities(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.xxhash64(
            F.lit(kind), _digits(s["match"]) if kind in ("card", "phone") else F.lower(s["match"])))

    rows = rows.withColumn("entities", F.array_distinct(F.concat(*[entities(kind) for kind in KINDS])))
    words = F.transform(F.flatten(F.transform(spans(F.col("_m"), _TERM), _terms)), lambda t: F.struct(
        F.xxhash64(t["text"]).alias("term"), t["start"].alias("start"), t["end"].alias("end")))
    held = F.size("entities") > 0
    rows = rows.withColumn("_m", F.when(held, _masked(F.col("_t")))).withColumn("words", F.when(held, words))
    places = {kind: F.transform(F.col(kind), lambda s: F.struct(s["start"], s["end"])) for kind in KINDS}
    return rows.withColumns(places).drop("_t", "_m")


def disclosing_terms(held: DataFrame, words: DataFrame, documents: DataFrame, text: str, hint: float = 0.75,
                     remove: float = 0.9, support: int = 3) -> DataFrame:
    """``(entity, term, kind)``: terms that give entities away, from ``held(doc_id, tkey, entity)``, without repetitions,
    and ``words(doc_id, tkey, words)``, a row per document that holds an entity.

    Their disclosure is the mutual information of term and entity over the entity's information content, which is 1 if
    the term occurs only in documents with the entity. All counts are whole documents, a term's over the whole corpus; a
    pair counts from ``support`` documents on, since rarer company proves nothing.

    A term in so many documents that it can't reach ``hint`` with the commonest entity beside it (which would have to be in
    all of the entity's documents) is left out of a document before its pairs are made.
    """
    n = documents.select(F.count("*")).scalar().cast("double")
    entities = held.groupBy("entity").agg(F.count("*").alias("of_entity")).filter(F.col("of_entity") >= support)
    held = written(held.join(entities, "entity"), "entities-held")
    spread = (documents.select(F.explode(_spread(F.coalesce(F.col(text), F.lit("")))).alias("term"))
              .groupBy("term").agg(F.count("*").alias("of_term")).filter(F.col("of_term") >= support))

    def can_tell(of_entity: str) -> Column:
        content = F.log(n / F.col(of_entity))
        return (content > 0) & (F.log(n / F.col("of_term")) >= hint * content - 1e-9)

    commonest = held.groupBy("doc_id", "tkey").agg(F.max("of_entity").alias("commonest"))
    terms = (_beside(commonest, words).select("doc_id", "tkey", "commonest", F.explode(F.array_distinct(F.col("words.term"))).alias("term"))
             .join(spread, "term").filter(can_tell("commonest"))
             .select(F.col("doc_id").alias("of_doc"), F.col("tkey").alias("of_text"), "term", "of_term"))
    pairs = (held.join(terms, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("tkey") == F.col("of_text")))
             .filter(can_tell("of_entity"))
             .groupBy("entity", "term").agg(F.count("*").alias("both"), F.first("of_entity").alias("of_entity"), F.first("of_term").alias("of_term"))
             .filter(F.col("both") >= support).withColumn("n", n))
    content = F.log(F.col("n") / F.col("of_entity"))
    shared = F.log(F.col("n") * F.col("both") / (F.col("of_entity") * F.greatest("of_term", "both")))
    disclosure = F.when(content > 0, shared / content)
    return (pairs.withColumn("disclosure", disclosure).filter(F.col("disclosure") >= hint)
            .select("entity", "term", F.when(F.col("disclosure") >= remove, TERM_KINDS[0]).otherwise(TERM_KINDS[1]).alias("kind")))


def _beside(held: DataFrame, words: DataFrame) -> DataFrame:
    """``held`` with the words of its documents."""
    words = words.select(F.col("doc_id").alias("of_doc"), F.col("tkey").alias("of_text"), "words")
    return held.join(words, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("tkey") == F.col("of_text")))


def personal_data(documents: DataFrame, hint: float = 0.75, remove: float = 0.9, support: int = 3) -> DataFrame:
    """``(doc_id, tkey, email, ip, card, phone, term, hint)`` for every row of ``documents(doc_id, text)``.

    The six are arrays of ``(start, end)``, in characters, in order. A term is a run of letters and digits, of any length, also with
    an apostrophe or hyphen inside, or two neighbouring characters of a script that does not part words; none lies within
    an entity. Terms and hints are all places of a disclosing term in the documents that hold its entity; other
    documents keep the term. ``tkey`` is a hash of the text, so that rows of one doc_id
    with different texts are kept apart. A null text is an empty one and has no spans; repeated rows stay; a null
    doc_id is kept. An empty table gives no rows; other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    found = written(_found(rows, "text").drop("text"), "personal-data")
    once = found.filter("words is not null").dropDuplicates(["doc_id", "tkey"])
    held, words = once.select("doc_id", "tkey", F.explode("entities").alias("entity")), once.select("doc_id", "tkey", "words")
    told = written(disclosing_terms(held, words, rows, "text", hint, remove, support), "disclosing-terms")
    # a term that discloses several entities goes if it has to for one: "term" comes after "hint"
    concerned = held.join(told.select("entity").distinct(), "entity")
    places = (_beside(concerned.select("doc_id", "tkey").distinct(), words)
              .select("doc_id", "tkey", F.explode("words").alias("w")).select("doc_id", "tkey", "w.term", "w.start", "w.end")
              .join(told.select("term").distinct(), "term"))
    extra = (concerned.select(F.col("doc_id").alias("of_doc"), F.col("tkey").alias("of_text"), "entity")
             .join(places, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("tkey") == F.col("of_text")))
             .join(told, ["entity", "term"]).groupBy("doc_id", "tkey", "start", "end").agg(F.max("kind").alias("kind"))
             .groupBy(F.col("doc_id").alias("of_doc"), F.col("tkey").alias("of_text"))
             .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("extra")))
    rows = found.drop("entities", "words").join(extra, F.col("doc_id").eqNullSafe(F.col("of_doc"))
                                                & (F.col("tkey") == F.col("of_text")), "left")

    def of(kind: str) -> Column:
        none = F.array().cast("array<struct<start:int,end:int>>")
        places = F.transform(F.filter("extra", lambda x: x["kind"] == kind), lambda x: F.struct(x["start"], x["end"]))
        return F.coalesce(places, none).alias(kind)

    return rows.select("doc_id", "tkey", *KINDS, *[of(kind) for kind in TERM_KINDS])


def listed(*kinds: str) -> Column:
    """``kind:start:end`` of the spans in these columns, by kind and then start, comma-joined."""
    def part(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.array_join(F.concat(*map(part, kinds)), ",")


def sanitised(documents: DataFrame, hint: float = 0.75, remove: float = 0.9, support: int = 3) -> DataFrame:
    """``documents``, all rows and columns, with a clean ``text``.

    Entities become their kind in brackets, hints ``[TERM]``, and terms that disclose more are taken out. Where
    spans overlap, the one that starts first is replaced, of several the longest. A null text stays null.
    """
    instead = {kind: f"[{kind.upper()}]" for kind in KINDS} | dict(zip(TERM_KINDS, ("", "[TERM]")))

    def replaced(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("upto"), F.lit(instead[kind]).alias("by")))

    spans_of = personal_data(documents, hint, remove, support)
    places = F.array_sort(F.concat(*map(replaced, instead)))
    spans_of = spans_of.select(F.col("doc_id").alias("_of"), F.col("tkey").alias("_key"), places.alias("_places")).distinct()
    rows = beside_row(documents, _doc_id=F.col("doc_id"), _text=F.col("text"))
    rows = rows.withColumn("_tkey", F.xxhash64(F.coalesce("_text", F.lit(""))))
    rows = rows.join(spans_of, F.col("_doc_id").eqNullSafe(F.col("_of")) & (F.col("_tkey") == F.col("_key")))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def replace(state: Column, s: Column) -> Column:
        between = F.col("_text").substr(state["at"] + 1, s["start"] - state["at"])
        return F.when(s["start"] < state["at"], state).otherwise(
            F.struct((-s["upto"]).alias("at"), F.concat(state["out"], between, s["by"]).alias("out")))

    clean = F.aggregate("_places", zero, replace, lambda state: F.concat(
        state["out"], F.col("_text").substr(state["at"] + 1, F.length("_text"))))
    return row_with(rows, documents.columns, text=F.when(F.col("_text").isNotNull(), clean))
