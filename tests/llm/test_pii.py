import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from sidelines.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return {kind: [m.span() for m in re.finditer(p, text or "") if valid(kind, m.group())] for kind, p in PATTERNS.items()}


def base(text):
    listed = ",".join(f"{kind}:{s}:{e}" for kind, found in plain(text).items() for s, e in found)
    return hashlib.sha256(listed.encode()).hexdigest()


CARD = "4111 1111-1111 1111"
TEXTS = [None, "", "a@b.c", "a@b", "x a@b.c..d@e.f y@z", "a@b.c_d@e.fr", "éa.b+c%d@x-y.z1.é", "@a.b a@@b.c a@.b a@b.c@d.e", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8",
         "0255.00.1.000001 1.2.3", f"{CARD}, {CARD}9 41111111111111111 4111-1111-1111-1112", f"1 {CARD}", f"x{CARD}  4111111111111111\n" + CARD,
         "+49 (30) 123-4567. +1 +12 345 +1 234 567 890 123 456 7", "+1(2)3.4-5 67 8", "漢字" * 5 + " é@b.c m@ü.de q@b.c𝒳 w@b.de 1.1.1.1",
         "a" * 60_000, "1" * 60_000, "1 " * 30_000, "a@b" + ".c" * 30_000, "+1" + "(" * 60_000, "1.2.3.4 " * 3000, "x@y.zz " * 3000, "٠١@b.c ١.٢.٣.٤",
         "5555555555554444 x@y.z 10.0.0.1 +44 20 7946 0958"]


def rows_of(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.personal_data(frame).select("doc_id", *pii.KINDS, F.sha2(pii.listed(*pii.KINDS), 256).alias("sha"))
    return {r["doc_id"]: r for r in found.collect()}


def check(spark, texts):
    for i, row in rows_of(spark, texts).items():
        assert {k: [tuple(s) for s in row[k]] for k in pii.KINDS} == plain(texts[i]), repr(texts[i])[:200]
        assert row["sha"] == base(texts[i])


def test_patterns_equal_brute_force(spark):
    check(spark, TEXTS)


def test_random_texts_equal_brute_force(spark):
    random = np.random.default_rng(2)
    parts = ["a", "B.", "@", ".", "..", "-", " ", "  ", "1", "12", "255", "256", "4111", "1111", "+", "+4", "(", ")", "é", "\n", "_", "%", "1.1", "@x.y"]
    check(spark, ["".join(random.choice(parts, random.integers(1, 40))) for _ in range(1500)])


def test_documents_equal_brute_force(spark):
    check(spark, [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()])


def corpus():
    """Zanzibar occurs beside one address only, harbour mostly there, and the other words everywhere."""
    rows = [f"people {i} Zanzibar harbour people write to bob@corp.com about people" for i in range(6)]
    rows += [f"the harbour is where people are {i}" for i in range(8)]
    return rows + [f"people write to other people about other people, number {i}" for i in range(400)]


def test_terms_that_give_an_entity_away(spark):
    texts = corpus()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.personal_data(frame).collect()}
    words = {kind: {texts[i][s["start"]:s["end"]] for i, r in found.items() for s in r[kind]} for kind in pii.TERM_KINDS}
    assert "Zanzibar" in words["term"] and words["hint"] == {"harbour"}
    assert not {"people", "write", "about"} & (words["term"] | words["hint"])
    assert all(not r["term"] and not r["hint"] for i, r in found.items() if i >= 6)


def test_terms_far_from_the_entity_are_counted_and_marked_everywhere_in_its_documents(spark):
    far = "people write about other people " * 10
    texts = [f"Zanzibar {far} write to bob@corp.com {far} {i} Zanzibar, {far} zanzibar" for i in range(6)]
    texts += [f"{far} to {i}" for i in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.personal_data(frame).collect()}
    for i in range(6):
        assert [texts[i][s["start"]:s["end"]] for s in found[i]["term"]] == ["Zanzibar", "Zanzibar", "zanzibar"]
        assert not found[i]["hint"]
    assert all(not r["term"] and not r["hint"] for i, r in found.items() if i >= 6)
    assert not any("zanzibar" in r["text"].lower() for r in pii.sanitised(frame).collect())


def test_a_term_goes_by_the_share_of_whole_documents(spark):
    """Within 80 characters the word would be with the address in three documents of six."""
    far = "people write about other people " * 10
    texts = [f"bob@corp.com {far if i % 2 else ''} harbour" for i in range(6)] + [far] * 400
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.personal_data(frame).collect()}
    assert all([texts[i][s["start"]:s["end"]] for s in found[i]["term"]] == ["harbour"] for i in range(6))


def test_places_of_many_matches(spark):
    texts = ["é ab " * n for n in (0, 1, 63, 64, 65, 128, 129, 5000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in frame.select("i", pii.spans(F.col("text"), "ab").alias("s")).collect():
        assert [(s["start"], s["end"], s["match"]) for s in r["s"]] == [(*m.span(), "ab") for m in re.finditer("ab", texts[r["i"]])]


def test_support_is_needed(spark):
    texts = ["Zanzibar knows a@b.com", "Zanzibar knows a@b.com"] + ["other words here"] * 50
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(not r["term"] for r in pii.personal_data(frame).collect())


def test_sanitised_texts(spark):
    texts = [*corpus(), None, "", f"call +1 {CARD} now", "é x@y.z"]
    frame = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, email string")
    result = pii.sanitised(frame.union(frame.filter("doc_id = 0")))
    assert result.columns == frame.columns
    clean = {r["doc_id"]: r["text"] for r in result.collect()}
    assert result.count() == len(texts) + 1
    assert clean[0].endswith("[TERM] people write to [EMAIL] about people") and "Zanzibar" not in clean[0]
    assert clean[len(texts) - 4] is None and clean[len(texts) - 3] == "" and clean[len(texts) - 1] == "é [EMAIL]"
    assert clean[10] == texts[10]


@pytest.mark.parametrize("texts", [[], [None]])
def test_empty_tables(spark, texts):
    frame = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    assert pii.personal_data(frame).count() == len(texts) and pii.sanitised(frame).count() == len(texts)


def test_repeated_rows_and_ids(spark):
    frame = spark.createDataFrame([(1, "a@b.c"), (1, "a@b.c"), (1, "x"), (None, "q@b.c")], "doc_id long, text string")
    assert sorted((str(r["doc_id"]), len(r["email"])) for r in pii.personal_data(frame).collect()) == [("1", 0), ("1", 1), ("1", 1), ("None", 1)]


UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"


def plain_terms(text):
    """(term, start, end) of a text, from what a regular expression and a loop over characters give."""
    found = []
    for run in regex.finditer(rf"(?V1)[{UNSPACED}]+|[\p{{L}}\p{{M}}\p{{N}}--{UNSPACED}]+(?:['’-][\p{{L}}\p{{M}}\p{{N}}--{UNSPACED}]+)*", text):
        start, end = run.span()
        if regex.match(f"[{UNSPACED}]", run.group()) and end - start > 2:
            found += [(text[i:i + 2].lower(), i, i + 2) for i in range(start, end - 1)]
        else:
            found.append((run.group().lower(), start, end))
    return found


def plain_spans(texts, hint=0.75, remove=0.9, support=3):
    """For each text the places of (term, hint), by counting every pair of an entity and a term."""
    entities, terms, spread, of_entity, both = [], [], Counter(), Counter(), Counter()
    for text in texts:
        text = text or ""
        own, masked = set(), text
        for kind, spans in plain(text).items():
            for s, e in spans:
                match = text[s:e]
                own.add((kind, "".join(c for c in match if c in "0123456789") if kind in ("card", "phone") else match.lower()))
                masked = masked[:s] + " " * (e - s) + masked[e:]
        entities.append(own)
        terms.append(plain_terms(masked) if own else [])
        of_entity.update(own)
        spread.update({t for t, _, _ in plain_terms(text)})
        both.update((x, t) for x in own for t in {t for t, _, _ in terms[-1]})
    told = {}
    for (x, t), n in both.items():
        if n >= support and of_entity[x] < len(texts):
            shared = np.log(len(texts) * n / (of_entity[x] * max(spread[t], n))) / np.log(len(texts) / of_entity[x])
            if shared >= hint - 1e-12:
                told[x, t] = "term" if shared >= remove else "hint"
    found = []
    for own, places in zip(entities, terms):
        kinds = {}
        for t, s, e in places:
            kind = max((told[x, t] for x in own if (x, t) in told), default=None)
            if kind:
                kinds[s, e] = max(kind, kinds.get((s, e), kind))
        found.append({k: sorted(p for p, kind in kinds.items() if kind == k) for k in pii.TERM_KINDS})
    return found


def check_terms(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = plain_spans(texts)
    for r in pii.personal_data(frame).collect():
        got = {k: [tuple(s) for s in r[k]] for k in pii.TERM_KINDS}
        assert got == expected[r["doc_id"]], (r["doc_id"], texts[r["doc_id"]][:200])
    return expected


FORMS = ["Zanzibar", "(Timbuktu)", "Samarkand's", "Bukhara’s", '"Tashkent"', "Anne-Marie", "Zoe", "zanz99", "Z", "桑给巴尔", "ザンジバル島に", "a.Khiva/b",
         "แซนซิบาร์", "Ζανζιβάρη,", "«Занзибар»", "ਜ਼ਾਂਜ਼ੀਬਾਰ", "x\u0301yz"]


def test_every_form_of_a_term_is_told_and_marked(spark):
    other = "people write about other people"
    texts = [f"{other} {form} number{k}x{i} user{k}@corp.com {other}" for k, form in enumerate(FORMS) for i in range(6)]
    expected = check_terms(spark, texts + [f"{other} of a b {i}" for i in range(600)])
    for n, text in enumerate(texts):
        form = FORMS[n // 6]
        at = text.index(form)
        covered = {p for s, e in expected[n]["term"] + expected[n]["hint"] for p in range(s, e)}
        letters = {at + i for i, c in enumerate(form) if regex.match(r"[\p{L}\p{M}\p{N}]", c)}
        assert letters - covered == ({at, at + 8} if "/" in form else set()), form  # a and b are everywhere


def test_planted_terms_on_the_given_documents_equal_brute_force(spark):
    """Names beside addresses, by rule: every fifth document holds one of eight addresses and a name that goes with it."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    names = ["(Zanzibar)", "Anne-Marie", "Zoe's", "zanz99", "桑给巴尔岛", "Ўзбек", "harbour", "x7"]
    texts = []
    for i, r in enumerate(rows):
        text = r["text"] or ""
        if i % 5 == 0:
            k = i // 5 % 8
            near = f"write to user{k}@corp{k}.com or 10.0.{k}.{k}"
            text = f"{text} {names[k]} {near}" if i % 3 else f"{near}\n{text[:3000]}\n{names[k]}"
        elif i % 37 == 0:
            text += " harbour"
        texts.append(text)
    expected = check_terms(spark, texts)
    marked = sum(bool(e["term"] or e["hint"]) for e in expected)
    print(f"{marked} of {len(texts)} documents have a disclosing term")
    assert marked >= 190


def test_a_place_that_is_a_term_for_one_entity_and_a_hint_for_another(spark):
    texts = [f"harbour a{i} one@corp.com two@corp.com" for i in range(4)] + [f"two@corp.com b{i}" for i in range(2)] + ["other words"] * 100
    expected = check_terms(spark, texts)
    assert expected[0]["term"] and not set(expected[0]["term"]) & set(expected[0]["hint"])


def test_parts_of_an_entity_are_no_terms(spark):
    texts = [f"bob@corp.com 10.1.2.3, +1 234 567 890, {CARD}, n{i}" for i in range(5)] + ["other words"] * 100
    assert not any(e["term"] or e["hint"] for e in check_terms(spark, texts))


def test_recall_by_kind(spark):
    """The base spans of each kind on the given documents, against the patterns read one by one."""
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    found = rows_of(spark, texts)
    for kind in pii.KINDS:
        planted = {(i, *s) for i, t in enumerate(texts) for s in plain(t)[kind]}
        assert planted and planted == {(i, *s) for i, r in found.items() for s in r[kind]}
        print(kind, len(planted), "recall 1.00")
