import re
from collections import Counter

from pyspark.sql import functions as F

from sidelines.llm import quality_rules as q

NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    repeated = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(repeated))


TEXTS = [None, "", " \n\t\x0b", "one two", "a b c d e " * 3, "a b c d e f a b c d e", "x " * 30, "é ü ñ 漢字 \x1c y", "l\nl\n\nl \nl",
         "#*$%&|<>" * 4, "\r\n".join(["the same line here"] * 4), " ".join(f"w{i}" for i in range(20_000)),
         " ".join(f"w{i % 7000}" for i in range(20_000)), "z" * 300_000, "a b c d e f g h i j k a b c d x a b c d y", "  a\u0085b"]


def test_measures_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-i - 1, t) for i, t in enumerate(TEXTS)], docs.schema))
    for row in q.with_measures(docs, "text").collect():
        assert tuple(row["m"][n] for n in NAMES) == plain(row["text"]), row["doc_id"]


GOOD = " ".join(f"word{i}" for i in range(40))
BAD = " ".join(f"word{i}*" for i in range(40))


def corpus(spark, hosts):
    rows, n = [], 0
    for host, good, bad in hosts:
        for text in [GOOD] * good + [BAD] * bad:
            rows.append((n, host, text, "k"))
            n += 1
    return spark.createDataFrame(rows, "doc_id long, source string, text string, kept string")


def test_a_bad_host_goes_as_a_whole_and_a_small_one_is_shrunk(spark):
    hosts = [("good", 60, 2), ("bad", 10, 90), ("tiny", 1, 2), (None, 30, 1), ("", 30, 0)]
    docs = corpus(spark, hosts)
    rows = q.judged(docs, keep_text=False).collect()
    rate = {r["source"]: r["host_rate"] for r in rows}
    assert rate["bad"] > 0.5 > rate["good"] and rate["good"] > 2 / 62
    assert 0.3 < rate["tiny"] < 2 / 3 and rate[None] != rate[""]
    kept = Counter(r["source"] for r in rows if r["kept"])
    assert kept == {"good": 60, None: 30, "": 30, **({"tiny": 1} if rate["tiny"] <= 0.5 else {})}
    good = q.good_documents(docs)
    assert good.columns == docs.columns
    assert Counter(r["source"] for r in good.collect()) == kept
    assert {r["kept"] for r in good.collect()} == {"k"}  # the documents' own column


def test_the_prior_follows_how_hosts_scatter(spark):
    def rates(hosts):
        rows = [(h, i < bad) for h, n, bad in hosts for i in range(n)]
        return {r["host"]: r["rate"] for r in q.host_rates(spark.createDataFrame(rows, "host string, failed boolean")).collect()}

    alike = rates([("a", 100, 20), ("b", 100, 20), ("c", 4, 4)])
    apart = rates([("a", 100, 2), ("b", 100, 95), ("c", 4, 4)])
    assert alike["c"] < 0.5 < apart["c"]  # with hosts that scatter, four documents say more


def test_odd_tables(spark):
    docs = spark.createDataFrame([(i // 2, "h", t) for i, t in enumerate(TEXTS * 2)], "doc_id long, source string, text string")
    rows = q.judged(docs).collect()
    assert len(rows) == 2 * len(TEXTS)
    by_text = {r["text"]: r for r in rows}
    assert by_text[None]["base_failed"] and not by_text[None]["kept"] and by_text[TEXTS[11]]["base_failed"] is False
    assert q.judged(docs.limit(0)).count() == 0 and q.good_documents(docs.limit(0)).count() == 0


def test_labels_of_the_documents(spark):
    """What the labels call good is kept, unless the base fails; what they call bad mostly goes."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = q.judged(docs, keep_text=False).join(labels, "doc_id")
    n = rows.agg(F.expr("count_if(quality = 1 and not base_failed) good"), F.expr("count_if(quality = 1 and kept) kept"),
                 F.expr("count_if(quality = 0) bad"), F.expr("count_if(quality = 0 and not kept) gone")).first()
    assert n["kept"] >= 0.99 * n["good"] and n["gone"] >= 0.9 * n["bad"]
