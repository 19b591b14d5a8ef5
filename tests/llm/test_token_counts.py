import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from sidelines.llm import registry
from sidelines.llm.token_counts import Automaton, pieces_of, token_counts, vocabulary_of


def plain(word, heads, tails):
    """The number of greedily longest pieces, 0 if the word can't be cut."""
    at, n = 0, 0
    while at < len(word):
        pieces = heads if at == 0 else tails
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        at, n = end, n + 1
    return n


words = st.text("abc", min_size=1, max_size=7)


@settings(max_examples=400, deadline=None)
@given(st.lists(words, max_size=12), st.lists(words, max_size=12), st.lists(st.text("abcd", min_size=1, max_size=14), max_size=30))
def test_the_automaton_equals_greedy_search(heads, tails, texts):
    automaton = Automaton(heads, tails)
    for word in texts:
        assert automaton.count(word) == plain(word, set(heads), set(tails)), word


def test_single_letters_and_long_matches_that_fail():
    heads, tails = ["a", "ab", "abcdx"], ["b", "c", "d", "cde", "bcdef"]
    automaton = Automaton(heads, tails)
    for word in ("abcd", "abcdx", "abcde", "abcdef", "abbcdefcdx", "x", "ax", "a" * 3, "abcdy"):
        assert automaton.count(word) == plain(word, set(heads), set(tails)), word


def test_documents_equal_greedy_search(spark):
    heads, tails = pieces_of(public_tokenizers.path("piece_bpe_32k.model"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r["doc_id"]: r for r in token_counts(docs, heads, tails, most_words=50).collect()}
    head_set, tail_set, known = set(heads), set(tails), {}
    for row in docs.collect():
        own = row["text"].encode().split()
        counts = [known.setdefault(w, plain(w.decode(), head_set, tail_set)) for w in own]
        r = found[row["doc_id"]]
        assert (r["n_words"], r["n_tokens"], r["n_unknown"]) == (len(own), sum(c or 1 for c in counts), counts.count(0))
    assert set(docs.columns) < set(found[0].asDict())


def test_odd_rows_and_columns(spark):
    heads, tails = ["a", "ab"], ["b", "é"]
    rows = [(1, None, 5), (2, "", 5), (3, " \n\t", 5), (None, "ab abb é aé\x0ba", 5), (4, "ab " * 100_000, 5), (4, "b" * 100_000, 5)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, `N_Tokens` int")
    found = token_counts(docs, heads, tails)
    assert found.columns == ["doc_id", "text", "N_Tokens", "n_words", "n_unknown"]
    got = sorted((str(r["doc_id"]), r["n_words"], r["N_Tokens"], r["n_unknown"]) for r in found.collect())
    assert got == sorted([("1", 0, 0, 0), ("2", 0, 0, 0), ("3", 0, 0, 0), ("None", 5, 7, 1), ("4", 100_000, 100_000, 0), ("4", 1, 1, 1)] * 2)
    assert token_counts(docs.limit(0), heads, tails).count() == 0
    assert token_counts(docs.limit(3), [], []).count() == 3


def test_long_words_are_linear():
    automaton = Automaton(["a" * 50], ["a" * 50, "a"])
    assert automaton.count("a" * 100_049) == 2000 + 49


def plain_marked(word, pieces, byte_pieces):
    """Greedily longest pieces of the word with its mark, characters that none fits as bytes; 0 if it can't be cut."""
    word, at, n, most = "▁" + word, 0, 0, max(map(len, pieces), default=0)
    while at < len(word):
        end = next((e for e in range(min(len(word), at + most), at, -1) if word[at:e] in pieces), None)
        if end is None and not byte_pieces:
            return 0
        at, n = (end, n + 1) if end else (at + 1, n + len(word[at].encode()))
    return n


marked = st.text("ab▁é", min_size=1, max_size=6)


@settings(max_examples=600, deadline=None)
@given(st.lists(marked, max_size=14), st.booleans(), st.lists(st.text("abé▁漢", min_size=1, max_size=14), max_size=30))
def test_the_mark_and_bytes_equal_greedy_search(pieces, byte_pieces, texts):
    pieces = {*pieces, "▁"}
    automaton = Automaton([p[1:] for p in pieces if p[0] == "▁"], [p for p in pieces if p[0] != "▁"], True, byte_pieces)
    for word in texts:
        assert automaton.count(word) == plain_marked(word, pieces, byte_pieces), word


def all_pieces():
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    kinds = model.is_control, model.is_unknown, model.is_byte
    return {model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(kind(i) for kind in kinds)}


def test_the_whole_vocabulary_cuts_every_word():
    automaton, pieces = Automaton(**vocabulary_of(public_tokenizers.path("piece_bpe_32k.model"))), all_pieces()
    for word in ("ça", "être", "ñandú", "ß", "word", "🙂", "a🙂b", "漢字かな交じり文", "a▁b", "▁▁▁x▁", "𐍈𐍈", "x" * 300, "\u0301"):
        assert automaton.count(word) == plain_marked(word, pieces, True) > 0, word


def test_the_query_equals_greedy_search(spark):
    sf_dir = "/root/testdata/sf0.001"
    pieces, known = all_pieces(), {}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = registry.queries()["op5_token_counts"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = [w.decode() for w in texts[r["doc_id"]].encode().split()]
        counts = [known.setdefault(w, plain_marked(w, pieces, True)) for w in own]
        assert (r["n_words"], r["n_tokens"], r["n_unknown"]) == (len(own), sum(counts), 0)
