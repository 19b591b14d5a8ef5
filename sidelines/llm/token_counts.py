"""Greedy word-piece lengths by a linear longest-match automaton, without building the pieces.

The vocabulary is a trie whose nodes know where a match that gets stuck goes on (the failure link) and how many
pieces it has then passed (the popped pieces). A word is read once, character by character.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidelines.llm.common import beside_row, row_with


MARK = "▁"  # of a word's begin


class Automaton:
    """``heads`` may begin a word, ``tails`` may go on with one. Counting is linear in the word's length.

    With ``bare_mark`` the mark of a word's begin is a piece of its own: a word that no head fits is cut into the mark
    and tails. With ``byte_pieces`` a character that no piece fits is cut into its bytes.
    """

    def __init__(self, heads: list[str], tails: list[str], bare_mark: bool = False, byte_pieces: bool = False):
        self.next: list[dict[str, int]] = [{}, {}]  # 0: before a word, 1: within a word, between two pieces
        self.pops: list[int] = [0, 0]
        self.fail: list[int] = [-1, -1]
        self.byte_pieces = byte_pieces
        if bare_mark or byte_pieces:
            self.fail[0], self.pops[0] = 1, 1 if bare_mark else len(MARK.encode())
        whole = {self._add(root, piece) for root, pieces in ((0, heads), (1, tails)) for piece in pieces if piece}
        if bare_mark:
            self.next[1].setdefault(MARK, 0)  # a mark within a word may begin a piece as that of the word does
        self._link(whole)

    def _add(self, node: int, piece: str) -> int:
        for char in piece:
            if char not in self.next[node]:
                self.next[node][char] = len(self.next)
                self.next.append({})
                self.pops.append(0)
                self.fail.append(-1)
            node = self.next[node][char]
        return node

    def _link(self, whole: set[int]) -> None:
        """Breadth first, so that shorter matches are linked before the longer ones that fall back on them."""
        queue = deque((node, child, char) for node in (0, 1) for char, child in self.next[node].items() if child)
        while queue:
            parent, node, char = queue.popleft()
            if node in whole:  # all that was read is one piece
                self.fail[node], self.pops[node] = 1, 1
            else:  # what the parent falls back on, and on from there until the character fits
                back, pops = self.fail[parent], self.pops[parent]
                while back >= 0 and char not in self.next[back]:
                    pops += self.pops[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[node], self.pops[node] = self.next[back][char], pops
                elif self.byte_pieces:
                    self.fail[node], self.pops[node] = 1, pops + len(char.encode())
            queue.extend((node, child, c) for c, child in self.next[node].items())

    def count(self, word: str) -> int:
        """Pieces of a word, or 0 if it can't be cut into pieces."""
        following, fail, pops = self.next, self.fail, self.pops
        node = n = 0
        for char in word:
            while char not in following[node]:
                if node == 1 and self.byte_pieces:
                    n += len(char.encode())
                    break
                n += pops[node]
                node = fail[node]
                if node < 0:
                    return 0
            else:
                node = following[node][char]
        while node > 1 or node == 0 < fail[node]:
            n += pops[node]
            node = fail[node]
        return n if node == 1 else 0


def pieces_of(model_path: str) -> tuple[list[str], list[str]]:
    """Heads and tails of a SentencePiece model: pieces with the mark of a word's begin, without it, and the others."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    pieces = _pieces(model)
    return [p[1:] for p in pieces if p.startswith(MARK) and p != MARK], [p for p in pieces if MARK not in p]


def _pieces(model) -> list[str]:
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def vocabulary_of(model_path: str) -> dict:
    """All pieces of a SentencePiece model, as ``token_counts`` takes them: the bare mark and the bytes too."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    pieces = _pieces(model)
    return {"heads": [p[1:] for p in pieces if p.startswith(MARK) and p != MARK],
            "tails": [p for p in pieces if not p.startswith(MARK)], "bare_mark": MARK in pieces,
            "byte_pieces": sum(model.is_byte(i) for i in range(model.get_piece_size())) == 256}


def token_counts(rows: DataFrame, heads: list[str], tails: list[str], text: str = "text",
                 most_words: int = 500_000, bare_mark: bool = False, byte_pieces: bool = False) -> DataFrame:
    """``rows`` with ``n_words``, ``n_tokens`` and ``n_unknown`` (long) of a text column.

    Words are separated by the white space of ASCII and taken as they are written. A word is cut from the left into the longest
    pieces; one that can't be cut counts as a single, unknown token. With ``bare_mark`` and ``byte_pieces``, which say that
    the vocabulary has such pieces (see ``Automaton``), every word can be cut. Null and empty texts count 0. Each distinct word
    of a task is read once: counts are kept for up to ``most_words`` words, then the table begins anew.
    Every row and column stays; columns of these three names are replaced.
    """
    vocabulary = rows.sparkSession.sparkContext.broadcast((heads, tails, bare_mark, byte_pieces))
    packed = beside_row(rows, _text=F.col(text))
    schema = packed.drop("_text").schema
    for name in ("n_words", "n_tokens", "n_unknown"):
        schema = schema.add(f"_{name}", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = Automaton(*vocabulary.value), {}
        for batch in batches:
            totals = [], [], []
            for value in batch.column("_text").to_pylist():
                words = (value or "").encode().split()  # on bytes: the white space of ASCII
                try:
                    counts = [known[w] for w in words]
                except KeyError:
                    if len(known) > most_words:
                        known.clear()
                    for w in set(words).difference(known):
                        known[w] = automaton.count(w.decode())
                    counts = [known[w] for w in words]
                unknown = counts.count(0)
                for total, value in zip(totals, (len(words), sum(counts) + unknown, unknown)):
                    total.append(value)
            columns = [batch.column("_row"), *[pa.array(t, pa.int64()) for t in totals]]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    counted = packed.mapInArrow(run, schema)
    return row_with(counted, rows.columns, **{n: F.col(f"_{n}") for n in ("n_words", "n_tokens", "n_unknown")})
