"""Sequences of a fixed number of tokens, packed online by the sum-of-squares rule.

Every input partition is packed by itself, so nothing is shuffled. A document's full windows are sequences of their own; what
is left over goes to the partially filled window for which the sum of the squared counts of windows per fill level
becomes least. Rows are complete per task: a task that runs again replaces its sequences as a whole.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
_TYPES = {**{c.split()[0]: pa.int64() for c in PIECES.split(", ")}, "ids": pa.binary()}
ID_BYTES = 4
STEP = 128  # documents whose words are in memory at a time


class WordIds:
    """Token ids (packed, little-endian, 4 bytes each) of whole texts, looked up word by word.

    Only for tokenizers that drop white space, fold A-Z to lower case and part letters from punctuation before they look
    for tokens, and leave a word of a-z as it is. Words seen before come from a table; when it holds ``most_words`` it becomes
    the older one, from which words that come again are taken over, and the one that was older goes.
    """

    _PUNCTUATION = bytes(c for c in range(128) if not chr(c).isalnum())

    def __init__(self, tokenizer_json: str, most_words: int = 300_000):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.most_words = most_words
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        suffix = json.loads(tokenizer_json)["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)  # of words
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.bare = Tokenizer(self.tokenizer.model)  # for words of a-z, which need no preparation
        self.bare.pre_tokenizer = WhitespaceSplit()

    def _encode(self, text: str, tokenizer: Tokenizer | None = None) -> np.ndarray:
        tokenizer = tokenizer or self.tokenizer
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _taken_over(self, words: set[bytes]) -> set[bytes]:
        """The words that neither table holds; those of the older one are known from now on."""
        again = [w for w in words if w in self.older]  # an intersection would walk through the table
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        return words.difference(again)

    def _learn(self, words: set[bytes]) -> None:
        """Put words into the table: a word and the punctuation after it are looked up each for itself."""
        words, ended = self._taken_over(words), {}
        for w in words:
            if not w.isalpha():
                stem = w.rstrip(self._PUNCTUATION)
                # other letters than small ones may end in a mark once they are normalised, which goes with the punctuation
                if len(stem) < len(w) and (stem[-1:].isalpha() or not stem.isascii() and (t := stem.decode()).isalpha() and t[-1].islower()):
                    ended[w] = stem, w[len(stem):]
        new = self._taken_over(words.difference(ended).union(*ended.values()).difference(self.known))
        plain = [p for p in new if p.isalpha()]
        letters = [p for p in new if not p.isascii() and p.decode().isalpha()]
        for words, tokenizer in ((plain, self.bare), (letters, self.tokenizer)):  # each a single word to the tokenizer
            for i in range(0, len(words), 1000):
                some = words[i:i + 1000]
                ids = self._encode(b" ".join(some).decode(), tokenizer)
                last = np.flatnonzero(self.ends[ids]) + 1
                if len(last) == len(some):
                    packed, cuts = ids.tobytes(), [0, *(last * ID_BYTES).tolist()]
                    self.known.update((w, packed[m:n]) for w, m, n in zip(some, cuts, cuts[1:]))
        for p in new:
            if p not in self.known:
                self.known[p] = self._encode(p.decode()).tobytes()
        look = self.known.__getitem__
        self.known.update((w, look(stem) + look(end)) for w, (stem, end) in ended.items())

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.most_words:
            self.older, self.known = self.known, {}
        whole = [any(a in t for a in self.added) for t in texts]  # an added token may be part of any word
        words = [[] if w else t.encode().lower().split() for t, w in zip(texts, whole)]
        new = set().union(*words).difference(self.known)
        self._learn(new)
        look = self.known.__getitem__
        return [self._encode(t).tobytes() if w else b"".join(map(look, ws)) for t, w, ws in zip(texts, whole, words)]


@functools.lru_cache(maxsize=1)
def word_ids(tokenizer_json: str, most_words: int) -> WordIds:
    """One table for all tasks that a Python worker runs one after the other."""
    return WordIds(tokenizer_json, most_words)


class Windows:
    """Partially filled windows by fill level, and the rule that picks one."""

    def __init__(self, size: int):
        self.size = size
        self.by_level: list[list[list]] = [[] for _ in range(size)]
        # Twice the count of windows at each level. Level 0 stands for a new window: leaving it costs no square, which
        # the 1 expresses; a full window does not count either, hence the -1.
        self.level = np.zeros(size + 1, np.int64)
        self.level[0], self.level[size] = 1, -1
        self.there = np.zeros(size + 1, bool)
        self.there[0] = True
        self.n = 0

    def place(self, piece: tuple, length: int) -> list | None:
        """Put a piece of 0 < length < size where the sum of squares ends least, ties to the fullest; a full window is returned."""
        last = self.size - length
        change = np.where(self.there[:last + 1], self.level[length:] - self.level[:last + 1], np.iinfo(np.int64).max)
        at = last - int(np.argmin(change[::-1]))
        window = self._leave(at) if at else []
        window.append(piece)
        if at + length == self.size:
            return window
        self._enter(at + length, window)
        return None

    def _leave(self, level: int) -> list:
        window = self.by_level[level].pop()
        self.level[level] -= 2
        self.there[level] = bool(self.by_level[level])
        self.n -= 1
        return window

    def _enter(self, level: int, window: list) -> None:
        self.by_level[level].append(window)
        self.level[level] += 2
        self.there[level] = True
        self.n += 1

    def close(self) -> Iterator[list]:
        """Empty the table: the fullest windows are filled up with pieces of the emptiest, cut where needed. What
        remains, less than a window, goes to sequences whose lengths are powers of two, which need no padding."""
        left = [(level, w) for level in range(1, self.size) for w in self.by_level[level]]
        self.__init__(self.size)
        spare: list[tuple] = []
        while left:
            level, window = left.pop()
            while level < self.size and (spare or left):
                if not spare:
                    spare = left.pop(0)[1][::-1]
                piece, spare = spare[-1], spare[:-1]
                room = self.size - level
                head, tail = cut(piece, room)
                window.append(head)
                level += len(head[2]) // ID_BYTES
                if tail:
                    spare.append(tail)
            if level == self.size:
                yield window
            else:
                yield from _powers(window)
        if spare:
            yield from _powers(spare[::-1])


def cut(piece: tuple, room: int) -> tuple[tuple, tuple | None]:
    """A piece (doc_id, start, ids, doc_tokens) as its first ``room`` ids and the rest."""
    doc_id, start, ids, total = piece
    if len(ids) <= room * ID_BYTES:
        return piece, None
    return (doc_id, start, ids[:room * ID_BYTES], total), (doc_id, start + room, ids[room * ID_BYTES:], total)


def _powers(pieces: list[tuple]) -> Iterator[list]:
    """The pieces in sequences whose lengths are the powers of two in their sum, the largest first."""
    rest = pieces[::-1]
    total = sum(len(p[2]) for p in pieces) // ID_BYTES
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        window = []
        while room:
            head, tail = cut(rest.pop(), room)
            window.append(head)
            room -= len(head[2]) // ID_BYTES
            if tail:
                rest.append(tail)
        yield window


def pack(documents: DataFrame, tokenizer_json: str, size: int = 2048, end_id: int = 1, most_open: int = 4096,
         with_ids: bool = False, most_words: int = 300_000) -> DataFrame:
    """Every piece of every row of ``documents(doc_id, text)``: where it starts in its document, and where it lies.

    A document is its tokens and ``end_id``; a null or empty text is ``end_id`` alone. Documents longer than ``size`` are
    cut into full windows and a rest; otherwise only the windows that a partition leaves open at its end, or beyond
    ``most_open`` of them, are cut to fill each other. All sequences are then full or as long as a power of two.
    Repeated rows are packed each for itself, a null doc_id stays null, other columns are ignored, and an empty table
    gives no pieces. ``with_ids`` adds the pieces' ids as little-endian unsigned 32-bit integers. ``most_words`` bounds the
    words that a worker keeps (see ``WordIds``), which outlive the task; results do not depend on it.
    """
    vocabulary = documents.sparkSession.sparkContext.broadcast(tokenizer_json)
    names = [c for c in _TYPES if with_ids or c != "ids"]
    schema = PIECES + (", ids binary" if with_ids else "")
    end = end_id.to_bytes(ID_BYTES, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, windows = word_ids(vocabulary.value, most_words), Windows(size)
        sequence = TaskContext.get().partitionId() << 32
        found: list[tuple] = []

        def emit(pieces: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for doc_id, start, ids, total in pieces:
                n = len(ids) // ID_BYTES
                found.append((doc_id, start, n, zlib.crc32(ids), total, sequence, offset, ids)[:len(names)])
                offset += n
            sequence += 1

        def batch() -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * len(names)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[n]) for c, n in zip(columns, names)], names)

        for rows in batches:
            for i in range(0, len(rows), STEP):
                some = rows.slice(i, STEP)
                ids_by_row = ids_of([t or "" for t in some.column("text").to_pylist()])
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), ids_by_row):
                    ids += end
                    rest = (doc_id, 0, ids, len(ids) // ID_BYTES)
                    while rest and len(rest[2]) >= size * ID_BYTES:
                        head, rest = cut(rest, size)
                        emit([head])
                    if rest:
                        full = windows.place(rest, len(rest[2]) // ID_BYTES)
                        if full:
                            emit(full)
                    if windows.n > most_open:
                        for window in windows.close():
                            emit(window)
                yield batch()
        for window in windows.close():
            emit(window)
        yield batch()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def read_tokenizer(path: str) -> str:
    """A tokenizer file's JSON, read by the driver: executors get it as a broadcast of the file's size."""
    with open(path, encoding="utf-8") as file:
        return file.read()
