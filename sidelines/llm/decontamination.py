"""Benchmark items in training documents: BM25 over windows of every document, with block-max WAND, then an exact check.

The test items are the indexed collection, the documents' windows are the queries. Scores are divided by what a unit
of an item scores against itself, so that one threshold holds for all. The index is cut into shards of a bounded number of
characters. Executors build the shards and keep them as files in the shared folder, from where a worker reads one at a
time; every document meets every shard, one shard after the other.
"""

from __future__ import annotations

import functools
import math
import pickle
import re
import uuid
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidelines.llm.common import beside_row, row_with
from sidelines.session import new_folder, written

K1, B = 1.2, 0.75
UNIT = 48  # words of an item that are scored together; a window is twice as long and starts every so many words
SHINGLE, SIMILARITY = 5, 0.8
BLOCK = 4  # units that share an upper bound
GROUPS = 64  # of blocks, for a first bound over many windows at once
MATCH = "struct<item_id: bigint, score: double, overlap: double, question: double, answer: double>"

# ASCII punctuation and control characters separate words; other characters belong to them.
_SPLIT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


# Scripts that do not part words by blanks: Thai to Myanmar, Khmer, Chinese and Japanese; each character is a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u31f0-\u31ff\u3400-\u4dbf"
                       "\u4e00-\u9fff\uf900-\ufaff\uff01-\uff9f\U00020000-\U0003ffff]")


def words_of(text: str | None) -> list[bytes]:
    text = (text or "").lower()
    if not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \g<0> ", text)
    return text.encode().translate(_SPLIT).split()


def units_of(words: list[bytes]) -> list[list[bytes]]:
    """The words in even parts of at most ``UNIT`` words: a short rest of common words would be found everywhere."""
    n = -(-len(words) // UNIT)
    return [words[len(words) * i // n:len(words) * (i + 1) // n] for i in range(n)]


def question_and_answer(text: str) -> tuple[str, str]:
    """The last line is the answer, or the last sentence of a single line; one sentence alone is a question."""
    lines = [line for line in text.split("\n") if line.strip()]
    if len(lines) > 1:
        return "\n".join(lines[:-1]), lines[-1]
    line = lines[0].strip() if lines else ""
    at = max(line.rfind(end, 0, len(line) - 1) for end in (". ", "? ", "! "))
    return (line[:at + 1], line[at + 1:]) if at > 0 else (line, "")


def judged_parts(text: str) -> tuple[str, str]:
    """Question and answer as they are judged: an answer of fewer than five words with the sentences before it.

    If that leaves fewer than five words of question, the text is judged as a whole: one edit would undo a part so short.
    """
    question, answer = question_and_answer(text)
    while answer and question and len(words_of(answer)) < SHINGLE:
        question = question.rstrip()
        at = max(question.rfind(end, 0, len(question) - 1) for end in (". ", "? ", "! ", "\n"))
        question, answer = question[:at + 1], question[at + 1:] + "\n" + answer
    return (question, answer) if len(words_of(question)) >= SHINGLE else (question + answer, "")


def shingles(words: list[bytes], size: int = SHINGLE) -> list[tuple[bytes, ...]]:
    """Runs of that many words; fewer words are a run as a whole."""
    return list(zip(*[words[i:] for i in range(size)])) if len(words) >= size else [tuple(words)] if words else []


@dataclass
class Postings:
    """A term's units in rising order, their weights, and the largest weight within each block of units."""

    units: list[int]
    weights: list[float]
    most: float
    block_most: dict[int, float]


class Index:
    """One shard of the items. ``frequency`` and ``n_units``, ``mean_words`` describe all of them, not the shard alone."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[bytes, int], n_units: int, mean_words: float,
                 threshold: float):
        self.threshold = threshold
        self.items, units = [], []
        for item_id, text in items:
            question, answer = (words_of(part) for part in judged_parts(text))
            words = words_of(text)
            units += [(len(self.items), own) for own in units_of(words)]
            self.items.append((item_id, words, shingles(words), Counter(question), Counter(answer)))
        scored = []
        for item, words in units:
            long = K1 * (1 - B + B * len(words) / mean_words)
            weights = {t: math.log(1 + (n_units - frequency[t] + 0.5) / (frequency[t] + 0.5)) * n * (K1 + 1) / (n + long)
                       for t, n in Counter(words).items()}
            scored.append((sum(weights.values()), item, weights))
        # Units with the same most frequent term, thus mostly in one language, and of similar totals share blocks: a
        # term's bound is then low in the blocks of other languages.
        scored.sort(key=lambda s: (max((frequency[t], t) for t in s[2]), s[0]))
        self.item_of = [item for _, item, _ in scored]
        lists = defaultdict(list)
        for unit, (total, _, weights) in enumerate(scored):
            for term, weight in weights.items():
                lists[term].append((unit, weight / total))
        self.term_id = {term: i for i, term in enumerate(lists)}
        self.lists: list[Postings] = []
        self.group = max(1, -(-len(scored) // (GROUPS * BLOCK)))  # blocks in a group
        self.bounds = np.zeros((len(lists), GROUPS), np.float32)
        for i, postings in enumerate(lists.values()):
            block_most: dict[int, float] = {}
            for unit, weight in postings:
                block_most[unit // BLOCK] = max(block_most.get(unit // BLOCK, 0.0), weight)
            self.lists.append(Postings([u for u, _ in postings], [w for _, w in postings], max(w for _, w in postings),
                                       block_most))
            for block, most in block_most.items():
                self.bounds[i, block // self.group] = max(most, self.bounds[i, block // self.group])
        self.coarse = np.ascontiguousarray(self.bounds.reshape(len(lists), -1, GROUPS // 8).max(axis=2))
        self.most = self.coarse.max(axis=1)

    def wand(self, terms: list[int]) -> list[tuple[int, float]]:
        """All units that score at least the threshold for a window with these distinct terms: (unit, score)."""
        end, least = len(self.item_of), self.threshold
        cursors = [[self.lists[t].units[0], 0, self.lists[t]] for t in terms]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for i, cursor in enumerate(cursors):  # the first unit that all lists before it could lift to the threshold
                bound += cursor[2].most
                if bound >= least:
                    pivot = i
                    break
            if pivot < 0:
                break
            unit = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == unit:
                pivot += 1
            block = unit // BLOCK
            if sum(c[2].block_most.get(block, 0.0) for c in cursors[:pivot + 1]) < least:
                # nor can any other unit of this block before the next list sets in
                following = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    following = min(following, cursors[pivot + 1][0])
                target = max(following, unit + 1)
            elif cursors[0][0] == unit:
                score = sum(c[2].weights[c[1]] for c in cursors[:pivot + 1])
                if score >= least:
                    found.append((unit, score))
                target = unit + 1
            else:
                target = unit
            for cursor in cursors[:pivot + 1]:
                units, at = cursor[2].units, cursor[1]
                if at < len(units) and units[at] < target:
                    at = bisect_left(units, target, at)
                cursor[0], cursor[1] = (units[at] if at < len(units) else end), at
            cursors = [c for c in cursors if c[0] < end]
        return found

    def candidates(self, documents: list[list[bytes]]) -> Iterator[tuple[int, int, list[int]]]:
        """(document, first word, terms) of the windows whose terms' bounds reach the threshold in some group of units."""
        look = self.term_id.get
        ids = [np.fromiter(map(look, words, repeat(-1)), np.int64, len(words)) for words in documents]
        sizes = np.array([len(i) for i in ids])
        windows = -(-sizes // UNIT)
        first = np.concatenate([[0], np.cumsum(windows)])
        chunk = np.concatenate([np.arange(len(i)) // UNIT + f for i, f in zip(ids, first)]) if len(ids) else np.empty(0)
        chunk, terms = chunk.astype(np.int64), np.concatenate(ids) if len(ids) else np.empty(0, np.int64)
        known = terms >= 0
        chunk, terms = chunk[known], terms[known]
        begins = np.zeros(first[-1] + 1, bool)
        begins[first] = True
        follows = ~begins[chunk]  # also in the window that began a chunk before
        n = len(self.lists)
        key = np.sort(np.concatenate([chunk * n + terms, (chunk[follows] - 1) * n + terms[follows]]))
        window, term = np.divmod(key[np.diff(key, prepend=-1) > 0], n)
        for bounds in (self.most[:, None], self.coarse, self.bounds):  # fewer windows are left for each finer bound
            if len(window):
                kept = self._reach(window, term, bounds) >= self.threshold - 1e-4
                window, term = window[kept], term[kept]
        for part in np.split(np.arange(len(window)), np.flatnonzero(np.diff(window)) + 1) if len(window) else []:
            document = int(np.searchsorted(first, window[part[0]], "right")) - 1
            yield document, int(window[part[0]] - first[document]) * UNIT, term[part].tolist()

    @staticmethod
    def _reach(window: np.ndarray, term: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each (window, term), in order of windows: the most that the window's terms reach together in a column."""
        cuts = np.r_[0, np.flatnonzero(np.diff(window)) + 1]
        reach = np.empty(len(cuts), np.float32)
        for low in range(0, len(cuts), 4_000):
            at = cuts[low:low + 4_000]
            stop = cuts[low + 4_000] if low + 4_000 < len(cuts) else len(window)
            reach[low:low + 4_000] = np.add.reduceat(bounds[term[at[0]:stop]], at - at[0], axis=0).max(axis=1)
        return np.repeat(reach, np.diff(np.r_[cuts, len(window)]))

    def matches(self, texts: list[str | None]) -> list[list[dict]]:
        """For each text the items that it holds, each with its best score and its overlaps."""
        documents = [words_of(t) for t in texts]
        scores: list[dict[int, tuple[float, int]]] = [{} for _ in texts]
        regions: dict[tuple[int, int], list[int]] = defaultdict(list)
        for document, start, terms in self.candidates(documents):
            for unit, score in self.wand(terms):
                item = self.item_of[unit]
                best = scores[document].get(item, (0.0, 0))
                scores[document][item] = max(best, (score, start))
                regions[document, item].append(start)
        found: list[list[dict]] = [[] for _ in texts]
        for (document, item), starts in regions.items():
            item_id, words, own, question, answer = self.items[item]
            best = None
            for start in sorted(set(starts)):
                near = documents[document][max(0, start - len(words)):start + 2 * UNIT + len(words)]
                # an item of fewer words than a shingle is looked for as a whole
                there, held = set(shingles(near, min(SHINGLE, len(words)))), Counter(near)
                overlap = sum(s in there for s in own) / len(own)
                parts = [(question & held).total() / question.total() if question else 1.0,
                         (answer & held).total() / answer.total() if answer else 1.0]
                if min(overlap, *parts) >= SIMILARITY:
                    best = max(best or (0.0,), (overlap, *parts))
            if best:
                found[document].append({"item_id": item_id, "score": scores[document][item][0], "overlap": best[0],
                                        "question": best[1], "answer": best[2]})
        return found


def _terms(items: DataFrame) -> DataFrame:
    """A row per unit and distinct term of ``items(shard, text)``, and per unit its number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards, terms, sizes = [], [], []
            for shard, text in zip(batch.column("shard").to_pylist(), batch.column("text").to_pylist()):
                for unit in units_of(words_of(text)):
                    own = sorted(set(unit))
                    shards += [shard] * len(own)
                    terms += own
                    sizes += [len(unit)] + [None] * (len(own) - 1)
            columns = [pa.array(shards, pa.int32()), pa.array(terms, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "term", "words"])

    return items.select("shard", "text").mapInArrow(run, "shard int, term binary, words long")


def indexes(items: DataFrame, threshold: float = 0.6, shard_chars: int = 4_000_000) -> list[str]:
    """Files in the shared folder, each with the ``Index`` of some of the ``items(item_id, text)``, of about ``shard_chars``
    characters. A task builds a shard from its items and the frequencies of their terms; the driver learns the names only."""
    items = items.filter("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    if not chars:
        return []
    shards = -(-chars // shard_chars)
    placed = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int"))
    placed = written(placed, "benchmark-items") if shards > 1 else placed
    terms = _terms(placed)
    n_units, mean_words = terms.agg(F.count("words"), F.avg("words")).first()
    if not n_units:
        return []
    frequency = terms.groupBy("term").agg(F.count("*").alias("n"))
    counted = terms.select("shard", "term").distinct().join(frequency, "term")
    none = {name: F.lit(None).cast(kind).alias(name) for name, kind in
            (("item_id", "long"), ("text", "string"), ("term", "binary"), ("n", "long"))}
    rows = (placed.select("shard", "item_id", "text", none["term"], none["n"])
            .union(counted.select("shard", none["item_id"], none["text"], "term", "n"))
            .repartition(shards, "shard").sortWithinPartitions("shard"))
    folder = new_folder(items.sparkSession, "benchmark-index")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        shard, own, counts, names = None, [], {}, []

        def finish() -> None:
            if own:
                name = f"{shard}-{uuid.uuid4().hex}"  # the names of successful attempts are the ones that count
                index = Index(sorted(own, key=lambda i: (i[0] is None, i)), counts, n_units, mean_words, threshold)
                with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                    out.write(pickle.dumps(index, pickle.HIGHEST_PROTOCOL))
                names.append(f"{folder}/{name}")

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("shard", "item_id", "text", "term", "n")]):
                if row[0] != shard:
                    finish()
                    shard, own, counts = row[0], [], {}
                if row[3] is not None:
                    counts[row[3]] = row[4]
                elif words_of(row[2]):
                    own.append((row[1], row[2]))
        finish()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    return sorted(r["name"] for r in written(rows.mapInArrow(build, "name string"), "benchmark-index-files").collect())


@functools.lru_cache(maxsize=1)
def loaded(name: str) -> Index:
    """The index in a file; a worker holds the last one that it read."""
    store, path = FileSystem.from_uri(name)
    with store.open_input_file(path) as file:
        return pickle.loads(file.read())


def _search(name: str):
    kind = pa.struct([("item_id", pa.int64()), *[(n, pa.float64()) for n in ("score", "overlap", "question", "answer")]])
    step = 256  # texts at a time, to bound the arrays of terms

    @F.arrow_udf(f"array<{MATCH}>")
    def search(texts: pa.Array) -> pa.Array:
        index = loaded(name)
        matches = [m for i in range(0, len(texts), step) for m in index.matches(texts.slice(i, step).to_pylist())]
        return pa.array(matches, pa.list_(kind))

    return search


def with_matches(documents: DataFrame, items: DataFrame, threshold: float = 0.6, shard_chars: int = 4_000_000) -> DataFrame:
    """``documents`` with ``matches``: the benchmark items that its text holds, with score and overlaps.

    An item is held if a window scores at least ``threshold`` of what a unit of the item scores itself (all units of up
    to 48 words are retrieved so), at least 0.8 of the item's five-word shingles are around that window, and so are 0.8
    of the words of its question and of its answer (see ``judged_parts`` for short ones); an item of fewer than five words is
    held where its words stand in sequence. A null or empty text holds nothing, and nothing is held of no items or of one
    without a word. Repeated rows and other columns stay; equal items under several ids are found under each. With
    several shards the rows are written between them.
    """
    rows = beside_row(documents, _text=F.col("text")).withColumn("_matches", F.array().cast(f"array<{MATCH}>"))
    names = indexes(items, threshold, shard_chars)
    for i, name in enumerate(names):
        rows = rows.withColumn("_matches", F.concat("_matches", _search(name)("_text")))
        if i + 1 < len(names):
            rows = written(rows, "searched")
    return row_with(rows, documents.columns, matches=F.col("_matches"))


def contaminated(documents: DataFrame, items: DataFrame, threshold: float = 0.6) -> DataFrame:
    """``(doc_id, item_id, score, overlap, question, answer)`` of ``documents(doc_id, text)``, a row per pair."""
    found = with_matches(documents.select("doc_id", "text"), items, threshold).select("doc_id", F.inline("matches"))
    return found.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("score", "overlap", "question", "answer")])


def without_leaks(documents: DataFrame, items: DataFrame, threshold: float = 0.6) -> DataFrame:
    """The rows of ``documents``, all columns, that hold no benchmark item."""
    marked = with_matches(beside_row(documents, text=F.col("text")), items, threshold)
    return row_with(marked.filter("size(matches) = 0"), documents.columns)
