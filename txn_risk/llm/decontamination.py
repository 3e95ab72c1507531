"""Benchmark decontamination: Wu-Manber multi-pattern search over the words of documents.

The symbols are words. A table over blocks of two words tells how far the search may jump, the block
at a pattern's end names the bucket of patterns to test, and a direct comparison confirms.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from txn_risk.llm.words import split_words, texts

WINDOW = 10
# Benchmark words that one broadcast table may stand for (about 100 MB in a worker).
BLOCK_WORDS = 200_000
# Blocks whose search tables a worker keeps, and bytes of texts that each block passes over at a time: a benchmark of
# more blocks is compiled anew once for so much text, which takes less time than searching it.
KEPT_BLOCKS = 3
HELD_BYTES = 64 << 20

_RESULT = "doc_id {id}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class WuManber:
    """Patterns of one length in words, each with the numbers of the items that hold it."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set]):
        self.length = length
        self.block = min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(lambda: defaultdict(list))
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                name = self._name(pattern, end)
                self.shift[name] = min(self.shift.get(name, self.jump), length - end)
            head = self._name(pattern, self.block)
            self.buckets[self._name(pattern, length)][head].append((pattern, items))

    def _name(self, words, end: int):
        return words[end - 1] if self.block == 1 else (words[end - 2], words[end - 1])

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """``(start, items)`` for every place where a pattern stands."""
        length, shift, jump, pair = self.length, self.shift.get, self.jump, self.block == 2
        end, size = length, len(words)
        while end <= size:
            block = (words[end - 2], words[end - 1]) if pair else words[end - 1]
            step = shift(block, jump)
            if step:
                end += step
                continue
            start = end - length
            head = (words[start], words[start + 1]) if pair else words[start]
            for pattern, items in self.buckets[block].get(head, ()):
                if tuple(words[start:end]) == pattern:
                    yield start, items
            end += 1


def tables(items: Iterable[tuple[object, str | None]], window: int = WINDOW) -> list[WuManber]:
    """A search table for each length of pattern: ``window`` words, or a shorter item as a whole."""
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        words = split_words(text)
        length = min(window, len(words))
        for i in range(len(words) - length + 1 if words else 0):
            by_length[length][tuple(words[i:i + length])].add(item)
    return [WuManber(n, p) for n, p in sorted(by_length.items())]


def _occurrences(words: list[bytes], searches: Iterable[WuManber]) -> tuple[list[tuple[int, int]], set]:
    """Start and end, in words, of every occurrence, and the items that occur."""
    found: set = set()
    spans = []
    for search in searches:
        for start, items in search.search(words):
            spans.append((start, start + search.length))
            found |= items
    return spans, found


def _covered(spans: list[tuple[int, int]]) -> int:
    """Number of words inside any of the spans."""
    hit = reach = 0
    for start, end in sorted(spans):
        hit += max(0, end - max(start, reach))
        reach = max(reach, end)
    return hit


def _broadcast_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> list:
    """The benchmark as broadcast blocks of a bounded number of words.

    The benchmark is the stated query set. Its rows pass the driver one block at a time, dealt by a
    hash of the text, and each block is held against all documents.
    """
    items = texts(benchmark, id_col, text_col).where(F.length("text") > 0)
    spark = benchmark.sparkSession
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (6 * BLOCK_WORDS)))
    out = []
    for i in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == i) if blocks > 1 else items
        out.append(spark.sparkContext.broadcast([(r.doc_id, r.text) for r in rows.toLocalIterator()]))
    return out


def _search_each(blocks: list, window: int, texts_: list[str | None]) -> list[tuple[int, int, set]]:
    """Number of words, of words hit, and the items found, per text.

    Blocks pass over all texts one after the other; what they find in a text is put together, as occurrences of
    several blocks may overlap.
    """
    sizes = [0] * len(texts_)
    spans: list[list] = [[] for _ in texts_]
    found: list[set] = [set() for _ in texts_]
    for block in blocks:
        searches = _compiled(block, window)
        for k, text in enumerate(texts_):
            words = split_words(text)
            own, items = _occurrences(words, searches)
            sizes[k] = len(words)
            spans[k] += own
            found[k] |= items
    return [(n, _covered(s), f) for n, s, f in zip(sizes, spans, found, strict=True)]


_COMPILED: dict = {}  # by the identity of a block's rows and the window: the rows and their tables, latest use last


def _compiled(block, window: int) -> list[WuManber]:
    rows = block.value
    kept = _COMPILED.pop((id(rows), window), None)
    if kept is None:
        while len(_COMPILED) >= KEPT_BLOCKS:
            del _COMPILED[next(iter(_COMPILED))]
        kept = (rows, tables(rows, window))
    _COMPILED[id(rows), window] = kept
    return kept[1]


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together up to HELD_BYTES, or as they come where one has more."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= HELD_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A window is ``window`` consecutive words of an item; a shorter item with any word is one window.
    A document word inside any occurrence is hit. A null or empty text has no words and no hits. An
    item with a null id still hits, but is neither counted nor named; items of the same id count
    once. The checksum is over the ids sorted as strings and joined by commas (no item: over
    nothing). Repeated rows are judged each for themselves; an empty benchmark hits nothing.
    """
    blocks = _broadcast_blocks(benchmark, item_col, item_text_col, window)
    source = texts(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _held(batches):
            rows = _search_each(blocks, window, part.column(1).to_pylist())
            names = [sorted({str(i) for i in f if i is not None}) for _, _, f in rows]
            yield pa.RecordBatch.from_arrays([
                part.column(0).combine_chunks(),
                pa.array([n for n, _, _ in rows], pa.int64()),
                pa.array([h for _, h, _ in rows], pa.int64()),
                pa.array([len(n) for n in names], pa.int64()),
                pa.array([hashlib.sha256(",".join(n).encode()).hexdigest() for n in names], pa.string()),
                pa.array([h > 0 for _, h, _ in rows], pa.bool_()),
            ], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return source.mapInArrow(judge, _RESULT.format(id=kind.simpleString()))


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, least_words: int = WINDOW, text_col: str = "text", **names: str
) -> DataFrame:
    """The rows of ``docs`` in which fewer than ``least_words`` words are hit; all columns stay.

    A row with a null or empty text has no hits and stays, null ids and repeated rows are judged by their text
    alone, ties do not arise, an empty benchmark keeps all rows, and an empty table gives none.
    """
    blocks = _broadcast_blocks(
        benchmark, names.get("item_col", "item_id"), names.get("item_text_col", "text"), WINDOW
    )

    def hits(column: pa.Array) -> pa.Array:
        return pa.array([h for _, h, _ in _search_each(blocks, WINDOW, column.to_pylist())], pa.int64())

    count = F.arrow_udf(hits, T.LongType())
    return docs.where(count(docs[text_col].cast("string")) < least_words)
