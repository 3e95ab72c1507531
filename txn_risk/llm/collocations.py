"""Phrases whose words belong together, counted on a prefix-free parse of the texts.

Texts are cut where their own content says so: wherever the hash of three words in a row is a trigger. A
chunk reaches from one trigger to the next and repeats its three words, so that every phrase of up to four
words lies whole in the chunk where it starts. Equal stretches of text give equal chunks; the distinct ones
form a dictionary with the number of times each was parsed. Phrases are counted once per distinct chunk,
weighted by that number, and a phrase that starts in the repeated words is left to the next chunk.

A phrase can only be frequent if both its shorter parts are. So phrases of two words are counted by a hash
first, those of three only where both pairs can be frequent, and so on; the hashes that reach the threshold
go around as a bitmap, which may let a phrase pass in vain and never holds one back. What passes is counted
by its words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from txn_risk.llm.words import discard, settle, unused

LONGEST = 4
# Words that two chunks share: a phrase that starts before them ends within them.
OVERLAP = LONGEST - 1
# One in so many places is a trigger, and no chunk is longer than STRETCH words and the overlap.
TRIGGER = 16
STRETCH = 64
# Bytes handled at once; a longer text is handled in parts that overlap like chunks.
BYTES = 1 << 20
# Rows of counted phrases that a task holds at most before they leave it.
GATHER_ROWS = 1 << 19
# Bits of the bitmap for each frequent phrase, and bits of the largest one (64 MB).
BITS_EACH = 64
MOST_BITS = 1 << 29

# Fixed by the contract: what ends a piece, and what parts its words.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
# Lower-cases A-Z; makes every end a line feed and every blank a space.
_PLAIN = bytes(
    10 if b in ENDS else 32 if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = pow(int(_BASE), -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


# So many powers are kept, of those of the base and of its inverse: as many as parts of texts have bytes.
KEPT_POWERS = 1 << 21


@cache
def _kept(base: int) -> np.ndarray:
    return _powers(base, KEPT_POWERS)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _STEP
    x ^= x >> np.uint64(29)
    x = x * _BASE
    return x ^ (x >> np.uint64(32))


def _power(base: int, at: np.ndarray | slice) -> np.ndarray:
    """``base ** at`` modulo 2 ** 64 for rising ``at``; what lies beyond the kept powers by two steps."""
    table = _kept(base)
    if isinstance(at, slice):
        if at.stop <= len(table):
            return table[at]
        at = np.arange(at.stop)
    if not len(at) or at[-1] < len(table):
        return table[at]
    steps = _powers(pow(base, len(table), 1 << 64), int(at[-1]) // len(table) + 1)
    return table[at % len(table)] * steps[at // len(table)]


class Words:
    """The words of a buffer of plain bytes (words, single spaces and line feeds): where each starts and
    ends, and a hash of each."""

    def __init__(self, data: np.ndarray):
        solid = np.zeros(len(data) + 2, bool)
        np.not_equal(data, 32, out=solid[1:-1])
        solid[1:-1] &= data != 10
        edge = np.flatnonzero(solid[1:] != solid[:-1])
        self.starts, self.ends = edge[::2].copy(), edge[1::2].copy()
        sums = np.zeros(len(data) + 1, np.uint64)
        codes = np.add(data, 1, dtype=np.uint64)
        codes *= _power(int(_BASE), slice(len(data)))
        np.cumsum(codes, out=sums[1:])
        own = (sums[self.ends] - sums[self.starts]) * _power(_INVERSE, self.starts)
        self.hashes = _mixed(own + (self.ends - self.starts).astype(np.uint64) * _STEP)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.StringArray:
    """The stretches ``data[starts[i]:ends[i]]`` as strings."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    take = np.arange(offsets[-1], dtype=np.int64) + np.repeat(starts - offsets[:-1], sizes)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data[take]))


def _parts(raw: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """A text of plain bytes in parts of about ``size``, each with the number of words at its end that the
    next part begins with. A part ends with a piece if one ends near, else after ``OVERLAP`` further words."""
    while len(raw) > size:
        end = raw.rfind(b"\n", size // 2, size)
        if end >= 0:
            yield raw[:end], 0
            raw = raw[end + 1:]
            continue
        cut = raw.find(b" ", size)
        stop = raw.find(b"\n", size)
        if cut < 0 and stop < 0:
            break
        if cut < 0 or 0 <= stop < cut:
            yield raw[:stop], 0
            raw = raw[stop + 1:]
            continue
        reach, tail = cut, 0
        while tail < OVERLAP:
            begin = reach
            while begin < len(raw) and raw[begin] == 32:
                begin += 1
            if begin == len(raw) or raw[begin] == 10:
                break
            ends = [x for x in (raw.find(b" ", begin), raw.find(b"\n", begin)) if x >= 0]
            reach = min(ends, default=len(raw))
            tail += 1
        yield raw[:reach], tail
        raw = raw[cut:]
    yield raw, 0


def _chunks(buffer: bytes, texts: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, pa.StringArray, np.ndarray]:
    """Chunks of texts joined by line feeds: the number of each chunk's text, its words, and how many at its
    end belong to the next chunk. ``texts`` says where each text starts, ``tails`` how many words at its end
    the next part repeats."""
    data = np.frombuffer(buffer, np.uint8)
    words = Words(data)
    n = len(words.starts)
    if not n:
        return np.empty(0, np.int64), pa.array([], pa.string()), np.empty(0, np.int32)
    piece = np.cumsum(data == 10)[words.starts]
    place = np.arange(n)
    first = np.diff(piece, prepend=-1) != 0
    # Word numbers at which the piece of each word begins and ends.
    begins = np.flatnonzero(first)
    number = np.cumsum(first) - 1
    stops = np.append(begins[1:], n)[number]
    ahead = np.append(words.hashes, np.zeros(OVERLAP, np.uint64))
    window = reduce(lambda sum_, k: sum_ * _BASE + ahead[k:k + n], range(OVERLAP), np.zeros(n, np.uint64))
    whole = place + OVERLAP <= stops
    cut = first | (whole & (_mixed(window) % np.uint64(TRIGGER) == 0))
    since = place - np.maximum.accumulate(np.where(cut, place, 0))
    cut |= whole & (since % STRETCH == 0)

    at = np.flatnonzero(cut)
    following = np.append(at[1:], n)
    ends_piece = following == stops[at]
    last = np.where(ends_piece, stops[at], following + OVERLAP)
    of_text = np.searchsorted(texts, words.starts[at], side="right") - 1
    # The last chunk of a part keeps for the next part what that one repeats; a chunk before it may hold
    # some of those words only as its own overlap.
    ends_text = np.append(of_text[1:] != of_text[:-1], True)
    tail = np.where(ends_piece, np.where(ends_text, tails[of_text], 0), OVERLAP)

    # Words are parted by one space each; a chunk is one stretch of these.
    solid = (data != 32) & (data != 10)
    kept = solid.copy()
    kept[1:] |= solid[:-1]
    packed = np.where(solid, data, 32)[kept].astype(np.uint8)
    moved = np.cumsum(kept) - 1
    return of_text, _joined(packed, moved[words.starts[at]], moved[words.ends[last - 1] - 1] + 1), tail


def parse(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = BYTES) -> DataFrame:
    """The dictionary: ``(lang, chunk, tail, times)``, distinct chunks of each language.

    A chunk is its words, parted by spaces; the last ``tail`` of them start the next chunk as well.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[bytes] = []
            own: list[int] = []
            tails: list[int] = []

            def made() -> pa.RecordBatch:
                starts = np.cumsum([0, *(len(t) + 1 for t in held[:-1])])
                of_text, chunk, tail = _chunks(b"\n".join(held), starts, np.asarray(tails))
                lang = batch.column("lang").take(pa.array(np.asarray(own, np.int64)[of_text]))
                held.clear(), own.clear(), tails.clear()
                return pa.RecordBatch.from_arrays(
                    [lang, chunk, pa.array(tail, pa.int32())], names=["lang", "chunk", "tail"]
                )

            room = size
            for k, raw in enumerate(batch.column("text").to_pylist()):
                for part, tail in _parts(raw.translate(_PLAIN), size):
                    if held and len(part) > room:
                        yield made()
                        room = size
                    held.append(part)
                    own.append(k)
                    tails.append(tail)
                    room -= len(part) + 1
            if held:
                yield made()

    source = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    return source.mapInArrow(cut, "lang string, chunk string, tail int").groupBy("lang", "chunk", "tail").agg(
        F.count(F.lit(1)).alias("times")
    )


class Bitmap:
    """Which hashes may be frequent."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.mask = np.uint64(8 * len(bits) - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & self.mask
        return (self.bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _bitmap(spark: SparkSession, hashes: DataFrame) -> Bitmap:
    """A bitmap of ``hashes(h)``, between 128 kB and 64 MB whatever their number."""
    wanted = max(1 << 20, hashes.count() * BITS_EACH)
    bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())
    slot = F.col("h").bitwiseAND(F.lit(bits - 1)) + 1  # buckets and positions count from one
    pieces = hashes.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    out = np.zeros(bits // 8, np.uint8)
    for row in pieces.collect():
        at = (row.bucket - 1) * len(row.bits)
        out[at:at + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return Bitmap(out)


class Grams:
    """The phrases that start in some chunks before their tails, by hash."""

    def __init__(self, chunk: pa.StringArray, tail: np.ndarray, seed: np.ndarray):
        offsets = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
        raw = chunk.buffers()[2]
        held = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw else np.empty(0, np.uint8)
        # A line feed after each chunk.
        self.data = np.insert(held, offsets[1:] - offsets[0], 10)
        self.words = Words(self.data)
        starts = offsets[:-1] - offsets[0] + np.arange(len(chunk))
        first = np.searchsorted(self.words.starts, starts)
        following = np.append(first[1:], len(self.words.starts))
        number = following - first
        self.chunk = np.repeat(np.arange(len(chunk)), number)
        self.last = np.repeat(following, number)
        self.own = np.arange(len(self.chunk)) < np.repeat(following - tail, number)
        self.seed = np.repeat(seed, number)
        self._hashes: dict[int, np.ndarray] = {}

    def hashes(self, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each word on, where the chunk has them."""
        if k not in self._hashes:
            n = len(self.chunk)
            ahead = np.append(self.words.hashes, np.zeros(k, np.uint64))
            sum_ = reduce(lambda s, i: s * _STEP + ahead[i:i + n], range(k), self.seed)
            self._hashes[k] = _mixed(sum_)
        return self._hashes[k]

    def possible(self, k: int, shorter: Bitmap | None) -> np.ndarray:
        """Where a phrase of ``k`` words starts, both of whose shorter parts may be frequent."""
        at = np.flatnonzero(self.own & (np.arange(len(self.chunk)) + k <= self.last))
        if shorter is not None:
            parts = self.hashes(k - 1)
            at = at[shorter.holds(parts[at])]
            at = at[shorter.holds(parts[at + 1])]
        return at

    def texts(self, at: np.ndarray, k: int) -> pa.StringArray:
        return _joined(self.data, self.words.starts[at], self.words.ends[at + k - 1])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Grams, pa.RecordBatch]]:
    """Batches of the dictionary in slices of about ``BYTES``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(np.diff(np.frombuffer(batch.column("chunk").buffers()[1], np.int32)[
            batch.column("chunk").offset:batch.column("chunk").offset + batch.num_rows + 1
        ]))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BYTES)))
            part = batch.slice(at, to - at)
            lang = part.column("lang").dictionary_encode()
            names = np.asarray([hash_name(x) for x in lang.dictionary.to_pylist()], np.uint64)
            seed = names[lang.indices.to_numpy()]
            yield Grams(part.column("chunk"), part.column("tail").to_numpy(), seed), part
            at = to


def hash_name(lang: str) -> int:
    raw = np.frombuffer(lang.encode() + b"\n", np.uint8).astype(np.uint64)
    return int(_mixed(np.asarray([(raw * _powers(int(_BASE), len(raw))).sum()], np.uint64))[0])


def _summed(rows: pa.Table, keys: list[str]) -> pa.Table:
    return rows.group_by(keys).aggregate([("times", "sum")]).rename_columns([*keys, "times"])


def _gathered(parts: Iterable[pa.Table], keys: list[str], most: int = GATHER_ROWS) -> Iterator[pa.RecordBatch]:
    """The sums of ``times`` by ``keys``, those of many parts together; at most about ``most`` rows are held."""
    held: list[pa.Table] = []
    for part in parts:
        held.append(_summed(part, keys))
        if sum(t.num_rows for t in held) < most:
            continue
        held = [_summed(pa.concat_tables(held), keys)]
        if 2 * held[0].num_rows > most:  # few of them met
            yield from held.pop().combine_chunks().to_batches(1 << 16)
    if held:
        yield from _summed(pa.concat_tables(held), keys).combine_chunks().to_batches(1 << 16)


def frequent_hashes(dictionary: DataFrame, k: int, least: int, shorter) -> DataFrame:
    """``(h)``: hashes of the phrases of ``k`` words that may occur ``least`` times."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams, part in _grams(batches):
            at = grams.possible(k, shorter.value)
            if not len(at):
                continue
            h = grams.hashes(k)[at].view(np.int64)
            order = np.argsort(h)
            h = h[order]
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            times = np.add.reduceat(part.column("times").to_numpy()[grams.chunk[at[order]]], first)
            yield pa.RecordBatch.from_arrays([pa.array(h[first]), pa.array(times)], names=["h", "times"])

    counts = dictionary.mapInArrow(hashed, "h long, times long").groupBy("h").agg(F.sum("times").alias("f"))
    return counts.where(F.col("f") >= least).select("h")


def phrases(dictionary: DataFrame, ks: list[int], maps: dict, least: int) -> DataFrame:
    """``(lang, phrase, k, f, h)``: phrases of ``ks`` words that occur ``least`` times, with their number.

    ``maps`` has the bitmap of each ``k``; without one every phrase of that length is counted.
    """
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for grams, part in _grams(batches):
            for k in ks:
                at = grams.possible(k, None)
                if k in maps:
                    at = at[maps[k].value.holds(grams.hashes(k)[at])]
                if not len(at):
                    continue
                of = grams.chunk[at]
                yield pa.table({
                    "lang": part.column("lang").take(pa.array(of)), "phrase": grams.texts(at, k),
                    "k": pa.array(np.full(len(at), k, np.int32)), "h": grams.hashes(k)[at].view(np.int64),
                    "times": part.column("times").to_numpy()[of],
                })

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(found(batches), ["lang", "phrase", "k", "h"])

    kind = "lang string, phrase string, k int, h long, times long"
    counted = dictionary.mapInArrow(written, kind).groupBy("lang", "phrase").agg(
        F.sum("times").alias("f"), F.max("k").alias("k"), F.max("h").alias("h")
    )
    return counted if least is None else counted.where(F.col("f") >= least)


def _words(phrase: str) -> Column:
    return F.split(F.col(phrase), " ")


def _candidates(frequent: DataFrame, share: int) -> DataFrame:
    """Phrases of two words or more that no longer one with ``share`` percent of their occurrences holds."""
    longer = frequent.where("k > 2")
    inside = longer.select("lang", "f", F.explode(F.expr(
        "flatten(transform(sequence(2, k - 1), size -> transform(sequence(1, k - size + 1), "
        "at -> array_join(slice(split(phrase, ' '), at, size), ' '))))"
    )).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("f_longer"))
    return frequent.where("k > 1").join(inside, ["lang", "phrase"], "left").where(
        F.col("f_longer").isNull() | (F.col("f_longer").cast("decimal(38,0)") * 100 < F.col("f").cast("decimal(38,0)") * share)
    ).select("lang", "phrase", "k", F.col("f").alias("a"))


def _scored(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each candidate: ``lang, phrase, a, l, r, score``."""
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice(_words("phrase"), F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice(_words("phrase"), F.col("cut") + 1, F.col("k")), " ").alias("right"),
    )
    # Parts of a frequent phrase are as frequent at least.
    known = frequent.select("lang", "phrase", "f")
    both = cuts.join(known.withColumnsRenamed({"phrase": "left", "f": "l"}), ["lang", "left"]).join(
        known.withColumnsRenamed({"phrase": "right", "f": "r"}), ["lang", "right"]
    )
    # Decimals of 38 digits hold the products exactly; div drops the fraction.
    score = F.expr(
        "(cast(2000000 as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    )
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("lowest")
    return both.groupBy("lang", "phrase", "a").agg(lowest).select(
        "lang", "phrase", "a", "lowest.l", "lowest.r", "lowest.score"
    )


def collocations(
    docs: DataFrame, least: int = 30, share: int = 80, top: int = 2000, lang_col: str = "lang",
    text_col: str = "text", size: int = BYTES,
) -> DataFrame:
    """Each language's ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    Texts, A-Z lower-cased, are split into pieces and words; a phrase is two to four words of a piece that
    occur ``least`` times in the language (``a``). ``n`` counts the language's words. A cut gives ``l`` and
    ``r``, the occurrences of both sides, and the score floor(2000000 a / (l + r)); the lowest counts, ties
    to the earliest cut. A phrase inside a longer one with ``share`` percent of its occurrences is left out.
    Ties of the order go by ``a``, then by the phrase's bytes.

    A null language is ``und``; null and empty texts have no words; rows that recur count as often as they
    occur; an empty table gives no rows; other columns are ignored. Texts are shuffled once, as chunks, of
    which equal ones meet on their way; then only hashes of phrases and frequent phrases are. The bitmaps
    sent to the tasks have a fixed largest size; beyond it they hold back less.
    """
    spark = docs.sparkSession
    dictionary = settle(parse(docs, lang_col, text_col, size), "phrase-dictionary")
    words = settle(phrases(dictionary, [1], {}, None), "words")
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent_words = words.where(F.col("f") >= least)
    maps, shorter = {}, spark.sparkContext.broadcast(_bitmap(spark, frequent_words.select("h")))
    for k in range(2, LONGEST + 1):
        hashes = settle(frequent_hashes(dictionary, k, least, shorter), "frequent-hashes")
        maps[k] = shorter = spark.sparkContext.broadcast(_bitmap(spark, hashes))
        discard(hashes)
    frequent = settle(
        frequent_words.unionByName(phrases(dictionary, [*maps], maps, least)).select("lang", "phrase", "k", "f"),
        "frequent-phrases",
    )
    discard(dictionary)
    scored = _scored(_candidates(frequent, share), frequent)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # First among a share of a language's phrases, so that no task holds all of a language.
    part = unused(scored, "_part")
    shared = Window.partitionBy("lang", part).orderBy(*order)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    best = scored.withColumn(part, F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn(
        "rank", F.row_number().over(shared)
    ).where(F.col("rank") <= top).withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(n, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
