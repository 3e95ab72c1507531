"""Best-fit packing planned on the histogram of lengths."""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window, functions as F

from txn_risk.llm.words import settle, texts

CAPACITY = 2048
# Parts of texts whose ids a Python worker remembers.
REMEMBERED = 1_000_000
# Bytes of text that are split at once; a longer text is split by itself.
CHUNK = 1 << 22
# New pieces that the library merges as one text, such texts in a call, and parts laid out at once.
JOINED, CALLED, LAID = 64, 64, 1 << 16
# Rows that one window may rank: fewer than this of one length stay together.
RANKED_TOGETHER = 20_000

# Fixed value: the splitting rule of the byte-level vocabulary.
_SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# What the rule leaves in one piece at sight.
_WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")

# Kinds of UTF-8 bytes, for places where the rule always begins a new piece.
_BLANK, _NEWLINE, _SIGN, _PLAIN, _LEAD, _REST, _SOLID = (1 << k for k in range(7))
_KIND = np.zeros(256, np.uint8)
_KIND[32] = _BLANK
_KIND[10] = _NEWLINE
_KIND[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = _SIGN
_KIND[[b for b in range(128) if chr(b).isalnum()]] = _PLAIN
_KIND[0xC3:0xC9] = _LEAD  # of a Latin letter, unless 0x97 or 0xB7 follows
_KIND[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = _REST
# First bytes of characters that are no white space.
_KIND[[b for b in [*range(33, 127), *range(0xC3, 0xF5)] if b not in (0xE1, 0xE2, 0xE3)]] |= _SOLID


def _cuts(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of ``data`` where the texts may be cut without any change of their ids.

    They are: a blank before something solid, a sign after a letter or digit, a single newline and what
    follows it. What is cut off ends as it would inside the text, for only white space looks ahead.
    """
    kind = _KIND[data]
    blank, newline, sign, solid = ((kind & k) != 0 for k in (_BLANK, _NEWLINE, _SIGN, _SOLID))
    word = (kind & _PLAIN) != 0  # the last byte of a letter or digit
    word[1:] |= ((kind[1:] & _REST) != 0) & ((kind[:-1] & _LEAD) != 0)
    cut = np.zeros(len(data), bool)
    cut[:-1] = blank[:-1] & solid[1:]
    filled = ends > begins
    cut[ends[filled] - 1] = False  # a blank that ends a text
    cut[1:] |= word[:-1] & sign[1:]
    word |= sign
    single = word[:-1] & newline[1:]
    cut[1:] |= single
    cut[2:] |= single[:-1] & solid[2:]
    cut[begins[filled]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of a byte-level BPE vocabulary, by its library.

    Ids of a text are the ids of its parts, cut where the vocabulary's splitting rule always begins a
    new piece. The parts of a chunk of texts are numbered, and the ids of each are remembered. A new part
    of Latin letters and signs is split by the rule itself; its new pieces go straight to the library's
    merges, many at a time. Other parts, and texts with a special string, are encoded as they are.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merger = Tokenizer(self.tokenizer.model)
        # Byte 255 is in no UTF-8, stands between pieces and is written as itself.
        self.merger.pre_tokenizer = pre_tokenizers.Split("\u00ff", "isolated")
        self.between = self.tokenizer.token_to_id("\u00ff")
        # The vocabulary writes each byte as a character: itself where it is printable, else the next
        # one from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.written = np.arange(256, dtype="<u4")
        self.written[others] = np.arange(256, 256 + len(others))
        self.known: dict[str, bytes] = {}

    def _whole(self, texts_: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts_, add_special_tokens=False)
        return [np.array(c.ids, "<u4").tobytes() for c in coded]

    def _merge(self, pieces_: list[str]) -> None:
        groups = [pieces_[at:at + JOINED] for at in range(0, len(pieces_), JOINED)]
        for at in range(0, len(groups), CALLED):  # the library's own results are large
            own = groups[at:at + CALLED]
            raw = [np.frombuffer(b"\xff".join(map(str.encode, g)), np.uint8) for g in own]
            written = [self.written[r].tobytes().decode("utf-32-le") for r in raw]
            for group, coded in zip(own, self.merger.encode_batch_fast(written), strict=True):
                ids = np.array(coded.ids, "<u4")
                cuts = [-4, *(4 * np.flatnonzero(ids == self.between)).tolist(), 4 * len(ids)]
                held = ids.tobytes()
                for piece, begin, to in zip(group, cuts[:-1], cuts[1:], strict=True):
                    self.known[piece] = held[begin + 4:to]

    def _learn(self, new: list[str]) -> None:
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        split, single, others = {}, [], []
        for part in new:
            if _WORD.fullmatch(part):
                single.append(part)
            elif max(part) < "\u0250":
                split[part] = _SPLIT.findall(part)
            else:
                others.append(part)
        single += [piece for own in split.values() for piece in own if piece not in self.known]
        self._merge(list(dict.fromkeys(single)))
        for part, own in split.items():
            self.known[part] = b"".join([self.known[piece] for piece in own])
        self.known.update(zip(others, self._whole(others), strict=True))

    def encode(self, texts_: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if not len(texts_):
            return []
        texts_ = texts_.cast(pa.large_binary())
        _, places, held = texts_.buffers()
        bounds = np.frombuffer(places, np.int64)[texts_.offset:][:len(texts_) + 1]
        if bounds[0] == bounds[-1]:
            return [b""] * len(texts_)
        data = np.frombuffer(held, np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        cuts = np.append(_cuts(data, bounds[:-1], bounds[1:]), len(data))
        numbered = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data))
        numbered = numbered.dictionary_encode()
        which = numbered.indices.to_numpy()
        parts = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        coded = list(map(self.known.get, parts))
        new = [k for k, ids in enumerate(coded) if ids is None]
        self._learn([parts[k] for k in new])
        for k in new:
            coded[k] = self.known[parts[k]]

        lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        starts = np.cumsum(lengths) - lengths
        table = np.frombuffer(b"".join(coded), "<u4")
        places = np.append(0, np.cumsum(lengths[which]))
        ids = np.empty(places[-1], "<u4")
        for at in range(0, len(which), LAID):
            own = which[at:at + LAID]
            begin, to = places[at], places[at + len(own)]
            shift = starts[own] - places[at:at + len(own)]
            ids[begin:to] = table[np.repeat(shift, lengths[own]) + np.arange(begin, to)]
        raw = ids.tobytes()
        ends = (4 * places[np.searchsorted(cuts, bounds)]).tolist()
        out = [raw[begin:to] for begin, to in zip(ends[:-1], ends[1:], strict=True)]
        for special in self.special:
            for k in np.flatnonzero(pc.match_substring(texts_, special).to_numpy(zero_copy_only=False)):
                out[k] = self._whole([texts_[k].as_py().decode()])[0]
        return out


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose texts have about CHUNK bytes."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
        yield batch.slice(at, to - at)
        at = to


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id",
    text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: each document's ids and an end id, cut
    into pieces of ``capacity`` of which only the first may be shorter."""
    source = texts(docs, id_col, text_col)
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            for part in _chunks(batch):
                which, number, start, length, crc, ids = [], [], [], [], [], []
                for k, coded in enumerate(encoder.encode(part.column(1))):
                    coded += end
                    total = len(coded) // 4
                    first = (total - 1) % capacity + 1
                    for n, to in enumerate(range(first, total + 1, capacity)):
                        begin = max(0, to - capacity) if n else 0
                        own = coded[4 * begin:4 * to]
                        which.append(k)
                        number.append(n)
                        start.append(begin)
                        length.append(to - begin)
                        crc.append(zlib.crc32(own))
                        if keep_ids:
                            ids.append(own)
                columns = [
                    part.column(0).take(pa.array(which, pa.int64())), pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(cut, (
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    ))


@dataclass
class Plan:
    """For each length, blocks of ranks: the items ``ranks[i]`` up to the next block's go to the
    sequences from ``sequences[i]`` on, one each, at ``offsets[i]``."""

    ranks: dict[int, list[int]] = field(default_factory=lambda: defaultdict(list))
    sequences: dict[int, list[int]] = field(default_factory=lambda: defaultdict(list))
    offsets: dict[int, list[int]] = field(default_factory=lambda: defaultdict(list))
    n_sequences: int = 0

    def put(self, length: int, rank: int, sequence: int, offset: int) -> None:
        self.ranks[length].append(rank)
        self.sequences[length].append(sequence)
        self.offsets[length].append(offset)


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-fit decreasing over counts: runs of equal sequences are filled together.

    Works on at most ``capacity`` lengths, whatever the number of documents.
    """
    plan = Plan()
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> runs (first, number)
    rooms: list[int] = []  # keys of ``room`` in use, rising

    def give(left: int, first: int, number: int) -> None:
        if left and number:
            if not room[left]:
                bisect.insort(rooms, left)
            room[left].append((first, number))

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        while todo:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                break
            left = rooms[i]
            first, number = room[left].pop()
            if not room[left]:
                rooms.pop(i)
            used = min(number, todo)
            plan.put(length, rank, first, capacity - left)
            give(left - length, first, used)
            give(left, first + used, number - used)
            todo, rank = todo - used, rank + used
        each = capacity // length
        for per, number in ((each, todo // each), (todo % each, 1)):
            if not per or not number:
                continue
            for k in range(per):
                plan.put(length, rank, plan.n_sequences, k * length)
                rank += number
            give(capacity - per * length, plan.n_sequences, number)
            plan.n_sequences += number
    return plan


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (``length`` at most ``capacity``).

    The histogram of lengths (at most ``capacity`` rows) reaches the driver and is planned there.
    Rows are ranked within their length; a frequent length is ranked in parts, whose counts give each
    part its first rank. Then every row finds its planned slot by its rank.
    """
    spark = cut.sparkSession
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = best_fit(counts, capacity)
    together = max(RANKED_TOGETHER, sum(counts.values()) // 4096)
    parts = [max(1, counts.get(n, 0) // together) for n in range(capacity + 1)]
    n_parts = F.get(F.expr(f"array({','.join(map(str, parts))})"), F.col("length").cast("int"))
    salted = cut.withColumn(
        "_part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), n_parts).cast("int")
    )
    sizes = salted.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most capacity + 4096 rows.
    first = sizes.select(
        "length", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first")
    )
    own = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(own) - 1).join(
        F.broadcast(first), ["length", "_part"]
    ).withColumn("_rank", F.col("_rank") + F.col("_first")).drop("_part", "_first")
    slots = spark.sparkContext.broadcast({
        n: tuple(np.asarray(x[n], np.int64) for x in (plan.ranks, plan.sequences, plan.offsets)) for n in counts
    })

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("_rank").to_numpy()
            sequence = np.empty(len(lengths), np.int64)
            offset = np.empty(len(lengths), np.int64)
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                starts, sequences, offsets = slots.value[int(n)]
                block = np.searchsorted(starts, ranks[at], side="right") - 1
                sequence[at] = sequences[block] + ranks[at] - starts[block]
                offset[at] = offsets[block]
            kept = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "_rank"]
    return ranked.mapInArrow(place, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset``.

    A null or empty text is its end id alone. Repeated rows are packed as often as they occur; a null
    id is carried on; an empty table gives no rows; other columns are ignored. With ``keep_ids`` the
    rows carry their ids (little-endian, 32 bits), ready to be written by sequence.
    """
    cut = settle(pieces(docs, vocabulary, capacity, 0, id_col, text_col, keep_ids), "pieces")
    return pack(cut, capacity)
