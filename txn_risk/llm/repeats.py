"""Removal of long repeated byte strings by threshold-bounded interval expansion.

Every window of LENGTH bytes has an anchor, the least hash of the ANCHOR-byte strings inside it; equal
windows have equal anchors at equal offsets. So documents are cut into runs of windows with one anchor,
runs of an anchor found once are done with, and the others meet by their anchor, wherever they come from.

What meets is judged on a Burrows-Wheeler transform: intervals of the suffix order are extended backwards
breadth first, one letter a level, and a boundary between two neighbours gets the level at which it is
first found as the length of their common prefix. Expansion stops at LENGTH; boundaries not found by then
lie between suffixes that share at least LENGTH bytes.

As values rise, a shorter length is passed on the way: one expansion tells strings of PASSAGE bytes and of
LENGTH that recur. Windows are then those of the shorter length, and a run carries the bytes that its windows
need to grow to the longer one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from txn_risk.llm.words import discard, of_keys, settle, text_key, texts, unused

LENGTH = 400
ANCHOR = 64
# Words from which on a repeated stretch is a passage, and the length of the strings it is made of: so many words of
# four letters with a blank each. A passage of shorter words has fewer bytes and is not seen.
PASSAGE_WORDS = 51
PASSAGE = PASSAGE_WORDS * 5
# Bytes of runs of one (anchor, block) group that a transform is built on; groups with more are dealt on.
TRANSFORM_BYTES = 2 << 20
# Bytes from which on groups are not gathered further: the arrays of a small transform stay in a core's cache.
GATHER_BYTES = 1 << 18
# Different runs of one anchor that stay together; more are dealt by the anchor's offset in the window, so many
# offsets together, and by the bytes that all windows of such a piece have.
RUNS_TOGETHER = 1_000
OFFSETS_TOGETHER = 16
# Windows looked at together in a long text.
CHUNK = 1 << 19
# An anchor with more than one part in so many of all runs is joined by broadcast: there are fewer than this.
HOT = 1_000

RUN_FIELDS = ("anchor", "start", "size", "at", "fit", "content")

_P = np.uint64(0x9E3779B97F4A7C15)
_P_BACK = np.uint64(pow(int(_P), -1, 1 << 64))
_Q = np.uint64(0xBF58476D1CE4E5B9)
_LOW = np.uint64((1 << 20) - 1)
# Letters that one number holds, and from which number on so many of its bytes are in use.
HEAD = 8
_HEAD_LIMITS = np.array([1 << 8 * i for i in range(HEAD)], np.uint64)
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        for base in (_P, _P_BACK):
            x = np.full(1 << 20, base, np.uint64)
            x[0] = 1
            _POWERS.append(np.cumprod(x))
    return _POWERS[0], _POWERS[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _Q
    return h ^ (h >> np.uint64(29))


def _window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all stretches of ``width`` values, from running minima of blocks both ways."""
    n = len(x)
    blocks = np.concatenate([x, np.full(-n % width, np.uint64(2**64 - 1))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def runs(raw: bytes, length: int = LENGTH, anchor: int = ANCHOR, reach: int = 0) -> dict[str, np.ndarray]:
    """Runs of windows with the same anchor at the same place.

    ``anchor`` its hash, ``start`` the first window, ``size`` their number, ``at`` the anchor's offset in
    the first window, ``fit`` how many of the windows have ``reach`` bytes up to the text's end, ``content`` a
    hash of all bytes of the run's windows, grown to ``reach`` where the text has them.
    """
    reach = max(length, reach)
    out: dict[str, list] = {k: [] for k in RUN_FIELDS}
    data = np.frombuffer(raw, np.uint8)
    power, back = _powers()
    for first in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[first:first + CHUNK + reach - 1].astype(np.uint64) + np.uint64(1)
        n, own = len(part), min(len(part), CHUNK + length - 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(part * power[:n])])
        h = _mixed((sums[anchor:own + 1] - sums[:own + 1 - anchor]) * back[:own - anchor + 1])
        # High bits of the hash, then the place: of equal hashes the leftmost is the least.
        least = _window_minima((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), length - anchor + 1)
        start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        size = np.diff(np.append(start, len(least)))
        place = (least[start] & _LOW).astype(np.int64)
        end = np.minimum(start + size + reach - 1, n)
        fit = np.clip(n - reach + 1 - start, 0, size)
        shape = (end - start + (size << 32)).astype(np.uint64)
        content = _mixed((sums[end] - sums[start]) * back[start] + shape)
        for k, v in zip(out, (h[place], start + first, size, place - start, fit, content), strict=True):
            out[k].append(v)
    return {k: np.concatenate(v).astype(np.int64, casting="unsafe") if v else np.zeros(0, np.int64) for k, v in out.items()}


def _heads(data: np.ndarray) -> np.ndarray:
    """The first HEAD letters of each rotation as a number."""
    key = data.astype(np.uint64)
    for step in (1, 2, 4):
        key = (key << np.uint64(8 * step)) | np.roll(key, -step)
    return key


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of ``data`` in the order of their first ``depth`` letters or more, ties by place."""
    n = len(data)
    key = _heads(data)
    order = np.argsort(key, kind="stable")
    sorted_, place, step = key[order], np.arange(n), HEAD
    first = np.append(True, sorted_[1:] != sorted_[:-1])
    # A rotation's rank is the place of the first that ties with it.
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, place, 0))
    tied = np.flatnonzero(~(first & np.append(first[1:], True)))
    while step < depth and len(tied):
        # Only rotations that still tie with a neighbour are sorted again.
        own = order[tied]
        pair = rank[own] * n + rank[(own + step) % n]
        again = np.argsort(pair, kind="stable")  # its keys are sorted by rank already
        own, pair = own[again], pair[again]
        order[tied] = own
        first = np.append(True, pair[1:] != pair[:-1])
        rank[own] = tied[np.maximum.accumulate(np.where(first, place[:len(tied)], 0))]
        tied = tied[~(first & np.append(first[1:], True))]
        step *= 2
    return order


def boundaries(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For neighbours in ``order`` (k - 1, k) the length of their common prefix, or -1 from ``length`` on.

    Backward extension of all intervals, level by level: an interval's boundary that has no value yet
    gets the level, and only then is the interval extended further. The first HEAD levels are read off the
    sorted heads.
    """
    n = len(data)
    heads = _heads(data)[order]
    known = HEAD - np.searchsorted(_HEAD_LIMITS, heads[1:] ^ heads[:-1], side="right")
    prefix = np.full(n + 1, -1, np.int32)
    prefix[1:n] = np.where(known < min(HEAD, length), known, -1)
    prefix[0] = prefix[n] = 0
    if length <= HEAD:
        return prefix[:n]
    low, high = (np.flatnonzero(prefix >= 0)[own] for own in (slice(-1), slice(1, None)))
    new = (prefix[high] == HEAD - 1) & (high < n)
    low, high = low[new], high[new]

    before = data[order - 1]
    by_letter = np.argsort(before, kind="stable")  # places sorted by (letter, place)
    occurrences = before[by_letter].astype(np.int64) * n + by_letter
    letters = np.unique(before).astype(np.int64)
    # Extending the suffix at a place backwards leads to ``to``; the next and the last place with the
    # same letter bound an interval of equal letters.
    to = np.empty(n, np.int64)
    to[by_letter] = np.arange(n)
    same = np.diff(before[by_letter]) == 0
    following, preceding = np.full(n, n, np.int32), np.full(n, -1, np.int32)
    following[by_letter[:-1][same]] = by_letter[1:][same]
    preceding[by_letter[1:][same]] = by_letter[:-1][same]
    # Where the stretch of one letter ends that each place is in.
    ends = np.append(np.flatnonzero(before[1:] != before[:-1]) + 1, n)
    one_letter = np.repeat(ends, np.diff(ends, prepend=0))

    for level in range(HEAD, length):
        if not len(low):
            break
        # Before an interval of one letter there is one interval, as wide.
        one = one_letter[low] >= high
        a = low[one]
        new_lows = [to[a]]
        new_highs = [new_lows[0] + (high[one] - a)]
        if len(a) < len(low):
            a, b = low[~one], high[~one]
            size = b - a
            wide = size > 2 * len(letters)
            if wide.any():
                # Before a wide interval try all letters; before a narrow one look at those that stand there.
                letter = np.tile(letters * n, np.count_nonzero(wide))
                new_lows.append(np.searchsorted(occurrences, letter + np.repeat(a[wide], len(letters))))
                new_highs.append(np.searchsorted(occurrences, letter + np.repeat(b[wide], len(letters))))
                a, b, size = a[~wide], b[~wide], size[~wide]
            past = np.cumsum(size)
            at = np.arange(past[-1] if len(past) else 0) + np.repeat(a - past + size, size)
            # Intervals of one level are disjoint and stay so: firsts and lasts pair up in order.
            new_lows.append(np.sort(to[at[preceding[at] < np.repeat(a, size)]]))
            new_highs.append(np.sort(to[at[following[at] >= np.repeat(b, size)]]) + 1)
        low, high = np.concatenate(new_lows), np.concatenate(new_highs)
        new = (low < high) & (prefix[high] < 0)
        low, high = low[new], high[new]
        prefix[high] = level
    return prefix[:n]


def repeated_windows(pieces: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each piece the stretches ``(first, end)`` of window starts that occur elsewhere in the pieces."""
    return repeated_lengths(pieces, (length,), [len(p) for p in pieces])[0]


def repeated_lengths(
    pieces: list[bytes], lengths: tuple[int, ...], starts_of: list[int]
) -> list[list[list[tuple[int, int]]]]:
    """For each length, and each piece, the stretches ``(first, end)`` of window starts that occur elsewhere.

    Only the first ``starts_of`` places of a piece are starts of windows; what follows them lets windows grow.
    One expansion, up to the longest length, serves all.
    """
    if not pieces:
        return [[] for _ in lengths]
    data = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    sizes = np.array([len(p) for p in pieces])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    left = np.repeat(starts + sizes, sizes + 1) - np.arange(len(data))  # bytes to the piece's end
    place = np.repeat(sizes, sizes + 1) - left
    order = suffix_order(data, max(lengths))
    prefix = boundaries(data, order, max(lengths))
    own = (place < np.repeat(starts_of, sizes + 1))[order]
    out = []
    for length in lengths:
        same = np.cumsum((prefix >= 0) & (prefix < length)) - 1  # neighbours that share at least ``length`` letters
        whole = own & (left[order] >= length)  # windows inside one piece
        often = np.bincount(same[whole], minlength=same[-1] + 1)
        mask = np.zeros(len(data) + 1, np.int8)
        mask[order[whole & (often[same] >= 2)]] = 1
        edge = np.diff(mask, prepend=np.int8(0))
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        owner = np.searchsorted(starts, first, side="right") - 1
        found: list[list[tuple[int, int]]] = [[] for _ in pieces]
        for k, a, b in zip(owner.tolist(), (first - starts[owner]).tolist(), (end - starts[owner]).tolist(), strict=True):
            found[k].append((a, b))
        out.append(found)
    return out


_PIECE = "anchor long, block long, content long, `from` int, starts int, bytes binary"
_NO_SPANS = "cast(array() as array<struct<start:long,end:long>>)"
_RUN = "struct<anchor:long,start:long,size:int,at:int,fit:int,content:long,again:array<long>>"


def _kinds_of_texts(owner: np.ndarray, flat: dict[str, np.ndarray]) -> tuple[np.ndarray, pa.ListArray]:
    """Which runs are the first of their kind in the text ``owner``, and the starts of the further ones of each.

    Where a text repeats a line over and over, a kind recurs with each line: it is one row all the same.
    """
    order = np.lexsort((flat["content"], flat["anchor"], owner))
    same = np.ones(max(0, len(order) - 1), bool)
    for column in (owner, flat["anchor"], flat["content"]):
        sorted_ = column[order]
        same &= sorted_[1:] == sorted_[:-1]
    new = np.append(True, ~same)[:len(order)]
    first = np.zeros(len(order), bool)
    first[order[new]] = True
    further = order[~new]
    leader = (np.cumsum(first) - 1)[order[new][(np.cumsum(new) - 1)[~new]]]
    ends = np.cumsum(np.append(0, np.bincount(leader, minlength=np.count_nonzero(first))))
    starts = flat["start"][further[np.argsort(leader, kind="stable")]]
    return first, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(starts, pa.int64()))


def _describe(docs: DataFrame, id_col: str, text_col: str, length: int, anchor: int, reach: int) -> DataFrame:
    source = texts(docs, id_col, text_col).select("doc_id", text_key(F.col("text")).alias("key"), "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                raw = [t.encode("utf-8", "surrogatepass") for t in part.column(2).to_pylist()]
                found = [runs(r, length, anchor, reach) for r in raw]
                flat = {k: np.concatenate([f[k] for f in found]) for k in RUN_FIELDS}
                owner = np.repeat(np.arange(len(found)), [len(f["start"]) for f in found])
                first, again = _kinds_of_texts(owner, flat)
                ends = np.cumsum(np.append(0, np.bincount(owner[first], minlength=len(found))))
                own = pa.StructArray.from_arrays(
                    [pa.array(v[first].astype(np.int32) if k in ("size", "at", "fit") else v[first]) for k, v in flat.items()]
                    + [again], names=[*flat, "again"],
                )
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([len(r) for r in raw], pa.int64()),
                    pa.array([len(r.split()) for r in raw], pa.int64()),
                    pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), own),
                ], names=["doc_id", "key", "n_bytes", "n_words", "sha256", "runs"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        read, f"doc_id {kind}, key binary, n_bytes long, n_words long, sha256 string, runs array<{_RUN}>"
    )


def _name(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), signed=True)


def _cut_runs(length: int, anchor: int, together: int = RUNS_TOGETHER, reach: int = 0):
    """From each text and its open runs, the bytes of the runs, dealt by anchor and, for an anchor with
    many runs, by its offset in the window and by what all windows of a piece have in common: windows
    of different offsets cannot be equal, nor can those of pieces that differ there."""
    offsets, reach = length - anchor + 1, max(length, reach)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("anchor", "block", "content", "from", "starts", "bytes")}
            for text, own in zip(batch.column("text"), batch.column("open"), strict=True):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                for run in own.as_py():
                    many = run["kinds"] > together
                    width = min(offsets, OFFSETS_TOGETHER) if many else offsets
                    i = 0
                    while i < run["size"]:
                        block = (run["at"] - i) // width
                        end = min(run["size"], run["at"] - block * width + 1)
                        place = run["start"] + i
                        piece = raw[place:run["start"] + end + reach - 1]
                        if many:
                            # From the block's last start to its first end, wherever the run begins or ends.
                            first = run["start"] + run["at"] - block * width
                            core = raw[first:first - width + 1 + length]
                            block = _name(block.to_bytes(4) + core)
                        for k, v in zip(rows, (run["anchor"], block, run["content"], i, end - i, piece), strict=True):
                            rows[k].append(v)
                        i = end
                        if len(rows["bytes"]) >= 2000:
                            yield _batch(rows)
                            rows = {k: [] for k in rows}
            if rows["bytes"]:
                yield _batch(rows)

    return read


def _single_windows(length: int, reach: int = 0):
    """Pieces as single windows, dealt by their bytes: where too many agree in what their windows share."""
    reach = max(length, reach)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                windows = [row["bytes"][j:j + reach] for j in range(row["starts"])]
                yield _batch({
                    "anchor": [row["anchor"]] * len(windows), "block": [_name(w[:length]) for w in windows],
                    "content": [row["content"]] * len(windows),
                    "from": list(range(row["from"], row["from"] + len(windows))),
                    "starts": [1] * len(windows), "bytes": windows,
                })

    return read


def _batch(rows: dict[str, list]) -> pa.RecordBatch:
    number, list_ = pa.int32(), pa.list_(pa.int32())
    kinds = {"bytes": pa.binary(), "windows": list_, "grown": list_, "from": number, "starts": number}
    return pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()})


def _judge(length: int, reach: int = 0):
    """Repeated windows of the runs of whole (anchor, block) groups, about GATHER_BYTES at a time.

    ``windows`` for ``length``, ``grown`` for ``reach``. Two copies of a piece are enough for a transform;
    further ones in the group are repeated as a whole.
    """
    reach, enough = max(length, reach), min(GATHER_BYTES, TRANSFORM_BYTES)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        copies: dict[tuple[bytes, int], int] = {}

        def flush() -> pa.RecordBatch:
            pieces = [x[-1] for x in held]
            if reach == length:
                found = grown = repeated_windows(pieces, length)
            else:
                found, grown = repeated_lengths(pieces, (length, reach), [x[-2] for x in held])
            rows: dict[str, list] = {"anchor": [], "content": [], "windows": [], "grown": []}
            for (name, content, first, *_), spans, wide in zip(held, found, grown, strict=True):
                if spans:
                    rows["anchor"].append(name)
                    rows["content"].append(content)
                    rows["windows"].append([first + x for span in spans for x in span])
                    rows["grown"].append([first + x for span in wide for x in span])
            return _batch(rows)

        for batch in batches:
            more: dict[str, list] = {"anchor": [], "content": [], "windows": [], "grown": []}
            for name, block, content, first, starts, piece in zip(
                *(batch.column(k).to_pylist() for k in ("anchor", "block", "content", "from", "starts", "bytes")),
                strict=True,
            ):
                if size >= enough and (name, block) != last:
                    yield flush()
                    held, size = [], 0
                if (name, block) != last:
                    copies = {}
                last = (name, block)
                copies[piece, starts] = copies.get((piece, starts), 0) + 1
                if copies[piece, starts] > 2:
                    fit = min(starts, len(piece) - reach + 1)
                    wide = [first, first + fit] if fit > 0 else []
                    for k, v in zip(more, (name, content, [first, first + starts], wide), strict=True):
                        more[k].append(v)
                    continue
                held.append((name, content, first, starts, piece))
                size += len(piece)
            if more["anchor"]:
                yield _batch(more)
        if held:
            yield flush()

    return read


def _of_anchors(rows: DataFrame, anchors: DataFrame, number: str, total: int) -> DataFrame:
    """``rows`` joined with ``anchors`` by anchor, where no anchor with many rows comes into one task.

    ``number`` says how many of the ``total`` rows an anchor has; of those with more than one in HOT there are
    fewer than HOT, so they are broadcast.
    """
    many = F.col(number) * HOT > total
    hot = anchors.where(many)
    few = rows.join(F.broadcast(hot.select("anchor")), "anchor", "left_anti")
    return few.join(anchors.where(~many), "anchor").unionByName(rows.join(F.broadcast(hot), "anchor"))


def _bytes_of(windows: str, length: int):
    """Pairs of first and end of windows in a text's runs of one kind as spans of the text's bytes."""
    pairs = F.flatten(F.transform(F.concat(F.array("start"), "again"), lambda start: F.transform(
        F.sequence(F.lit(0), F.size(windows) - 2, F.lit(2)),
        lambda i: F.struct(
            (start + F.get(windows, i)).alias("start"), (start + F.get(windows, i + 1) + length - 1).alias("end")
        ),
    )))
    return F.when(F.size(windows) > 0, pairs).otherwise(F.expr(_NO_SPANS))


def find(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text",
    reach: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)``: per row ``doc_id, key, n_bytes, n_words, sha256``; per distinct text in which a string
    of ``length`` bytes recurs ``key, copied, spans, grown``, with sorted ``start, end`` of the bytes covered by
    such strings, and by those of ``reach`` bytes (the same where ``reach`` is no more than ``length``).

    Equal strings of ``reach`` bytes begin with equal windows of ``length``, so they meet where those meet.
    """
    spark, reach = docs.sparkSession, max(length, reach)
    rows = settle(_describe(docs, id_col, text_col, length, anchor, reach), "runs")
    classes = settle(
        rows.where(F.col("n_bytes") >= length).groupBy("key").agg(
            (F.count(F.lit(1)) > 1).alias("copied"), F.first("n_bytes").alias("n_bytes"), F.first("runs").alias("runs")
        ).withColumn("rid", F.monotonically_increasing_id()), "run-classes",
    )
    entries = classes.select("rid", "copied", F.explode("runs").alias("run")).select("rid", "copied", "run.*")
    # A row is a text's runs of one kind, so joins by kind make no more rows than texts have kinds.
    runs_of = F.sum(F.size("again") + 1)
    met = settle(entries.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), runs_of.alias("met")).where(
        "met > 1"
    ).drop("met"), "met-anchors")
    number = met.agg(F.sum("n")).first()[0] or 0
    shared = settle(_of_anchors(entries, met, "n", number).drop("n"), "shared-runs")
    # Equal runs are one kind; a kind that occurs twice, or in a copied text, is repeated as a whole.
    kinds = settle(
        shared.groupBy("anchor", "content").agg(
            ((runs_of > 1) | F.max("copied")).alias("whole"),
            F.min(F.struct("rid", "start")).alias("source"), F.first("size").alias("size"), F.first("at").alias("at"),
            F.first("fit").alias("fit"),
        ), "run-kinds",
    )
    sizes = settle(kinds.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"), F.min("whole").alias("settled")
    ).where("kinds > 1 and not settled").select("anchor", "kinds"), "open-anchors")
    number, most = sizes.agg(F.sum("kinds"), F.max("kinds")).first()
    open_ = _of_anchors(kinds, sizes, "kinds", number or 0)
    # No more than a text has bytes.
    by_text = open_.groupBy(F.col("source.rid").alias("rid")).agg(F.collect_list(F.struct(
        "anchor", F.col("source.start").alias("start"), "size", "at", "content", "kinds"
    )).alias("open"))
    asked = classes.select("rid", "key").join(by_text, "rid").select("key", "open")
    source = texts(docs, id_col, text_col).select(text_key(F.col("text")).alias("key"), "text")
    # One row of each asked text: copies agree, so any will do.
    cut = of_keys(source, asked).join(asked, "key").dropDuplicates(["key"]).select("text", "open").mapInArrow(
        _cut_runs(length, anchor, RUNS_TOGETHER, reach), _PIECE
    )
    pieces = None
    if (most or 0) > RUNS_TOGETHER:
        cut = pieces = settle(cut, "cut-runs")
        large = cut.groupBy("anchor", "block").agg(F.sum(F.octet_length("bytes")).alias("b")).where(
            F.col("b") > TRANSFORM_BYTES
        ).select("anchor", "block")
        cut = cut.join(large, ["anchor", "block"], "left_anti").unionByName(
            cut.join(large, ["anchor", "block"], "left_semi").mapInArrow(_single_windows(length, reach), _PIECE)
        )
    total = open_.agg(F.sum(F.col("size") + reach)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (4 * TRANSFORM_BYTES)))
    judged = settle(
        cut.repartition(parts, "anchor", "block").sortWithinPartitions("anchor", "block").mapInArrow(
            _judge(length, reach), "anchor long, content long, windows array<int>, grown array<int>"
        ), "judged-runs",
    )
    # Windows (in pairs of first and end) by kind of run, put back to every text with runs of that kind.
    whole = kinds.where("whole").select(
        "anchor", "content", F.array(F.lit(0), "size").alias("windows"),
        F.when(F.col("fit") > 0, F.array(F.lit(0), "fit")).otherwise(F.expr("cast(array() as array<int>)")).alias("grown"),
    )
    found = judged.join(whole.select("anchor", "content"), ["anchor", "content"], "left_anti").unionByName(whole)
    hit = shared.where(~F.col("copied")).select("anchor", "content", "rid", "start", "again").join(
        found, ["anchor", "content"]
    ).select("rid", _bytes_of("windows", length).alias("spans"), _bytes_of("grown", reach).alias("grown"))
    merged = hit.groupBy("rid").agg(*[
        F.array_sort(F.flatten(F.collect_list(c))).alias(c) for c in ("spans", "grown")
    ])
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    spans = classes.where(~F.col("copied")).select("rid", "key").join(merged, "rid").select(
        "key", F.lit(False).alias("copied"), "spans", "grown"
    ).unionByName(classes.where("copied").select(
        "key", F.lit(True).alias("copied"), all_of_it.alias("spans"),
        F.when(F.col("n_bytes") >= reach, all_of_it).otherwise(F.expr(_NO_SPANS)).alias("grown"),
    ))
    spans = settle(spans, "removed-spans")
    discard(met, shared, kinds, sizes, judged, classes, *([pieces] if pieces is not None else []))
    return rows.drop("runs"), spans


def disjoint(spans: list[dict]) -> list[tuple[int, int]]:
    """Sorted spans with those that touch or overlap put together."""
    out: list[tuple[int, int]] = []
    for span in spans:
        if out and span["start"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], span["end"]))
        else:
            out.append((span["start"], span["end"]))
    return out


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for start, end in spans:
        kept.append(raw[at:start])
        at = end
    return b"".join([*kept, raw[at:]])


def passages(raw: bytes, stretches: list[tuple[int, int]], words: int = PASSAGE_WORDS) -> list[tuple[int, int]]:
    """The stretches of ``raw`` in which at least ``words`` words (parts between ASCII white space) lie whole."""
    out = []
    for start, end in stretches:
        number = len(raw[start:end].split())
        for at in (start, end):  # a word across an edge does not count
            number -= 0 < at < len(raw) and not (raw[at - 1:at].isspace() or raw[at:at + 1].isspace())
        if number >= words:
            out.append((start, end))
    return out


def removed(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text",
    passage: int = 0,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    A byte goes when a string of ``length`` bytes that covers it also starts anywhere else, in the same
    text or another, overlaps included; all strings are judged on the input. Texts are UTF-8 bytes, a null
    one has none; nothing shorter than ``length`` is touched. Repeated rows are copies of each other. A null
    id is carried on; an empty table gives no rows; other columns are ignored.

    With ``passage`` (bytes, at most ``length``) two columns more, ``n_passages, n_passage_bytes``: the maximal
    stretches covered by strings of so many bytes that start anywhere else, in which PASSAGE_WORDS words lie
    whole, and their bytes. They change none of the other columns; both come from one expansion.

    Nothing is missed; equality of whole runs rests on 128 bits of hash.
    """
    rows, spans = find(docs, passage or length, anchor, id_col, text_col, length)
    source = texts(docs, id_col, text_col).select(text_key(F.col("text")).alias("key"), "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                near, own = ([disjoint(x) for x in part.column(i).to_pylist()] for i in (2, 3))
                raw = [t.encode("utf-8", "surrogatepass") for t in part.column(1).to_pylist()]
                near = [passages(r, x) for r, x in zip(raw, near, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([sum(b - a for a, b in x) for x in own], pa.int64()),
                    pa.array([len(x) for x in own], pa.int64()),
                    pa.array([hashlib.sha256(kept_bytes(r, x)).hexdigest() for r, x in zip(raw, own, strict=True)]),
                    pa.array([len(x) for x in near], pa.int64()),
                    pa.array([sum(b - a for a, b in x) for x in near], pa.int64()),
                ], names=["key", "n_removed", "n_spans", "kept", "n_passages", "n_passage_bytes"])

    partly = spans.where(~F.col("copied")).select("key", "spans", "grown")
    parted = of_keys(source, partly).join(partly, "key").mapInArrow(
        read, "key binary, n_removed long, n_spans long, kept string, n_passages long, n_passage_bytes long"
    )
    # Copies need no text: all of it is one span, and one passage if it has the words.
    copied, nothing = F.col("_copied"), F.lit(0).cast("long")
    gone = copied & (F.col("n_bytes") >= length)
    read_over = copied & (F.col("n_words") >= PASSAGE_WORDS)
    joined = rows.join(
        parted.withColumn("_copied", F.lit(False)).unionByName(
            spans.where("copied").select("key", F.lit(True).alias("_copied")), allowMissingColumns=True
        ), "key", "left",
    )
    out = joined.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", nothing)).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", nothing)).alias("n_spans"),
        F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept", "sha256")).alias("kept_sha256"),
        F.when(read_over, F.lit(1).cast("long")).otherwise(F.coalesce("n_passages", nothing)).alias("n_passages"),
        F.when(read_over, F.col("n_bytes")).otherwise(F.coalesce("n_passage_bytes", nothing)).alias("n_passage_bytes"),
    )
    return out if passage else out.drop("n_passages", "n_passage_bytes")


def without_repeats(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text",
    passage: int = 0,
) -> DataFrame:
    """``docs`` with the repeated bytes taken out of their texts; all rows and columns stay.

    With ``passage`` the repeated stretches that :func:`removed` calls passages go as well. Bytes of a
    character of which a part was taken out go too. Null texts stay null."""
    _, spans = find(docs, passage or length, anchor, id_col, text_col, length)
    key, cuts, wide = unused(docs, "_key"), unused(docs, "_spans"), unused(docs, "_grown")
    keyed = docs.withColumn(key, text_key(F.coalesce(docs[text_col].cast("string"), F.lit(""))))
    own = spans.select(F.col("key").alias(key), F.col("spans").alias(cuts), F.col("grown").alias(wide))

    def cut_out(text: str, near: list[dict], grown: list[dict]) -> str:
        raw = text.encode("utf-8", "surrogatepass")
        read_over = passages(raw, disjoint(near)) if passage else []
        both = sorted(read_over + disjoint(grown))
        return kept_bytes(raw, disjoint([{"start": a, "end": b} for a, b in both])).decode("utf-8", "ignore")

    def take(column: pa.Array, near: pa.Array, grown: pa.Array) -> pa.Array:
        return pa.array([
            text if text is None or x is None else cut_out(text, x, y)
            for text, x, y in zip(column.to_pylist(), near.to_pylist(), grown.to_pylist(), strict=True)
        ], pa.string())

    cut = F.arrow_udf(take, T.StringType())
    joined = keyed.join(own, key, "left").withColumn(text_col, cut(F.col(text_col), F.col(cuts), F.col(wide)))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
