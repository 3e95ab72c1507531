"""Spelling variants: words one edit apart, found on sorted permuterm rotations.

A word is closed by a mark and turned around: each of its rotations is filed under itself, and, without its
last character, under the rest. Words filed under one rest agree in all but the character left out, which
stands in the same place of each: they are one replacement apart, and one deletion away from a word whose
whole rotation is that rest. So sorting brings neighbours together, and a group holds one word per
character of the alphabet at most, and one whole rotation.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txn_risk.llm.words import discard, settle, texts

# Fixed by the contract: words are runs of A-Z, a-z and U+00C0 to U+00FF. In Latin-1 those are one byte
# each; everything else becomes a blank, characters beyond Latin-1 by way of a question mark.
_LETTERS = bytes(range(97, 123)) + bytes(range(0xC0, 0x100))
_RUNS = bytes(
    b + 32 if 65 <= b <= 90 else b if b in _LETTERS else 32 for b in range(256)
)
# Closes a word; it sorts before every letter and is none.
MARK = "$"
# Distinct words that a task counts before it hands the counts on.
COUNTED = 200_000


def misspelt(run: bytes, doc: int, rate: int) -> bytes:
    """``run`` (Latin-1) without the character that the rule of the contract deletes, if it deletes one.

    ``doc`` is the crc32 of what stands before the run in ``<doc_id>:<run>``.
    """
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), doc)
    if h % rate:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(
    docs: DataFrame, least_length: int = 6, rate: int = 199, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(word, n)``: every word of ``least_length`` characters or more with its number of occurrences.

    A null text has no words, a null id counts as the empty string.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in total]
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
            )
            total.clear()
            return out

        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist(), strict=True):
                doc = zlib.crc32(f"{name}:".encode())
                runs = Counter(
                    r for r in text.encode("latin-1", "replace").translate(_RUNS).split() if len(r) >= least_length
                )
                for run, n in runs.items():
                    word = misspelt(run, doc, rate)
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield flush()
        if total:
            yield flush()

    named = texts(docs, id_col, text_col).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), "text"
    )
    return named.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def filed_rotations(words: DataFrame) -> DataFrame:
    """``(rest, left_out, word, n)``: every rotation under itself, and under itself without its last letter."""
    closed = F.concat(F.col("word"), F.lit(MARK))
    turned = F.transform(
        F.sequence(F.lit(1), F.length("word") + 1),
        lambda i: F.concat(F.substring(closed, i, F.length(closed)), F.substring(closed, F.lit(1), i - 1)),
    )
    rotation = F.col("rotation")
    last = F.right(rotation, F.lit(1))
    entries = F.array(
        F.struct(rotation.alias("rest"), F.lit(None).cast("string").alias("left_out")),
        F.struct(F.left(rotation, F.length(rotation) - 1).alias("rest"), last.alias("left_out")),
    )
    filed = words.select("word", "n", F.explode(turned).alias("rotation")).select(
        "word", "n", F.explode(F.when(last == MARK, F.slice(entries, 1, 1)).otherwise(entries)).alias("entry")
    )
    return filed.select("entry.rest", "entry.left_out", "word", "n")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of each word within its groups; rows come sorted by ``rest``.

    Per group and word one row ``(word, n_near, near_n, near)``: how many neighbours it has there, and the
    most frequent of them (ties: the smallest).
    """
    out: list[tuple[str, int, int, str]] = []
    group: list[tuple[str | None, str, int]] = []
    rest: str | None = None

    def best(members: list[tuple[str | None, str, int]]) -> list[tuple[int, str]]:
        """The two most frequent, so that whichever word asks, another one is among them."""
        return sorted((-n, word) for _, word, n in members)[:2]

    def close() -> None:
        if len(group) < 2:
            return
        whole = [m for m in group if m[0] is None]
        replaced = [m for m in group if m[0] is not None]
        # Of equal letters in a row any may be deleted, with the same result: the first stands for them.
        longer = [m for m in replaced if m[0] != rest[-1]]
        for members, others in (
            (replaced, replaced), (whole, longer), (longer, whole),
        ):
            top = best(others)
            for _, word, _ in members:
                n_near = len(others) - (others is replaced)
                if n_near:
                    near = next(x for x in top if x[1] != word)
                    out.append((word, n_near, -near[0], near[1]))

    def made() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "n_near", "near_n", "near"]
        )
        out.clear()
        return batch

    for batch in batches:
        for key, *member in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != rest:
                close()
                group, rest = [], key
            group.append(tuple(member))
        yield made()
    close()
    yield made()


def neighbours(words: DataFrame) -> DataFrame:
    """``(word, n_near, near_n, near)`` of each word that has a word one edit away: their number, and the
    most frequent one (ties: the smallest in code-point order). ``words`` holds each word once."""
    found = (
        filed_rotations(words).repartition("rest").sortWithinPartitions("rest")
        .mapInArrow(_scan, "word string, n_near long, near_n long, near string")
    )
    # Of equal frequencies the smallest word: UTF-8 orders as code points do.
    first = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", (-F.col("first.less")).alias("near_n"), "first.near"
    )


def _followed(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: the end of each word's chain of forms.

    Each round doubles the steps taken. A form occurs several times as often as its word, so chains have
    a few words and end.
    """
    roots = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = roots.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        after = settle(stepped, "roots")
        discard(roots)
        roots = after
        if roots.where("moved").isEmpty():
            return roots.drop("moved")


def variants(
    docs: DataFrame, least_length: int = 6, least_n: int = 5, times: int = 5, rate: int = 199,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Words are runs of Latin letters (A-Z lower-cased) with one character deleted where the rule of the
    contract says so, of at least ``least_length`` characters and ``least_n`` occurrences. ``n_near`` counts
    the words one edit away; ``form`` is the most frequent of them if it occurs ``times`` as often, else
    null. ``root`` follows the forms to the last, the word itself without one.

    Null and empty texts have no words; a null id counts as the empty string; rows that recur count as
    often as they occur; an empty table gives no rows; other columns are ignored. Texts are read once and
    only counts per word are shuffled; a group of rotations holds 91 rows at most, however many words
    there are.
    """
    words = settle(word_counts(docs, least_length, rate, id_col, text_col).where(F.col("n") >= least_n), "words")
    near = settle(neighbours(words), "near-words")
    is_form = F.col("near_n") >= times * F.col("n")
    known = words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    roots = _followed(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
