"""What the text operators share: words, class keys of texts, and a scratch table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txn_risk.session import discard, settle

__all__ = ["WORD", "ascii_lower", "discard", "is_held_out", "of_keys", "settle", "split_words", "text_key", "texts", "unused"]

# Fixed by the contract: after lower-casing A-Z, a word is a run of digits, letters and any
# character beyond ASCII.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_SPACES = bytes.maketrans(
    bytes(range(65, 91)) + bytes(i for i in range(128) if not chr(i).isalnum()),
    bytes(range(97, 123)) + b" " * sum(not chr(i).isalnum() for i in range(128)),
)


def split_words(text: str | None) -> list[bytes]:
    """The words of ``text`` (none for null) as UTF-8 bytes.

    Every byte of a character beyond ASCII is at least 0x80, so the rule of ``WORD`` may be applied
    to bytes: each other ASCII byte becomes a blank, and the text is split at blanks.
    """
    return text.encode("utf-8", "surrogatepass").translate(_SPACES).split() if text else []


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text)``: the only columns an operator looks at, null texts as empty ones.

    Other columns, whatever their names, are left behind here.
    """
    return df.select(
        df[id_col].alias("doc_id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text")
    )


def text_key(text: Column) -> Column:
    """A 16-byte name of a text; equal texts have equal names."""
    return F.unhex(F.md5(text))


def is_held_out(doc_id: Column) -> Column:
    """Rows kept out of every fit. A null id counts as the empty string."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(name.cast("binary")), F.lit(5)) == 0


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


# Bits of the filter of :func:`of_keys`: 2 MB, however many keys there are.
SLOTS = 1 << 24


def of_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``keys(key)``: what a join would shuffle in vain.

    A bitmap of SLOTS hashed keys is broadcast in pieces of 4 kB. It keeps every row asked for; with
    very many keys it fills up and keeps more, never less.
    """
    def slot(key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(SLOTS))

    maps = keys.select(slot("key").alias("_s")).groupBy(F.bitmap_bucket_number("_s").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_s")).alias("_bits")
    )
    position = f"bitmap_bit_position(pmod(xxhash64(key), {SLOTS}L))"
    byte = f"cast(conv(hex(substring(_bits, cast(floor({position} / 8) as int) + 1, 1)), 16, 10) as int)"
    return rows.withColumn("_bucket", F.bitmap_bucket_number(slot("key"))).join(F.broadcast(maps), "_bucket").where(
        F.expr(f"(shiftright({byte}, cast({position} % 8 as int)) & 1) = 1")
    ).drop("_bucket", "_bits")
