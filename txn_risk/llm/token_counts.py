"""Token counts of whole texts: encoded in batches of even size, of which only lengths are kept."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txn_risk.llm.words import texts

# Characters that the library encodes in one call, and above which a text is split.
BATCH = 1 << 18

# Kinds of splitting rules that never join a white-space character to what stands before it.
_KNOWN_RULES = {"ByteLevel", "Split", "Whitespace", "WhitespaceSplit", "BertPreTokenizer"}
# Where a text may be cut: between an ASCII letter or digit and the blank that parts it from another.
_BLANK = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")


class Counter:
    """Numbers of tokens by a vocabulary's own library.

    ``.json`` is read by tokenizers, ``.model`` by sentencepiece. Special tokens are not added; their
    strings inside a text are handled as the library does by itself.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.cuts, self.keep_blank = True, True
        if vocabulary.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=vocabulary)
            self.lengths: Callable[[list[str]], list[int]] = lambda batch: [
                len(ids) for ids in model.encode(batch, num_threads=1)
            ]
            # The blank becomes the mark that begins the next word, which the library puts before a text
            # as well; so the part after a cut begins with its word.
            self.keep_blank = False
            marked = all("▁" not in model.id_to_piece(i).lstrip("▁") for i in range(len(model)))
            self.cuts = marked and len(model.encode("a a", out_type=str)) == 2 * len(model.encode("a", out_type=str))
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(vocabulary)
            model.no_truncation()
            model.no_padding()
            self.lengths = lambda batch: [len(e.ids) for e in model.encode_batch_fast(batch, add_special_tokens=False)]
            self.cuts = _splits_at_blanks(json.loads(model.to_str()))

    def parts(self, text: str, size: int) -> Iterator[str]:
        """``text`` in parts of about ``size`` characters whose tokens are together those of the text.

        A text without a safe place stays whole, as does every text if the vocabulary has no such places.
        """
        at = 0
        while self.cuts and len(text) - at > size:
            blank = _BLANK.search(text, at + size)
            if not blank:
                break
            yield text[at:blank.start()]
            at = blank.start() if self.keep_blank else blank.end()
        yield text[at:] if at else text

    def count(self, batch: Sequence[str], size: int = BATCH) -> list[int]:
        """Tokens of each text, encoded in calls of about ``size`` characters."""
        totals = [0] * len(batch)
        own: list[int] = []
        held: list[str] = []
        room = size

        def encode() -> None:
            for k, n in zip(own, self.lengths(held), strict=True):
                totals[k] += n
            own.clear()
            held.clear()

        for k, text in enumerate(batch):
            for part in self.parts(text, size):
                if held and len(part) > room:
                    encode()
                    room = size
                own.append(k)
                held.append(part)
                room -= len(part)
        if held:
            encode()
        return totals


def _splits_at_blanks(rules: dict) -> bool:
    """Whether no token reaches over a blank between two words, by the vocabulary's own description."""
    rule = rules.get("pre_tokenizer") or {}
    steps = rule.get("pretokenizers", [rule])
    return (
        rules["model"]["type"] in ("BPE", "WordPiece") and steps[0].get("type") in _KNOWN_RULES
        and all(s.get("add_prefix_space") in (None, False) for s in steps)
        and not any(t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in rules["added_tokens"])
        and (steps[0]["type"] != "Split" or steps[0]["pattern"] == _WORDS_ONLY)
    )


# Fixed value: the splitting rule of a vocabulary of lower-case words, which leaves white space out.
_WORDS_ONLY = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}

_COUNTERS: dict[str, Counter] = {}


def _counter(vocabulary: str) -> Counter:
    if vocabulary not in _COUNTERS:
        _COUNTERS[vocabulary] = Counter(vocabulary)
    return _COUNTERS[vocabulary]


def count(
    docs: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text", size: int = BATCH,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens).

    ``n_bytes`` is the length in UTF-8, ``n_tokens`` the number of tokens of the whole text by the
    library of ``vocabulary``. A null or empty text has 0 of both. Repeated rows and null ids give a row
    each; an empty table gives no rows; other columns are ignored. One scan without a shuffle; a worker
    holds the tokens of ``size`` characters, or of the longest stretch without a blank.
    """
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            n = counter.count(batch.column("text").to_pylist(), size)
            kept = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(kept, names=["doc_id", "n_bytes", "n_tokens"])

    source = texts(docs, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    kind = source.schema["doc_id"].dataType.simpleString()
    counted = source.mapInArrow(lengths, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
