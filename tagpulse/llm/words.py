"""Words of a text as runs of 0-9, a-z and all beyond ASCII, after A-Z is lower-cased."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_RUN = re.compile(rb"[0-9a-zA-Z\x80-\xff]+")
#: Bytes of words stay, in lower case; any other becomes a blank.
_TABLE = bytes(
    byte if byte >= 128 or chr(byte).isalnum() else 32 for byte in bytes(range(256)).lower()
)

SPANS = "array<struct<first:int,last:int>>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words ``first`` to ``last`` of each span, and without what stands
    between a span and the next word that stays. Spans are sorted and do not overlap."""
    starts = [match.start() for match in _RUN.finditer(text)]
    kept, at = [], 0
    for first, last in spans:
        kept.append(text[at : starts[first]])
        at = starts[last + 1] if last + 1 < len(starts) else len(text)
    kept.append(text[at:])
    return b"".join(kept)


def words_column(text: Column) -> Column:
    """The same words in SQL, for tables of small texts."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({WORD})"))


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words of ``spans``; null text and text without spans stay."""

    @F.arrow_udf("string")
    def cleaned(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            yield pa.array(
                [
                    None
                    if row is None
                    else cut(row, [(s["first"], s["last"]) for s in where or ()]).decode()
                    for row, where in zip(texts.cast(pa.binary()).to_pylist(), found.to_pylist(), strict=True)
                ],
                pa.string(),
            )

    hit = F.size(spans) > 0
    # Evaluated once, wherever the result is used.
    return F.when(hit, cleaned.asNondeterministic()(F.when(hit, text), F.when(hit, spans))).otherwise(text)
