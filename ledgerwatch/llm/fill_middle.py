"""Fill-in-the-middle: texts are cut at token borders and their blocks exchanged in place by rotations, exactly invertible."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from ledgerwatch.llm.store import text_of
from ledgerwatch.llm.words import Words, split_words

SEED = 42
FORM_PERCENT = 50
SPM_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
SWAP_BYTES = 1 << 16


def reverse(block: bytearray, begin: int, end: int) -> None:
    """Reverse block[begin:end] in place, by swaps of at most SWAP_BYTES from both ends."""
    view = np.frombuffer(block, np.uint8)
    while end - begin > 1:
        step = min(SWAP_BYTES, (end - begin) // 2)
        head = view[begin : begin + step].copy()
        view[begin : begin + step] = view[end - step : end][::-1]
        view[end - step : end] = head[::-1]
        begin, end = begin + step, end - step


def rotate(block: bytearray, begin: int, middle: int, end: int) -> None:
    """Exchange the neighbouring segments [begin, middle) and [middle, end) in place: each is reversed, then both together."""
    reverse(block, begin, middle)
    reverse(block, middle, end)
    reverse(block, begin, end)


def transformed(text: bytes, prefix_end: int, middle_end: int, form: str) -> bytearray:
    """The text in its form: psm <P>prefix<S>suffix<M>middle, spm <S>suffix<P>prefix<M>middle, plain unchanged.

    The sentinels go in before their segments as these lie in the text; one rotation then brings the suffix forward.
    """
    block = bytearray(text)
    if form == "plain":
        return block
    for place, mark in ((middle_end, SUFFIX), (prefix_end, MIDDLE), (0, PREFIX)):
        block[place:place] = mark
    rotate(block, 0 if form == "spm" else prefix_end + MARK, middle_end + 2 * MARK, len(block))
    return block


def inverted(output: bytes, form: str) -> bytearray:
    """The text again, from its output and form alone: the rotation undone, then the sentinels taken out.

    A text that holds a sentinel stays plain and sentinels cannot arise across the borders of segments, so the sentinels
    found are the ones put in.
    """
    block = bytearray(output)
    if form == "plain":
        return block
    size, middle = len(block), output.find(MIDDLE)
    begin, cut = (0, output.find(PREFIX)) if form == "spm" else (output.find(SUFFIX), middle)
    rotate(block, begin, cut, size)
    suffix_at = begin + size - cut
    for place in (suffix_at, middle - cut if form == "spm" else begin, 0):
        del block[place : place + MARK]
    return block


def _n_chars(part: np.ndarray) -> int:
    """Code points of UTF-8 bytes: those that do not continue one."""
    return int(np.count_nonzero((part & 0xC0) != 0x80))


def _cuts(words: Words, d: int, h1: int, h2: int) -> tuple[int, int, int]:
    """(tokens, end of the prefix, end of the middle) of text d in bytes. A token is a word with the blanks before it, or the blanks at the end."""
    begin, end = int(words.offsets[d]), int(words.offsets[d + 1])
    k, last = int(words.first[d]), int(words.first[d + 1])
    tail = end > (words.end[last - 1] if last > k else begin)
    n = last - k + int(tail)
    ends = (0 if i == 0 else end - begin if i > last - k else int(words.end[k + i - 1]) - begin for i in sorted((h1 % (n + 1), h2 % (n + 1))))
    return (n, *ends)


def _text_array(values: list[bytes | bytearray]) -> pa.Array:
    return pa.array([bytes(v) for v in values], pa.binary()).view(pa.string())


def fill_in_middle(docs: DataFrame, seed: int = SEED, form_percent: int = FORM_PERCENT, spm_percent: int = SPM_PERCENT, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n (tokens), form, prefix_chars, middle_chars, output for every row of `docs`. No row is shuffled.

    Tokens are words with the blanks before them, and the blanks at the end of the text. Two cuts and the form come from the
    sha256 of the seed and the id, so reruns and rows of one id are cut alike. Null text: as empty. Empty text, or one that
    holds a sentinel: plain. Null id: hashed as an empty id, kept null. Repeated rows: each has its row. Very long texts are
    cut whole. Empty input: empty result. Other columns of `docs` are not read, whatever their names.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[id_col].cast("string"), F.lit(""))).cast("binary"), 256)
    groups = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    given = docs.select(docs[id_col].alias("id"), text_of(docs, text).alias("text"), *groups)
    kind = StructType([given.schema["id"]])
    for name, of in (("n", LongType()), ("form", StringType()), ("prefix_chars", LongType()), ("middle_chars", LongType()), ("output", StringType())):
        kind = kind.add(name, of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [batch.column(i).to_pylist() for i in range(2, 6)]
            for words in split_words(batch.column(1), lower=False):
                n_tokens, forms, prefix, middle, output = [], [], [], [], []
                for d, row in enumerate(range(words.rows.start, words.rows.stop)):
                    h1, h2, h3, h4 = (h[row] for h in hashes)
                    own = words.data[words.offsets[d] : words.offsets[d + 1]]
                    raw = own.tobytes()
                    n, p, m = _cuts(words, d, h1, h2)
                    plain = not raw or any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= form_percent
                    form = "plain" if plain else "spm" if h4 % 100 < spm_percent else "psm"
                    n_tokens.append(n)
                    forms.append(form)
                    prefix.append(None if plain else _n_chars(own[:p]))
                    middle.append(None if plain else _n_chars(own[p:m]))
                    output.append(transformed(raw, p, m, form))
                ids = batch.column(0).slice(words.rows.start, len(forms))
                longs = [pa.array(c, pa.int64()) for c in (n_tokens, prefix, middle)]
                arrays = [ids, longs[0], pa.array(forms, pa.string()), longs[1], longs[2], _text_array(output)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return given.mapInArrow(run, kind)


def restored(rows: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """The columns of `rows` and the texts rebuilt from `output` and `form`. A null output gives null; a null form counts as plain."""
    at, how = rows.columns.index(output), rows.columns.index(form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                pairs = zip(part.column(at).view(pa.binary()).to_pylist(), part.column(how).to_pylist())
                texts = [None if value is None else bytes(inverted(value, kind or "plain")) for value, kind in pairs]
                column = pa.array(texts, pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, name])

    return rows.mapInArrow(run, StructType([*rows.schema.fields]).add(name, StringType()))


def fill_in_middle_report(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of the output and of the text rebuilt from it, for every row.

    Nulls, ties, repeated rows, empty input and other columns as in `fill_in_middle`.
    """
    both = restored(fill_in_middle(docs))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return both.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))
