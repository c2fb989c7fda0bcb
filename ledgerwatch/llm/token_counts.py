"""Exact token counts of every prefix of a text, by dynamic programming over prefixes."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerwatch.llm.store import text_of

TOKEN_LIMIT = 4096
SPACE = "▁"
KEEP_LENGTH = 64
KEEP_PARTS = 500_000
KEEP_PAIRS = 2_000_000
PAIR = 1 << 32


class PrefixCounter:
    """Token counts of all prefixes of a text under a byte-pair sentencepiece model.

    Merging never crosses the border between a word and the spaces after it, nor a line feed, as no piece of the vocabulary
    does; so a text falls into parts whose counts add up. Inside a part, the last token of each prefix is the one piece
    that ends there and stays a token next to the last token of the prefix before it. Whether two pieces stay apart is
    asked of the model once and remembered; the texts themselves are never encoded.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        special = [self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i) for i in ids]
        self.pieces = {self.model.id_to_piece(i) for i in ids if not special[i]}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.pieces):
            raise ValueError("the vocabulary has pieces across words or lines; its texts do not fall into parts")
        # Every ending of a piece, with the id of the piece it is, or -1: the walk back from a position stops where none goes on.
        self.endings = {p[k:]: -1 for p in self.pieces for k in range(len(p))}
        self.endings.update((self.model.id_to_piece(i), i) for i in ids if not special[i])
        self.bare = len(self.model.encode("\n"))
        self.known: dict[str, Sequence[int]] = {}
        self.older: dict[str, Sequence[int]] = {}
        self.apart: dict[int, bool] = {}
        self.at, self.last, self.codes, self.sums = "", [""], [999_999], [0]
        self.split = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+").findall

    def parts(self, text: str) -> list[str]:
        """The parts of a text. The model puts one space before it, which is the first character of the first part."""
        return self.split((" " + text).replace(" ", SPACE)) if text else []

    def width(self, piece: str) -> int:
        return 1 if piece in self.pieces else len(piece.encode("utf-8", "replace"))

    def code(self, piece: str) -> int:
        """The id of a piece; a character outside the vocabulary has a number of its own, as has the start of a part."""
        found = self.endings.get(piece, -1)
        return found if found >= 0 else 1_000_000 + ord(piece) if piece else 999_999

    def stay_apart(self, left: str, right: str) -> bool:
        """Does the model leave these two pieces, one after the other, as they are? An empty left: the right one alone."""
        tokens = self.model.encode("\n" + left + right, out_type=str)[self.bare :]
        wanted = [p for x in (left, right) if x for p in ([x] if x in self.pieces else self.model.encode("\n" + x, out_type=str)[self.bare :])]
        if len(self.apart) >= KEEP_PAIRS:
            self.apart.clear()
        found = self.apart[self.code(left) * PAIR + self.code(right)] = tokens == wanted
        return found

    def count_part(self, part: str) -> Sequence[int]:
        """Token counts of the prefixes of one part, shortest first.

        The state of the part before is kept as far as the two begin alike, so parts in sorted order cost little each.
        """
        same, most = 0, min(len(part), len(self.at))
        while same < most and part[same] == self.at[same]:
            same += 1
        last, codes, counts = self.last, self.codes, self.sums
        del last[same + 1 :], codes[same + 1 :], counts[same + 1 :]
        self.at = part
        endings, apart = self.endings.get, self.apart.get
        for end in range(same + 1, len(part) + 1):
            begin = end - 1
            tried = []
            found = endings(part[begin:end])
            if found is None or found < 0:
                tried.append((begin, self.code(part[begin:end])))
            while found is not None:
                if found >= 0:
                    tried.append((begin, found))
                begin -= 1
                found = endings(part[begin:end]) if begin >= 0 else None
            for begin, code in reversed(tried):
                stays = apart(codes[begin] * PAIR + code)
                if stays is None:
                    stays = self.stay_apart(last[begin], part[begin:end])
                if stays:
                    piece = part[begin:end]
                    last.append(piece)
                    codes.append(code)
                    counts.append(counts[begin] + (1 if code < 999_999 else self.width(piece)))
                    break
            else:
                raise ValueError(f"no piece ends the prefix {part[:end]!r}")
        return bytes(counts[1:]) if counts[-1] < 200 and max(counts) < 256 else array("q", counts[1:])

    def counts(self, texts: list[str]) -> list[list[Sequence[int]]]:
        """For each text, the counts of the prefixes of its parts; they are the text's after adding what comes before.

        Parts are remembered in two generations, so that frequent ones stay and the memory is bounded.
        """
        if len(self.known) >= KEEP_PARTS:
            self.older, self.known = self.known, {}
        split = [self.parts(text) for text in texts]
        known, older = self.known, self.older
        fresh = sorted({part for parts in split for part in parts if part not in known})
        for part in fresh:
            known[part] = older.get(part) or self.count_part(part)
        out = [[known[part] for part in parts] for parts in split]
        for part in fresh:
            if len(part) > KEEP_LENGTH:
                del known[part]
        return out

    def every_prefix(self, text: str) -> np.ndarray:
        """Token counts of text[:0], text[:1], ..., text."""
        return running(self.counts([text])[0])


def running(parts: list[Sequence[int]]) -> np.ndarray:
    """Token counts of every prefix of a text from those of its parts. The first character of the first part is the space
    that the model adds, which an empty text does not get."""
    if not parts:
        return np.zeros(1, np.int64)
    before = np.cumsum([0] + [int(c[-1]) for c in parts[:-1]])
    flat = np.concatenate([np.frombuffer(c, np.uint8) if isinstance(c, bytes) else np.array(c, np.int64) for c in parts])
    out = flat.astype(np.int64) + np.repeat(before, [len(c) for c in parts])
    out[0] = 0
    return out


def longest_within(prefixes: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix whose token count is at most `budget`."""
    return int(np.flatnonzero(prefixes <= budget)[-1])


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def _groups(column: pa.Array, most: int = 4 << 20) -> Iterator[list[str]]:
    """The texts of a column in groups of about `most` characters."""
    group: list[str] = []
    held = 0
    for at in range(0, len(column), 256):
        for value in column.slice(at, 256).to_pylist():
            group.append(value or "")
            held += len(group[-1])
            if held >= most:
                yield group
                group, held = [], 0
    if group:
        yield group


def count_tokens(docs: DataFrame, model_path: str, limit: int = TOKEN_LIMIT, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, fits_chars for every row: the longest prefix of at most `limit` tokens, in code points.

    Null or empty text: no bytes, no tokens. Null id: kept as it is. Equal rows: each has its row. Very long texts are read
    whole, at a cost linear in their length. Empty input: empty result.
    """
    whole = isinstance(docs.schema[id_col].dataType, IntegralType)
    kind, arrow_kind = ("bigint", pa.int64()) if whole else ("string", pa.string())
    types = pa.schema([("id", arrow_kind), *[(n, pa.int64()) for n in ("n_bytes", "n_tokens", "fits_chars")]])

    def run(batches):
        own = counter(model_path)
        for batch in batches:
            n_bytes, n_tokens, fits = [], [], []
            for group in _groups(batch.column(1)):
                for value, counts in zip(group, own.counts(group)):
                    total = sum([c[-1] for c in counts])
                    n_bytes.append(len(value.encode()))
                    n_tokens.append(total)
                    fits.append(len(value) if total <= limit else longest_within(running(counts), limit))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in (n_bytes, n_tokens, fits)]], schema=types)

    given = docs.select(docs[id_col].cast(kind).alias("id"), text_of(docs, text).alias("text"))
    return given.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, fits_chars bigint")


def prefix_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id and prefix_tokens, an array with the token count of text[:0], text[:1], ... up to the whole text.

    Element i answers what a cut after i characters costs; the last i with a count of at most b is the cut for a budget b.
    Null or empty text: [0].
    """

    def run(batches):
        own = counter(model_path)
        for batch in batches:
            rows = [running(counts) for group in _groups(batch.column(1)) for counts in own.counts(group)]
            ends = np.cumsum([0] + [len(r) for r in rows]).astype(np.int32)
            flat = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, flat)], names=["id", "prefix_tokens"])

    given = docs.select(docs[id_col].cast("string").alias("id"), text_of(docs, text).alias("text"))
    return given.mapInArrow(run, "id string, prefix_tokens array<bigint>")


def token_report(docs: DataFrame, model_path: str) -> DataFrame:
    counted = count_tokens(docs, model_path)
    return counted.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "fits_chars")
