"""Packing documents into training windows: each seed document's window is filled with its unused BM25 neighbours."""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructType

from ledgerwatch.llm.store import stored, text_of

WINDOW = 1024
END_ID = 0
SHARD_TOKENS = 1 << 18
K1, B = 1.2, 0.75
BATCH_ROWS = 256
TASK_BITS, SHARD_BITS, PACKED = 40, 22, 1 << 62
# Fixed value: how byte-level BPE files without a pattern of their own cut texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Runs of white space of this length are left to the tokenizers library, as the faster one gives up on very long ones.
BLANK_RUN = 4096
_blank_run = re.compile(r"\s{%d}" % BLANK_RUN).search


def _byte_of_char() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def _numbers(ids: list[int]) -> bytes:
    own = array("I", ids)
    return own.tobytes() if own.itemsize == 4 and sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


class Encoder:
    """Token ids of texts under a tokenizers file, as the tokenizers library gives them without added special tokens.

    Where the file is a plain byte-level BPE whose ids follow the order of its merges, tiktoken computes the same ids from
    the same vocabulary at a third of the cost. Texts with the string of a special token or with very long runs of white space,
    and other kinds of files, go to the library itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        about = json.loads(self.library.to_str())
        self.special = [t["content"] for t in about["added_tokens"]]
        self.fast = None
        if self._plain(about):
            chars = _byte_of_char()
            ranks = {bytes(chars[c] for c in t): i for t, i in about["model"]["vocab"].items() if t not in self.special}
            self.fast = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _plain(about: dict) -> bool:
        model, cut = about["model"], about["pre_tokenizer"] or {}
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or about["normalizer"]:
            return False
        options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"].get(a + b, -1) for a, b in pairs]
        in_order = all(x < y for x, y in zip(made, made[1:])) and (not made or made[0] >= 256)
        return in_order and not any(model.get(o) for o in options) and not any(t["lstrip"] or t["rstrip"] for t in about["added_tokens"])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers."""
        usual = self.fast is not None and not any(s in text for s in self.special) and not (len(text) >= BLANK_RUN and _blank_run(text))
        ids = self.fast.encode_ordinary(text) if usual else self.library.encode(text, add_special_tokens=False).ids
        return _numbers(ids)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, key, start, length, doc_tokens, whole, sequence_id, ids): every document's tokens and its end id, cut into full windows and a rest.

    A full window is a sequence by itself (`whole`) and has its sequence id; the rest, shorter than a window, is still to be
    packed. `key` numbers the rows.
    """
    given = docs.select(docs[id_col].alias("id"), F.monotonically_increasing_id().alias("key"), text_of(docs, text).alias("text"))
    kind = StructType([given.schema["id"], *[given.schema["key"]]])
    for name, of in (("start", LongType()), ("length", LongType()), ("doc_tokens", LongType()), ("whole", BooleanType()), ("sequence_id", LongType()), ("ids", BinaryType())):
        kind = kind.add(name, of)
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sequence = encoder(tokenizer_path), TaskContext.get().partitionId() << TASK_BITS
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_ROWS):
                row, start, length, total, whole, sequences, ids = [], [], [], [], [], [], []
                for d, value in enumerate(batch.column(2).slice(begin, BATCH_ROWS)):
                    found = own.encode(value.as_py()) + last
                    n = len(found) // 4
                    for at in range(0, n, window):
                        full = n - at >= window
                        row.append(begin + d)
                        start.append(at)
                        length.append(min(window, n - at))
                        total.append(n)
                        whole.append(full)
                        sequences.append(sequence if full else None)
                        ids.append(found[4 * at : 4 * (at + window)])
                        sequence += full
                taken = [batch.column(c).take(pa.array(row, pa.int64())) for c in (0, 1)]
                longs = [pa.array(c, pa.int64()) for c in (start, length, total, sequences)]
                yield pa.RecordBatch.from_arrays([*taken, *longs[:3], pa.array(whole), longs[3], pa.array(ids, pa.binary())], names=kind.names)

    return given.mapInArrow(run, kind)


# --- the index -------------------------------------------------------------------------------------------------


def document_frequencies(units: DataFrame) -> DataFrame:
    """(token, docs): units that hold each token, summed in each task first; at most one row per token of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                own = np.unique(np.frombuffer(ids.as_buffer(), "<u4")).astype(np.int64)
                if own[-1] >= len(count):
                    count = np.concatenate([count, np.zeros(2 * int(own[-1]) + 1 - len(count), np.int64)])
                count[own] += 1
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(count[held])], names=["token", "docs"])

    return units.select("ids").mapInArrow(run, "token long, docs long").groupBy("token").agg(F.sum("docs").alias("docs"))


class Weights:
    """BM25 weights of tokens from the figures of all units: idf by token, and the mean length."""

    def __init__(self, frequencies: dict[int, int], n_units: int, mean_length: float):
        self.mean_length = max(mean_length, 1.0)
        docs = np.zeros(max(frequencies, default=0) + 1)
        docs[list(frequencies)] = list(frequencies.values())
        self.idf = np.log1p((n_units - docs + 0.5) / (docs + 0.5))

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct tokens of a unit and the weight of each in it."""
        tokens, times = np.unique(ids, return_counts=True)
        norm = K1 * (1 - B + B * len(ids) / self.mean_length)
        return tokens, self.idf[tokens] * times * (K1 + 1) / (times + norm)


class Index:
    """The inverted index of one shard: for each token the units that hold it, with their weights."""

    def __init__(self, units: list[np.ndarray], weights: Weights):
        found = [weights.of(ids) for ids in units]
        self.tokens = [tokens for tokens, _ in found]
        sizes = [len(t) for t in self.tokens]
        every = np.concatenate(self.tokens) if units else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.unit = np.repeat(np.arange(len(units)), sizes)[order]
        self.weight = (np.concatenate([w for _, w in found]) if units else np.zeros(0))[order]
        self.vocabulary, first = np.unique(every[order], return_index=True)
        self.first = np.append(first, len(every))

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of every unit for the tokens of a seed."""
        at = np.searchsorted(self.vocabulary, self.tokens[seed])
        begin, size = self.first[at], self.first[at + 1] - self.first[at]
        place = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.bincount(self.unit[place], self.weight[place], len(self.tokens))


def fill_windows(units: list[np.ndarray], weights: Weights, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(unit, begin, length, sequence, offset): the units of a shard packed into windows.

    A window begins with a seed. Its neighbours that are not used yet follow in the order of their score (ties, and units
    without a common token: in the order of the shard) until the window is full. A neighbour that is cut there is the next seed
    with what is left of it; else the first unused unit is. Only the last window of a shard can stay short.
    """
    index, out = Index(units, weights), []
    used = [0] * len(units)
    free = np.ones(len(units), bool)
    seed, following, sequence = None, 0, 0
    while True:
        while following < len(units) and not free[following]:
            following += 1
        if seed is None:
            if following == len(units):
                return out
            seed = following
        filled, waiting = 0, iter((seed,))
        ranked, seed_of_next = False, None
        while filled < window:
            unit = next(waiting, None)
            if unit is None:
                if ranked:
                    break
                left = np.flatnonzero(free)
                waiting = iter(left[np.argsort(-index.scores(seed)[left], kind="stable")].tolist())
                ranked = True
                continue
            n = min(len(units[unit]) - used[unit], window - filled)
            out.append((unit, used[unit], n, sequence, filled))
            used[unit] += n
            filled += n
            free[unit] = used[unit] < len(units[unit])
            seed_of_next = unit if free[unit] else None
        seed, sequence = seed_of_next, sequence + 1


def _anchored(units: DataFrame, weights) -> DataFrame:
    """The columns of `units` and `anchor`, the token of greatest weight (the smallest of equal ones)."""
    at = units.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weights.value
        for batch in batches:
            anchors = []
            for ids in batch.column(at):
                tokens, weight = own.of(np.frombuffer(ids.as_buffer(), "<u4").astype(np.int64))
                anchors.append(int(tokens[np.argmax(weight)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(anchors, pa.int64())], names=[*batch.schema.names, "anchor"])

    return units.mapInArrow(run, StructType([*units.schema.fields]).add("anchor", LongType()))


def _sharded(units: DataFrame, weights, shard_tokens: int) -> DataFrame:
    """The units with the shard they belong to: at most about three times `shard_tokens` in each.

    Units of one anchor stand together, anchors in the order of their number; an anchor with more tokens than a shard is dealt to
    several by a hash of the row's number. There is one row per anchor, so the running sums and the broadcast are bounded
    by the vocabulary.
    """
    sizes = _anchored(units.select("length", "ids"), weights).groupBy("anchor").agg(F.sum("length").alias("tokens"))
    earlier = Window.orderBy("anchor").rowsBetween(Window.unboundedPreceding, -1)
    parts = F.ceil(F.col("tokens") / shard_tokens).cast("long")
    plan = sizes.select(
        "anchor",
        parts.alias("parts"),
        F.floor(F.coalesce(F.sum("tokens").over(earlier), F.lit(0)) / shard_tokens).cast("long").alias("base"),
        F.coalesce(F.sum(parts - 1).over(earlier), F.lit(0)).alias("extra"),
        F.floor(F.sum("tokens").over(Window.partitionBy()) / shard_tokens).cast("long").alias("bases"),
    )
    placed = _anchored(units, weights).join(F.broadcast(stored(plan, "pack-plan")), "anchor")
    part = F.pmod(F.xxhash64("key"), F.col("parts"))
    return placed.withColumn("shard", F.when(part == 0, F.col("base")).otherwise(F.col("bases") + F.col("extra") + part)).drop("anchor", "parts", "base", "extra", "bases")


def packed(
    docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, start, length, doc_tokens, sequence_id, offset, ids): all tokens of all documents in sequences of at most `window`.

    `ids` holds the token ids of the piece as little-endian unsigned 32-bit numbers; the pieces of a sequence follow one another
    by `offset`. A document of a window or more gives full windows first. What is left of it, and every shorter document,
    is a unit of a BM25 index over token ids, whose document frequencies and mean length come from all units. The index is
    cut into shards of units with the same outstanding token; windows are filled inside a shard.

    Null or empty text: the end id alone. Null id: kept. Repeated rows: each is a document. Ties: see `fill_windows`. Very long
    texts are read whole. Empty input: empty result. Other columns of `docs` are not read, whatever their names.
    """
    cut = stored(pieces(docs, tokenizer_path, window, end_id, id_col, text), "pack-pieces")
    units = cut.filter("not whole").select("id", "key", "start", "length", "doc_tokens", "ids")
    size = units.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean")).first()
    frequencies = {r.token: r.docs for r in document_frequencies(units).collect()}
    weights = docs.sparkSession.sparkContext.broadcast(Weights(frequencies, size.n, size.mean or 0.0))
    shards = _sharded(units, weights, shard_tokens)
    kind = StructType([f for f in cut.schema.fields if f.name in ("id", "start", "length", "doc_tokens", "sequence_id", "ids")]).add("offset", LongType())

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by("key").combine_chunks()
        raw = [v.as_py() for v in table.column("ids")]
        found = fill_windows([np.frombuffer(v, "<u4").astype(np.int64) for v in raw], weights.value, window)
        unit, begin, length, sequence, offset = (list(c) for c in zip(*found))
        own = table.take(pa.array(unit, pa.int64()))
        first = PACKED + (table.column("shard")[0].as_py() << SHARD_BITS)
        start = own.column("start").to_numpy() + np.array(begin)
        ids = pa.array([raw[u][4 * b : 4 * (b + n)] for u, b, n in zip(unit, begin, length)], pa.binary())
        columns = [own.column("id"), pa.array(start), pa.array(length, pa.int64()), own.column("doc_tokens"), pa.array(first + np.array(sequence)), ids, pa.array(offset, pa.int64())]
        return pa.table(columns, names=kind.names)

    filled = shards.groupBy("shard").applyInArrow(fill, kind)
    return cut.filter("whole").withColumn("offset", F.lit(0).cast("long")).select(kind.names).unionByName(filled)


def packing_report(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for every piece. Nulls, ties, repeated rows, empty input
    and other columns as in `packed`."""
    rows = packed(docs, tokenizer_path)
    return rows.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
