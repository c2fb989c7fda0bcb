"""Benchmark decontamination: latent semantic search proposes passages, common subsequences and answers confirm them.

A second route, by counts of each item's rarest words, proposes what the latent space does not show: copies of a few words, and
paraphrases among rarer words. Every finding says which route proposed it first.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.store import stored, text_of
from ledgerwatch.llm.words import Words, split_words

BUCKETS = 1 << 18
WINDOW = 24
STRIDE = 8
ITEM_STRIDE = 12
DIMENSIONS = 128
EXTRA_DIMENSIONS = 32
BLOCK_ITEMS = 500
MOST_COLUMNS = 8192
MOST_PASSAGES = 1 << 22
SLICE_ROWS = 32
NOISE = 1e-6
ENERGY = 0.25
COSINE = 0.5
RARE_HITS = 0.25
SUBSEQUENCE = 0.6
SURE_SUBSEQUENCE = 0.8
SHORT_ITEM = 8
ANSWER_WORDS = 5
ANSWER_FOUND = 0.6


def _lower(rows: DataFrame, text: str) -> Column:
    """Texts are compared in lower case, letters of all alphabets."""
    return F.lower(text_of(rows, text)).alias("text")


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(46)).astype(np.int64)


def document_frequency(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """(number of documents, documents per bucket of hashed words), over all documents. Its size is fixed by BUCKETS."""

    def run(batches):
        counts, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            n += len(batch)
            for words in split_words(batch.column(0)):
                row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
                pairs = np.unique(row * BUCKETS + buckets(words.hash))
                counts += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(counts[used], n))], names=["bucket", "n"])

    total = docs.select(_lower(docs, text)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = total.toArrow()
    at, n = rows["bucket"].to_numpy(), rows["n"].to_numpy()
    out = np.zeros(BUCKETS, np.int64)
    out[at[at >= 0]] = n[at >= 0]
    return int(n[at < 0].sum()), out


def window_starts(n: int, stride: int = STRIDE) -> np.ndarray:
    """Starts of windows that cover n words; the last one ends with the text."""
    if n <= WINDOW:
        return np.zeros(min(n, 1), np.int64)
    return np.unique(np.append(np.arange(0, n - WINDOW, stride), n - WINDOW))


def rows_of(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) of every word in windows starts[i]:ends[i]."""
    lengths = ends - starts
    row = np.repeat(np.arange(len(starts)), lengths)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)


@dataclass
class Block:
    """A block of benchmark items, their windows, and the latent space of their vocabulary."""

    ids: list[int]
    words: list[np.ndarray]
    idf: np.ndarray
    column: np.ndarray
    n_columns: int
    owner: np.ndarray
    rare_first: np.ndarray
    rare_items: np.ndarray
    rare_needed: np.ndarray
    basis: np.ndarray | None = None
    latent: np.ndarray | None = None

    def project(self, at: np.ndarray, starts: np.ndarray, ends: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """TF-IDF windows over the words in buckets `at`, times a matrix with a row per word of the vocabulary."""
        out = np.zeros((len(starts), matrix.shape[1]), np.float32)
        for part in range(0, len(starts), 2048):
            row, position = rows_of(starts[part : part + 2048], ends[part : part + 2048])
            column = self.column[at[position]]
            inside = column >= 0
            row, column, position = row[inside], column[inside], position[inside]
            if len(row):
                values = matrix[column] * self.idf[at[position], None]
                first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                out[part + row[first]] = np.add.reduceat(values, first, axis=0)
        return out


def make_block(items: list, idf: np.ndarray) -> Block:
    ids, words = [], []
    for part in split_words(pa.array([t or "" for _, t in items], pa.string())):
        for d in range(part.rows.stop - part.rows.start):
            own = part.hash[part.first[d] : part.first[d + 1]]
            if len(own) and items[part.rows.start + d][0] is not None:
                ids.append(int(items[part.rows.start + d][0]))
                words.append(own)
    vocabulary = np.unique(buckets(np.concatenate(words))) if words else np.zeros(0, np.int64)
    column = np.full(BUCKETS, -1, np.int32)
    column[vocabulary] = np.arange(len(vocabulary))
    return Block(ids, words, idf, column, len(vocabulary), np.zeros(0, np.int64), *rare_words(words, idf, column, len(vocabulary)))


def rare_words(words: list[np.ndarray], idf: np.ndarray, column: np.ndarray, n_columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first posting per word of the vocabulary, postings: the items that have it among their rarest, hits each item needs).

    A text that holds an item of n words lacks at most n - needed(n) of its places, so it has at least h of any n -
    needed(n) + h places in one stretch. Those are the rarest, by the figures of all documents; h is RARE_HITS of what is
    needed, and all places for short items. The bound holds for any choice of places and any h.
    """
    pairs, hits = [], np.zeros(len(words), np.int64)
    for k, own in enumerate(words):
        n, least = len(own), math.ceil(needed(len(own)))
        hits[k] = least if n <= SHORT_ITEM else max(1, int(RARE_HITS * least))
        at = buckets(own)
        rarest = at[np.argsort(-idf[at], kind="stable")[: n - least + hits[k]]]
        pairs.append(np.unique(column[rarest]).astype(np.int64) * len(words) + k)
    flat = np.sort(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    n_items = max(1, len(words))
    return np.searchsorted(flat // n_items, np.arange(n_columns + 1)), flat % n_items, hits


def item_windows(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of all item words, window starts, ends, item of each window)."""
    at, starts, ends, owner, base = [], [], [], [], 0
    for k, own in enumerate(block.words):
        first = window_starts(len(own), ITEM_STRIDE)
        at.append(buckets(own))
        starts.append(base + first)
        ends.append(base + np.minimum(first + WINDOW, len(own)))
        owner.append(np.full(len(first), k))
        base += len(own)
    return tuple(np.concatenate(x) for x in (at, starts, ends, owner))


def passage_starts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the passages that the latent space is fitted on: windows of all texts that do not overlap, but for the last."""
    lengths = np.diff(words.first)
    starts = [first + window_starts(int(n), WINDOW) for first, n in zip(words.first, lengths)]
    first = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return first, np.minimum(first + WINDOW, np.repeat(words.first[1:], [len(f) for f in starts]))


def count_pairs(block: Block, at: np.ndarray, first: np.ndarray, last: np.ndarray, pairs: np.ndarray, single: np.ndarray) -> None:
    """Add to `pairs` (column * n_columns + earlier column) and `single` how often words of the vocabulary share a passage."""
    for part in range(0, len(first), 2048):
        row, position = rows_of(first[part : part + 2048], last[part : part + 2048])
        column = block.column[at[position]].astype(np.int64)
        inside = column >= 0
        row, column = row[inside], column[inside]
        single += np.bincount(column, minlength=block.n_columns)
        for step in range(1, min(WINDOW, len(row))):
            same = np.flatnonzero(row[step:] == row[:-step])
            if not len(same):
                break
            np.add.at(pairs, column[same + step] * block.n_columns + column[same], np.int32(1))


def fit(block: Block, docs: DataFrame) -> Block:
    """Latent space of the block's vocabulary by a distributed randomised SVD of TF-IDF passages, in one pass.

    The passages are the windows of all texts of `docs` (one column) and of the items; items weigh as much as the documents.
    The pass multiplies A'A by a tall thin matrix: a task counts the word pairs of its passages and returns the product, which
    is summed by Spark in slices of SLICE_ROWS words; the eigenvectors of A'A follow from the product (Nystrom). A vocabulary
    of more than MOST_COLUMNS words, whose pairs do not fit a task, is multiplied passage by passage, with the same sums.
    """
    spark = docs.sparkSession
    at, starts, ends, block.owner = item_windows(block)
    n_columns, width = block.n_columns, min(DIMENSIONS + EXTRA_DIMENSIONS, block.n_columns)
    test, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((n_columns, width)))
    weights = np.zeros(n_columns, np.float32)
    weights[block.column[block.column >= 0]] = block.idf[block.column >= 0]

    def transposed(own, first, last, product) -> np.ndarray:
        out = np.zeros((n_columns, product.shape[1]))
        for part in range(0, len(first), 2048):
            row, position = rows_of(first[part : part + 2048], last[part : part + 2048])
            column = block.column[own[position]]
            order = np.argsort(column, kind="stable")[np.count_nonzero(column < 0) :]
            if len(order):
                row, column, position = row[order], column[order], position[order]
                values = product[part + row] * block.idf[own[position], None]
                begin = np.flatnonzero(np.append(True, column[1:] != column[:-1]))
                out[column[begin]] += np.add.reduceat(values, begin, axis=0)
        return out

    def multiplied(pairs: np.ndarray, single: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """A'(A matrix) from the counts of word pairs."""
        scaled = matrix * weights[:, None]
        out, table = scaled * single[:, None].astype(np.float32), pairs.reshape(n_columns, n_columns)
        for low in range(0, n_columns, 512):
            some = table[low : low + 512].astype(np.float32)
            out[low : low + 512] += some @ scaled
            out += some.T @ scaled[low : low + 512]
        return out * weights[:, None]

    shared = spark.sparkContext.broadcast(test.astype(np.float32))

    def run(batches):
        matrix, task, counted = shared.value, TaskContext.get().partitionId(), n_columns <= MOST_COLUMNS
        total, n = np.zeros(matrix.shape), 0
        pairs, single, held = np.zeros(n_columns**2 if counted else 0, np.int32), np.zeros(n_columns, np.int64), 0
        for batch in batches:
            for words in split_words(batch.column(0)):
                own, (first, last) = buckets(words.hash), passage_starts(words)
                n += len(first)
                if counted and held + len(first) > MOST_PASSAGES:
                    total += multiplied(pairs, single, matrix)
                    pairs[:], single[:], held = 0, 0, 0
                if counted:
                    count_pairs(block, own, first, last, pairs, single)
                    held += len(first)
                else:
                    total += transposed(own, first, last, block.project(own, first, last, matrix))
        if held:
            total += multiplied(pairs, single, matrix)
        if n:
            parts = [total[low : low + SLICE_ROWS].astype(np.float32).tobytes() for low in range(0, n_columns, SLICE_ROWS)]
            columns = [pa.array(range(len(parts))), pa.array([task] * len(parts)), pa.array([n] * len(parts)), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "task", "n", "part"])

    def add_up(table: pa.Table) -> pa.Table:
        """The sum of one slice over all tasks, in the order of the tasks."""
        table = table.sort_by("task")
        total = np.zeros(len(table["part"][0].as_py()) // 4)
        for part in table["part"]:
            total += np.frombuffer(part.as_py(), np.float32)
        return pa.table({"slice": table["slice"][:1], "n": [sum(table["n"].to_pylist())], "part": pa.array([total.tobytes()], pa.binary())})

    made = docs.mapInArrow(run, "slice long, task long, n long, part binary")
    got = sorted(made.groupBy("slice").applyInArrow(add_up, "slice long, n long, part binary").collect(), key=lambda r: r.slice)
    shared.unpersist()
    product = np.concatenate([np.frombuffer(r.part) for r in got]).reshape(test.shape) if got else np.zeros(test.shape)
    weight = max(1, got[0].n if got else 0) / max(1, len(starts))
    product = product + weight * transposed(at, starts, ends, block.project(at, starts, ends, test.astype(np.float32)))
    product += NOISE * np.linalg.norm(product) * test
    core = test.T @ product
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    sure = values > NOISE * values[-1]
    basis, _, _ = np.linalg.svd(product @ (vectors[:, sure] / np.sqrt(values[sure])), full_matrices=False)
    block.basis = np.ascontiguousarray(basis[:, :DIMENSIONS], np.float32)
    latent = block.project(at, starts, ends, block.basis)
    block.latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    return block


def masks_of(words: list[int]) -> dict[int, int]:
    """For each distinct word, a bit mask of its places."""
    out: dict[int, int] = {}
    for k, h in enumerate(words):
        out[h] = out.get(h, 0) | (1 << k)
    return out


def common_subsequence(n: int, hits: list[int]) -> int:
    """Length of the longest common subsequence of n words and a text, given the places of each of its words that match."""
    full = (1 << n) - 1
    row = full
    for mask in hits:
        hit = row & mask
        row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


def overlap(n: int, masks: dict[int, int], text: list[int]) -> tuple[int, int]:
    """(longest common subsequence, words of the answer found in order) of an item of n words in the best stretch of a text.

    Stretches are a third longer than the item, so that words put in between do not hide it. The answer is what an item
    ends with. A stretch that holds the item is better than one that does not. Stretches with too few words of the item
    are passed over: (0, 0) if all are.
    """
    length = stretch_words(n)
    places = [k for k, h in enumerate(text) if h in masks]
    hits = [masks[text[k]] for k in places]
    answer = min(n, ANSWER_WORDS)
    tail = n - answer
    best = (False, 0, 0)
    for begin in range(0, max(1, len(text) - length + max(1, n // 4)), max(1, n // 4)):
        a, b = bisect_left(places, begin), bisect_left(places, begin + length)
        least = max(needed(n), best[1] if best[0] else 0)
        if b - a >= least:
            common = common_subsequence(n, hits[a:b])
            if common >= least:
                found = common_subsequence(answer, [h >> tail for h in hits[a:b]])
                best = max(best, (holds(n, common, found), common, found))
                if common == n:
                    break
    return best[1:]


def stretch_words(n: int) -> int:
    """Words of the stretches of a text in which an item of n words is looked for."""
    return n + n // 3 + 4


def needed(n: int) -> float:
    """The least common subsequence with an item of n words that counts. Short items have to be there whole."""
    return max(round(SUBSEQUENCE * n, 6), min(n, SHORT_ITEM))


def holds(n: int, common: int, answer: int) -> bool:
    """Does a text hold an item of n words, given what of it was found in order?"""
    return common >= needed(n) and (common >= round(SURE_SUBSEQUENCE * n, 6) or answer >= ANSWER_FOUND * min(n, ANSWER_WORDS))


def _stretches(block: Block, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, start, end) of the stretches with enough of the item's rare words close together; those that meet are one.

    A stretch reaches as far as the item can that has these words. It counts places of a text, so none that holds an item
    is left out.
    """
    column = block.column[buckets(words.hash)]
    known = np.flatnonzero(column >= 0)
    row, posting = rows_of(block.rare_first[column[known]], block.rare_first[column[known] + 1])
    item = block.rare_items[posting]
    order = np.argsort(item, kind="stable")
    item, place = item[order], known[row[order]]
    text = np.searchsorted(words.first, place, "right") - 1
    length = np.array([stretch_words(len(w)) for w in block.words])[item]
    last = np.arange(len(item)) + block.rare_needed[item] - 1
    begin = np.flatnonzero(last < len(item))
    last = last[begin]
    close = (item[last] == item[begin]) & (text[last] == text[begin]) & (place[last] - place[begin] < length[begin])
    begin, last = begin[close], last[close]
    item, text, length = item[begin], text[begin], length[begin]
    low = np.maximum(words.first[text], place[last] - length + 1)
    high = np.minimum(words.first[text + 1], place[begin] + length)
    new = np.append(True, (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (low[1:] > high[:-1]))[: len(item)]
    end = np.append(new[1:], True)[: len(item)]
    return text[new], item[new], low[new], high[end]


def near_stretches(block: Block, words: Words) -> list[tuple[int, int, int, int]]:
    """(text, item, start, end) of the stretches around windows that are near a window of the item in the latent space.

    A window is projected if a share ENERGY of its TF-IDF energy lies in the vocabulary of the items, and is near at a cosine of
    COSINE. Stretches reach an item's length beyond their windows; those that meet are one.
    """
    at = buckets(words.hash)
    square = (block.idf**2).astype(np.float64)
    sums = [np.concatenate([[0.0], np.cumsum(x[at])]) for x in (square, np.where(block.column >= 0, square, 0.0))]
    firsts = [words.first[d] + window_starts(int(n)) for d, n in enumerate(np.diff(words.first))]
    first = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(firsts)), [len(f) for f in firsts])
    last = np.minimum(first + WINDOW, words.first[1:][row])
    enough = sums[1][last] - sums[1][first] >= ENERGY * (sums[0][last] - sums[0][first])
    first, last, row = first[enough], last[enough], row[enough]
    latent = block.project(at, first, last, block.basis)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    near = []
    for part in range(0, len(first), 4096):
        window, passage = np.nonzero(latent[part : part + 4096] @ block.latent.T >= COSINE)
        near.append(np.stack([row[part + window], block.owner[passage], first[part + window]], axis=1))
    near = np.unique(np.concatenate(near), axis=0) if near else np.zeros((0, 3), np.int64)
    out: list[tuple[int, int, int, int]] = []
    for d, item, start in near.tolist():
        n = len(block.words[item])
        low, high = max(int(words.first[d]), start - n), min(int(words.first[d + 1]), start + WINDOW + n)
        if out and out[-1][:2] == (d, item) and low <= out[-1][3]:
            out[-1] = (d, item, out[-1][2], high)
        else:
            out.append((d, item, low, high))
    return out


def _cosines(block: Block, at: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[float]:
    """For each stretch, the best cosine of one of its windows and one of the item's, in the latent space."""
    out = []
    for k, a, b in zip(item.tolist(), low.tolist(), high.tolist()):
        first = a + window_starts(b - a)
        latent = block.project(at, first, np.minimum(first + WINDOW, b), block.basis)
        latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
        own = slice(*np.searchsorted(block.owner, [k, k + 1]))
        out.append(float((latent @ block.latent[own].T).max()))
    return out


FOUND = "id long, item_id long, cosine double, common long, item_words long, answer long, start long, route string"
ROUTES = ("latent", "words")


def search(docs: DataFrame, block: Block, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The items of a block that documents hold: one row per document row and item, at the first stretch that shows it.

    Stretches near the item in the latent space are verified first, then every stretch with as many of the item's rarest words as
    a text that holds it must have. `route` is the one that proposed the finding.
    """
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        own = shared.value
        item_masks = [masks_of(w.tolist()) for w in own.words]
        for batch in batches:
            out = [[] for _ in range(7)]
            routes: list[str] = []
            for words in split_words(batch.column(1)):
                found: dict[tuple[int, int], tuple[int, int, int, int]] = {}
                for route in ROUTES:
                    proposed = near_stretches(own, words) if route == "latent" else zip(*(x.tolist() for x in _stretches(own, words)))
                    for d, item, low, high in proposed:
                        if (d, item) not in found:
                            n = len(own.words[item])
                            common, answer = overlap(n, item_masks[item], words.hash[low:high].tolist())
                            if holds(n, common, answer):
                                found[d, item] = low, high, common, answer
                    routes += [route] * (len(found) + len(out[0]) - len(routes))
                if found:
                    pairs, places = np.array(list(found)), np.array(list(found.values()))
                    cosine = _cosines(own, buckets(words.hash), pairs[:, 1], places[:, 0], places[:, 1])
                    for (d, item), (low, _, common, answer), c in zip(found, found.values(), cosine):
                        values = (words.rows.start + d, own.ids[item], c, common, len(own.words[item]), answer, int(low - words.first[d]))
                        for column, value in zip(out, values):
                            column.append(value)
            ids = batch.column(0).take(pa.array(out[0], pa.int64()))
            columns = [pa.array(c, pa.float64() if k == 1 else pa.int64()) for k, c in enumerate(out[1:])]
            names = ["id", "item_id", "cosine", "common", "item_words", "answer", "start", "route"]
            yield pa.RecordBatch.from_arrays([ids, *columns, pa.array(routes, pa.string())], names=names)

    given = docs.select(docs[id_col].cast("long").alias("id"), _lower(docs, text))
    return given.mapInArrow(run, FOUND)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id") -> DataFrame:
    """(id, item_id, cosine, common, item_words, answer, start, route): the benchmark items that documents hold.

    Every document is searched for every item, the items in blocks of about BLOCK_ITEMS, one scan of the documents each.
    Word statistics cover all documents, and the latent space of a block is fitted on the items and on the passages of all
    documents, in one more scan. What it does not show is proposed by rare words (`rare_words`), so nothing that `holds` is
    left out. Ties: an item is reported at the first stretch of the route that shows it.

    Null or empty texts hold nothing, and null or empty items are held by nothing. A null id is returned as it is. Equal
    rows and equal items each have their rows. Empty tables: empty result.
    """
    spark = docs.sparkSession
    empty = spark.createDataFrame([], FOUND)
    n_docs, frequency = document_frequency(docs, text)
    idf = (np.log((n_docs + 1) / (frequency + 0.5))).clip(0.05).astype(np.float32)
    n_blocks = -(-benchmark.count() // BLOCK_ITEMS)
    passages = docs.select(_lower(docs, text))
    found = empty
    for block_no in range(n_blocks if n_docs else 0):
        mine = benchmark.filter(F.pmod(F.xxhash64(benchmark[item_col], benchmark["text"]), F.lit(n_blocks)) == block_no)
        block = make_block(mine.select(benchmark[item_col].cast("long"), _lower(benchmark, "text")).collect(), idf)
        if block.ids:
            found = found.unionByName(search(docs, fit(block, passages), id_col, text))
    return found


def clean_rows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no benchmark item, with the columns of `docs`.

    A verdict belongs to a text, by which rows are found again: null ids, and ids on several texts, change nothing.
    """
    own = text_of(docs, text)
    keyed = docs.select(F.xxhash64(own).alias("text_key"), own.alias("text"))
    held = stored(contaminated(keyed, benchmark, "text_key").select(F.col("id").alias("__held")).distinct(), "contaminated")
    row = docs.select(F.xxhash64(own).alias("__key"), F.struct(*[docs[c] for c in docs.columns]).alias("__row"))
    return row.join(held, F.col("__key") == F.col("__held"), "left_anti").select("__row.*")


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = stored(contaminated(docs, benchmark), "contamination")
    return found.select(F.col("id").alias("doc_id"), "item_id", "cosine", "common", "item_words", "answer", "start", "route")
