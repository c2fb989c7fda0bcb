"""How far the sources of a language differ in their words: exact counts by a second pass over minimal perfect hashes."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.store import stored, text_of
from ledgerwatch.llm.words import mix

LEAST_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
# Fixed value: a term is a run of ASCII letters and characters beyond ASCII; in UTF-8 all bytes of the latter are over 0x7F.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
# Bytes of terms with A-Z as a-z, all others as spaces.
SPELLING = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PIECE_BYTES = 1 << 20
FLUSH_TERMS = 400_000
FLUSH_SLOTS = 24_000_000
FLUSH_WORDS = 1 << 30
SHARD_TERMS = 8192
ROUND_BYTES = 64 << 20
SOURCE_BLOCK = 128
LEVEL_STEP = 0x9E3779B97F4A7C15


def term_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, A-Z as a-z, in lists from pieces of about PIECE_BYTES that end between terms."""
    at = 0
    while at < len(text):
        end = min(at + PIECE_BYTES, len(text))
        rest = TERM.match(text, end)
        end = rest.end() if rest else end
        yield text[at:end].translate(SPELLING).split()
        at = end


def _texts(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def _groups(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """lang, source, text as strings, null as ''."""
    said = lambda c: F.coalesce(docs[c].cast("string"), F.lit("")).alias
    return docs.select(said(lang)("lang"), said(source)("source"), text_of(docs, text).alias("text"))


# --- first pass: exact frequency filtering ---------------------------------------------------------------------


def document_counts(given: DataFrame) -> DataFrame:
    """(lang, term, docs): documents of the language that hold the term, summed in each task before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, terms in found.items():
                term = pa.array(list(terms), pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.string()), term, pa.array(list(terms.values()), pa.int64())], names=["lang", "term", "docs"])
            found.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                own: set[bytes] = set()
                for piece in term_pieces(text):
                    own.update(piece)
                found.setdefault(lang, Counter()).update(own)
                if sum(map(len, found.values())) > FLUSH_TERMS:
                    yield from flush()
        yield from flush()

    partial = given.select("lang", "text").mapInArrow(run, "lang string, term string, docs long")
    return partial.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


# --- minimal perfect hashes ------------------------------------------------------------------------------------


def term_hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """A hash of the level below `size` for each key."""
    return (mix(keys + np.uint64(level * LEVEL_STEP % 2**64)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash of distinct terms: each has one of the slots 0 .. n-1, and no slot is left over.

    A level is a bit map of about twice as many bits as keys are left; a key that is alone at its bit is settled there, the
    others go on to the next level. A slot is the number of set bits before a term's own. Terms that share all 64 bits of
    their hash can never part; they stand in the last slots and are looked up as they are. The terms themselves stand at
    their slots, so a term that is not one of them is told apart from the one whose slot it hits.
    """

    def __init__(self, levels: list[np.ndarray], terms: bytes):
        """From the bit map of each level, and the terms in the order of their slots with a line feed after each."""
        self.levels, self.terms = levels, terms
        self.ends = np.flatnonzero(np.frombuffer(terms, np.uint8) == 10)
        self.begins = np.append(0, self.ends[:-1] + 1) if len(self.ends) else self.ends
        before = np.cumsum([0, *[int(bits.sum()) for bits in levels]])
        self.ranks = [before[k] + np.cumsum(bits) - bits for k, bits in enumerate(levels)]
        self.twins = {self.term(slot): slot for slot in range(int(before[-1]), len(self))}

    def __len__(self) -> int:
        return len(self.ends)

    def term(self, slot: int) -> bytes:
        return self.terms[self.begins[slot] : self.ends[slot]]

    @classmethod
    def of(cls, terms: list[bytes]) -> PerfectHash:
        keys = term_hashes(terms)
        same = Counter(keys.tolist())
        twins = [t for t, k in zip(terms, keys.tolist()) if same[k] > 1]
        left = np.array([k for k in keys.tolist() if same[k] == 1], np.uint64)
        levels = []
        while len(left):
            place = _place(left, len(levels), 2 * len(left) + 1)
            levels.append(np.bincount(place, minlength=2 * len(left) + 1) == 1)
            left = left[~levels[-1][place]]
        placed = [b""] * (len(terms) - len(twins)) + twins
        blank = cls(levels, b"".join(t + b"\n" for t in placed))
        for term, slot in zip(terms, blank.probe(terms, keys).tolist()):
            placed[slot] = term
        return cls(levels, b"".join(t + b"\n" for t in placed))

    def probe(self, terms: list[bytes], keys: np.ndarray) -> np.ndarray:
        """A slot for every term, or -1; terms that are not in the set may get one too."""
        slots = np.full(len(keys), -1, np.int64)
        waiting, left = np.arange(len(keys)), keys
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            place = _place(left, level, len(bits))
            hit = bits[place]
            slots[waiting[hit]] = ranks[place[hit]]
            waiting, left = waiting[~hit], left[~hit]
        if self.twins:
            slots = np.array([self.twins.get(t, s) for t, s in zip(terms, slots.tolist())], np.int64)
        return slots

    def slots(self, terms: list[bytes], keys: np.ndarray | None = None) -> np.ndarray:
        """The slot of each term, or -1 where the term stored at its slot is another."""
        found = self.probe(terms, term_hashes(terms) if keys is None else keys)
        if not len(self):
            return found
        begins, ends, own = self.begins[found].tolist(), self.ends[found].tolist(), self.terms
        same = np.fromiter((own[b:e] == t for t, b, e in zip(terms, begins, ends)), bool, len(terms))
        return np.where(same & (found >= 0), found, -1)


def bucket_of(keys: np.ndarray, buckets: np.ndarray | int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.asarray(buckets, np.uint64)).astype(np.int32)


_SHARD_TYPES = pa.schema(
    [
        ("lang", pa.string()),
        ("bucket", pa.int32()),
        ("buckets", pa.int32()),
        ("n_terms", pa.int32()),
        ("kept", pa.int64()),
        ("level_bits", pa.list_(pa.int32())),
        ("levels", pa.list_(pa.binary())),
        ("terms", pa.binary()),
    ]
)
SHARD = "lang string, bucket int, buckets int, n_terms int, kept long, level_bits array<int>, levels array<binary>, terms binary"


def shards(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """(lang, bucket, buckets, n_terms, kept, level_bits, levels, terms): the kept terms of a language in buckets of their hash, each
    bucket with the bit maps of its perfect hash and its terms in the order of their slots.

    `kept` has (lang, term). A language has as many buckets as its terms need, so a bucket has about `shard_terms`.
    """
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    counted = kept.join(sizes, "lang").select("lang", "term", "kept", F.ceil(F.col("kept") / shard_terms).cast("int").alias("buckets"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = term_hashes(batch.column(1).view(pa.binary()).to_pylist())
            bucket = bucket_of(keys, batch.column(3).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket)], names=[*batch.schema.names, "bucket"])

    def build(table: pa.Table) -> pa.Table:
        own = PerfectHash.of(sorted(table.column("term").cast(pa.binary()).to_pylist()))
        row = {c: [table.column(c)[0].as_py()] for c in ("lang", "bucket", "buckets", "kept")}
        row |= {"n_terms": [len(own)], "level_bits": [[len(b) for b in own.levels]], "levels": [[np.packbits(b).tobytes() for b in own.levels]], "terms": [own.terms]}
        return pa.table([pa.array(row[f.name], f.type) for f in _SHARD_TYPES], schema=_SHARD_TYPES)

    dealt = counted.mapInArrow(deal, "lang string, term string, kept long, buckets int, bucket int")
    return dealt.groupBy("lang", "bucket").applyInArrow(build, SHARD)


# --- second pass: dense slots ----------------------------------------------------------------------------------

COUNT = "lang string, whole boolean, source string, bucket int, n_terms int, total long, slots array<int>, amounts array<long>"
_COUNT_NAMES = ["lang", "whole", "source", "bucket", "n_terms", "total", "slots", "amounts"]


class Lexicon:
    """The loaded terms of one language: a term's code is the first slot of its bucket and its slot there."""

    def __init__(self, tables: dict[int, PerfectHash], buckets: int):
        self.tables, self.buckets = dict(sorted(tables.items())), buckets
        self.sizes = [len(t) for t in self.tables.values()]
        self.first = np.cumsum([0, *self.sizes])
        self.known: dict[bytes, int] = {}

    def codes(self, terms: list[bytes]) -> np.ndarray:
        """The code of each term, -1 for terms that are not loaded. Each term is probed once, while the memory of codes is small."""
        if len(self.known) > FLUSH_TERMS:
            self.known.clear()
        known = self.known
        fresh = [t for t in terms if t not in known]
        if fresh:
            keys = term_hashes(fresh)
            bucket = bucket_of(keys, self.buckets)
            found = np.full(len(fresh), -1, np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
            for first, (b, table) in zip(self.first, self.tables.items()):
                mine = order[edges[b] : edges[b + 1]]
                slots = table.slots([fresh[i] for i in mine.tolist()], keys[mine])
                found[mine] = np.where(slots >= 0, first + slots, -1)
            known.update(zip(fresh, found.tolist()))
        return np.fromiter(map(known.__getitem__, terms), np.int64, len(terms))

    def rows(self, lang: str, source: str | None, dense: np.ndarray) -> pa.RecordBatch:
        """A row for each bucket with counts: its slots that are not zero, and their counts."""
        at = np.flatnonzero(dense)
        edges = np.searchsorted(at, self.first)
        held = np.flatnonzero(np.diff(edges))
        n, amounts = len(held), dense[at].astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(amounts)])
        bounds = pa.array(np.append(edges[held], edges[-1]).astype(np.int32))
        slots = at - np.repeat(self.first[:-1], np.diff(edges))
        buckets = np.array(list(self.tables), np.int32)
        columns = [
            pa.repeat(pa.scalar(lang, pa.string()), n),
            pa.repeat(pa.scalar(source is None), n),
            pa.repeat(pa.scalar(source or "", pa.string()), n),
            pa.array(buckets[held]),
            pa.array(np.array(self.sizes, np.int32)[held]),
            pa.array(sums[edges[held + 1]] - sums[edges[held]]),
            pa.ListArray.from_arrays(bounds, pa.array(slots.astype(np.int32))),
            pa.ListArray.from_arrays(bounds, pa.array(amounts)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=_COUNT_NAMES)


_last: dict[str, dict[str, Lexicon]] = {}


def _loaded(name: str, shared: Broadcast) -> dict[str, Lexicon]:
    """The lexicons of a broadcast by language. A worker keeps the last ones."""
    if name not in _last:
        tables: dict[str, dict[int, PerfectHash]] = {}
        for r in shared.value:
            levels = [np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool) for n, bits in zip(r["level_bits"], r["levels"])]
            tables.setdefault(r["lang"], {})[r["bucket"]] = PerfectHash(levels, bytes(r["terms"]))
        buckets = {r["lang"]: r["buckets"] for r in shared.value}
        _last.clear()
        _last[name] = {lang: Lexicon(own, buckets[lang]) for lang, own in tables.items()}
    return _last[name]


def counts_of_shards(given: DataFrame, rows: list) -> DataFrame:
    """Occurrences of the terms of some shards in each group and in each whole language, from one scan of the documents.

    The shards (bounded by `ROUND_BYTES`) are broadcast. A task adds to one dense array of slots for each group it meets, and
    hands them on when they are more than FLUSH_SLOTS.
    """
    name = uuid.uuid4().hex
    shared = given.sparkSession.sparkContext.broadcast([r.asDict() for r in rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _loaded(name, shared)
        dense: dict[tuple[str, str | None], np.ndarray] = {}
        pending: dict[tuple[str, str], Counter] = {}

        def settle() -> None:
            for (lang, source), words in pending.items():
                codes = own[lang].codes(list(words))
                amounts = np.fromiter(words.values(), np.int64, len(words))
                known = codes >= 0
                for group in ((lang, source), (lang, None)):
                    if group not in dense:
                        dense[group] = np.zeros(own[lang].first[-1], np.int32)
                    dense[group][codes[known]] += amounts[known].astype(np.int32)
            pending.clear()

        def hand_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), held in dense.items():
                yield own[lang].rows(lang, source, held)
            dense.clear()

        waiting, words_held = 0, 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _texts(batch.column(2))):
                if lang not in own:
                    continue
                words = pending.setdefault((lang, source), Counter())
                for piece in term_pieces(text):
                    waiting -= len(words)
                    words.update(piece)
                    waiting += len(words)
                    words_held += len(piece)
                    if waiting > FLUSH_TERMS:
                        settle()
                        words = pending.setdefault((lang, source), Counter())
                        waiting = 0
                        if words_held > FLUSH_WORDS or sum(map(len, dense.values())) > FLUSH_SLOTS:
                            yield from hand_on()
                            words_held = 0
        settle()
        yield from hand_on()

    return given.mapInArrow(run, COUNT)


def merged(partial: DataFrame) -> DataFrame:
    """One row per (lang, whole, source, bucket) from those of the tasks. Rows of a key stream past a single dense array."""
    key = ("lang", "whole", "source", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, dense = None, np.zeros(0, np.int64)

        def row() -> pa.RecordBatch:
            lang, whole, source, bucket, n_terms = last
            at = np.flatnonzero(dense)
            values = [lang, whole, source, bucket, n_terms, int(dense.sum()), at.astype(np.int32), dense[at]]
            kinds = (pa.string(), pa.bool_(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=_COUNT_NAMES)

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in range(5))))
            edges, slots, amounts = batch.column(6).offsets.to_numpy(), batch.column(6).values.to_numpy(), batch.column(7).values.to_numpy()
            for k, (begin, end) in zip(keys, zip(edges, edges[1:])):
                if k != last:
                    if last is not None:
                        yield row()
                    last, dense = k, np.zeros(k[4], np.int64)
                dense[slots[begin:end]] += amounts[begin:end]
        if last is not None:
            yield row()

    return partial.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, COUNT)


def recount(given: DataFrame, shard: DataFrame, round_bytes: int) -> DataFrame:
    """Counts of all kept terms in all groups. Shards are broadcast in rounds of at most `round_bytes` (a single shard if that
    is larger), each round a scan of the documents: memory is bounded for any vocabulary, whose size decides the rounds."""
    turns: list[list] = [[]]
    held = 0
    sizes = shard.select("lang", "bucket", (F.octet_length("terms") + 24 * F.col("n_terms")).alias("bytes"))
    for row in sizes.orderBy("lang", "bucket").toLocalIterator():
        if turns[-1] and held + row.bytes > round_bytes:
            turns.append([])
            held = 0
        turns[-1].append((row.lang, row.bucket))
        held += row.bytes
    out = None
    for turn in turns:
        rows = []
        if turn:
            within = F.struct("lang", "bucket").between(_key(turn[0]), _key(turn[-1]))
            rows = shard.filter(within).select("lang", "bucket", "buckets", "level_bits", "levels", "terms").collect()
        part = stored(merged(counts_of_shards(given, rows)), "slot-counts")
        out = part if out is None else out.unionByName(part)
    return out


def _key(place: tuple[str, int]) -> Column:
    return F.struct(F.lit(place[0]).alias("lang"), F.lit(place[1]).cast("int").alias("bucket"))


# --- figures ---------------------------------------------------------------------------------------------------


def rates(counts: np.ndarray, below: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / below), in steps of a thousand so that no product leaves 64 bits."""
    value, rest = np.zeros_like(counts), counts + 1
    for _ in range(3):
        whole, rest = np.divmod(rest * 1000, below)
        value = value * 1000 + whole
    return value + 1


LEFT, RIGHT, WHOLE = 0, 1, 2
VALUE = "lang string, source string, part string, item string, value long"
_VALUE_TYPES = pa.schema([(c, pa.int64() if c == "value" else pa.string()) for c in ("lang", "source", "part", "item", "value")])


def _dense(table: pa.Table, rows: np.ndarray, n_terms: int) -> np.ndarray:
    out = np.zeros((len(rows), n_terms), np.int64)
    slots, amounts = (table.column(c).combine_chunks() for c in ("slots", "amounts"))
    for k, row in enumerate(rows.tolist()):
        if slots[row].values is not None:
            out[k, slots[row].values.to_numpy()] = amounts[row].values.to_numpy()
    return out


def values_of_shards(counts: DataFrame, groups: DataFrame, langs: DataFrame, shard: DataFrame, top: int) -> DataFrame:
    """(lang, source, part, item, value): the sum of f over a shard's terms for every ordered pair of sources (part pair), and the
    shard's `top` terms of every source (part term).

    The unit of work is a shard and two blocks of sources: their dense slots are two matrices of bounded size. `groups` has
    (lang, source, total, mine), `langs` (lang, kept, total, blocks).
    """
    units = shard.select("lang", "bucket", "n_terms", "terms")
    bare = langs.filter("kept = 0").select("lang", F.lit(0).alias("bucket"), F.lit(0).alias("n_terms"), F.lit(b"").alias("terms"))
    units = units.unionByName(bare)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    sizes = langs.select("lang", "kept", "blocks")
    cells = groups.join(sizes, "lang").join(units.drop("terms"), "lang")
    cells = cells.join(counts.filter("not whole").select("lang", "source", "bucket", "slots", "amounts"), ["lang", "source", "bucket"], "left")
    cells = cells.select("*", other).withColumn("terms", F.lit(None).cast("binary"))
    side = lambda role, a, b: F.struct(F.lit(role).alias("role"), F.col(a).alias("a"), F.col(b).alias("b"))
    cells = cells.withColumn("side", F.explode(F.array(side(LEFT, "mine", "other"), side(RIGHT, "other", "mine"))))
    whole = units.join(counts.filter("whole").select("lang", "bucket", "slots", "amounts"), ["lang", "bucket"], "left").join(langs, "lang")
    whole = whole.select("*", other).withColumns({"side": side(WHOLE, "other", "other"), "source": F.lit("")})
    names = ("lang", "bucket", "side.a", "side.b", "side.role", "source", "kept", "total", "n_terms", "slots", "amounts", "terms")

    def compare(table: pa.Table) -> pa.Table:
        lang, n_terms, kept = (table.column(c)[0].as_py() for c in ("lang", "n_terms", "kept"))
        role, total, source = table.column("role").to_numpy(), table.column("total").to_numpy(), table.column("source").to_pylist()

        def of(wanted: int) -> tuple[list[str], np.ndarray, np.ndarray]:
            rows = np.flatnonzero(role == wanted)
            counted = _dense(table, rows, n_terms)
            return [source[r] for r in rows], counted, rates(counted, np.maximum(1, total[rows] + kept)[:, None])

        (ours, n, p), (others, _, q) = of(LEFT), of(RIGHT)
        out = []
        for k, name in enumerate(ours):
            gap = p[k] - q
            found = (gap * gap // q).sum(axis=1)
            out += [(lang, name, "pair", item, int(found[j])) for j, item in enumerate(others) if item != name]
        if (role == WHOLE).any() and n_terms:
            spelling = table.column("terms")[int(np.flatnonzero(role == WHOLE)[0])].as_py().split(b"\n")
            mean = of(WHOLE)[2][0]
            for k, name in enumerate(ours):
                at = np.flatnonzero((n[k] > 0) & (p[k] > mean))
                gap = p[k][at] - mean[at]
                found = gap * gap // mean[at]
                if len(at) > top:  # ties with the last one stay, as the spelling decides between them
                    keep = found >= np.partition(found, len(at) - top)[len(at) - top]
                    at, found = at[keep], found[keep]
                best = sorted(zip((-found).tolist(), (spelling[i] for i in at.tolist())))[:top]
                out += [(lang, name, "term", item.decode(), -value) for value, item in best]
        columns = list(zip(*out)) if out else [()] * 5
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, _VALUE_TYPES)], schema=_VALUE_TYPES)

    work = cells.select(*names).unionByName(whole.select(*names))
    return work.groupBy("lang", "bucket", "a", "b").applyInArrow(compare, VALUE)


def source_divergence(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    shard_terms: int = SHARD_TERMS,
    round_bytes: int = ROUND_BYTES,
    source_block: int = SOURCE_BLOCK,
) -> DataFrame:
    """lang, source, part, item, value, rank: the distance of each source from the others of its language (part pair), and
    the terms it uses more often than its language (part term).

    A language keeps the terms that stand in at least `least_docs` of its documents. With p and q the smoothed shares of a
    kept term in billionths, the term adds floor((p - q)^2 / q). The first pass counts documents exactly, the second counts
    occurrences in dense slots of minimal perfect hashes.

    Null text, lang, source: as ''. Empty texts: a group without terms, which still has its pairs. Repeated rows: each is a
    document. Ties in value: by the item's UTF-8 bytes. Very long texts are read whole, in pieces. Empty input: empty result.
    Other columns of `docs` are not read, whatever their names.
    """
    given = _groups(docs, text, lang, source)
    kept = document_counts(given).filter(F.col("docs") >= least_docs).select("lang", "term")
    shard = stored(shards(stored(kept, "kept-terms"), shard_terms), "term-shards")
    counts = recount(given, shard, round_bytes)
    totals = counts.filter("not whole").groupBy("lang", "source").agg(F.sum("total").alias("total"))
    groups = given.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").na.fill(0, ["total"])
    groups = stored(groups, "source-totals")
    sizes = shard.groupBy("lang").agg(F.max("kept").alias("kept"))
    blocks = F.ceil(F.count(F.lit(1)) / source_block).cast("int").alias("blocks")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("total"), blocks).join(sizes, "lang", "left").na.fill(0, ["kept"])
    langs = stored(langs, "language-totals")
    mine = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("mine")
    groups = groups.join(langs.select("lang", "blocks"), "lang").select("lang", "source", "total", mine)
    found = stored(values_of_shards(counts, groups, langs, shard, top), "shard-values")
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = found.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
