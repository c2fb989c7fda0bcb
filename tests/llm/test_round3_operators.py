"""Packing, source divergence and fill-in-the-middle against brute force, round trips and the tokenizer library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from test_operators_llm import brute_components

from ledgerwatch.llm import decontamination, divergence, fill_middle, near_dup, packing, sharding, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
pieces_of_text = st.lists(st.sampled_from(["a", "Bc", " ", "  ", "\n", "\t ", "é", "ß ", "😀", "<P", "<M>", "S>", "12", " '", "s", "<|endoftext|>", "\xa0", "\x85", "日本", "\0", "it's", "."]), max_size=12)


# --- fill in the middle ----------------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60), st.integers(0, 60), st.integers(0, 60), st.integers(1, 7))
def test_rotation_exchanges_segments(data, a, b, step):
    a, b = sorted((min(a, len(data)), min(b, len(data))))
    block = bytearray(data)
    before, fill_middle.SWAP_BYTES = fill_middle.SWAP_BYTES, step
    try:
        fill_middle.rotate(block, a, b, len(data))
    finally:
        fill_middle.SWAP_BYTES = before
    assert bytes(block) == data[:a] + data[b:] + data[a:b]


@settings(max_examples=300, deadline=None)
@given(pieces_of_text, st.integers(0, 200), st.integers(0, 200), st.sampled_from(["psm", "spm"]))
def test_forms_and_their_inverse(parts, p, m, form):
    text = "".join(parts).encode()
    if any(mark in text for mark in (b"<P>", b"<S>", b"<M>")):
        return
    p, m = sorted((p % (len(text) + 1), m % (len(text) + 1)))
    prefix, middle, suffix = text[:p], text[p:m], text[m:]
    want = b"<P>" + prefix + b"<S>" + suffix + b"<M>" + middle if form == "psm" else b"<S>" + suffix + b"<P>" + prefix + b"<M>" + middle
    out = bytes(fill_middle.transformed(text, p, m, form))
    assert out == want
    assert bytes(fill_middle.inverted(out, form)) == text


def brute_fim(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    h = [int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, form, len(prefix), len(middle), sha(out), sha(text)


def in_order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_fill_in_middle_on_odd_rows(odd, none):
    got = fill_middle.fill_in_middle_report(odd).collect()
    assert in_order(got) == in_order(brute_fim(r.doc_id, r.text) for r in odd.collect())
    assert fill_middle.fill_in_middle_report(none).count() == 0


def test_fill_in_middle_restores_texts_with_sentinels_and_broken_marks(spark):
    texts = ["<P> kept plain", "a <M> b", "<S", "P> <", "\n\n", " x ", "<<P><P>>", "ends with <P", "M> first"]
    docs = spark.createDataFrame([(i, t) for i in range(40) for t in texts], "doc_id long, text string")
    got = fill_middle.fill_in_middle_report(docs).collect()
    assert in_order(got) == in_order(brute_fim(r.doc_id, r.text) for r in docs.collect())
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    text_ids = docs.selectExpr("concat('k', doc_id) AS doc_id", "text")
    back = fill_middle.restored(fill_middle.fill_in_middle(text_ids))
    assert Counter(r.restored for r in back.collect()) == Counter(texts * 40)


# --- source divergence -----------------------------------------------------------------------------------------


def words(n, seed):
    rng = random.Random(seed)
    return sorted({"".join(rng.choices("abcdeé", k=rng.randint(1, 7))).encode() for _ in range(n)})


@pytest.mark.parametrize("n", [0, 1, 2, 50, 3000])
def test_perfect_hash_is_minimal_and_tells_strangers_apart(n):
    terms = words(n, n)
    table = divergence.PerfectHash.of(terms)
    assert sorted(table.slots(terms).tolist()) == list(range(len(terms)))
    strangers = [t + b"z" for t in terms] + [b"q", b""]
    assert (table.slots(strangers) == -1).all()
    again = divergence.PerfectHash(table.levels, table.terms)
    assert len(again) == len(terms) and sorted(map(again.term, range(len(terms)))) == terms
    assert again.slots(terms).tolist() == table.slots(terms).tolist()


def test_perfect_hash_parts_terms_of_equal_hash(monkeypatch):
    monkeypatch.setattr(divergence, "term_hashes", lambda terms: np.array([len(t) for t in terms], np.uint64))
    terms = [b"a", b"b", b"cc", b"ddd", b"eee"]
    table = divergence.PerfectHash.of(terms)
    assert sorted(table.slots(terms).tolist()) == list(range(5))
    assert table.slots([b"x", b"yy", b"zzz", b"wwww"]).tolist() == [-1] * 4


@settings(max_examples=200, deadline=None)
@given(pieces_of_text, st.integers(1, 5))
def test_terms_by_bytes_are_those_of_the_text(parts, piece):
    text = "".join(parts)
    before, divergence.PIECE_BYTES = divergence.PIECE_BYTES, piece
    try:
        got = [t for part in divergence.term_pieces(text.encode()) for t in part]
    finally:
        divergence.PIECE_BYTES = before
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    assert got == [t.encode() for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)]


def brute_divergence(rows, least=3, top=200):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        groups.add((lang, source))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        counts[lang, None].update(terms)
    kept = {lang: sorted(t for t, n in docs[lang].items() if n >= least) for lang, _ in groups}

    def p(lang, source):
        own, terms = counts[lang, source], kept[lang]
        below = sum(own[t] for t in terms) + len(terms)
        return [1 + 10**9 * (own[t] + 1) // below for t in terms]

    out = []
    for lang, source in groups:
        mine = p(lang, source)
        pairs = [(sum((a - b) ** 2 // b for a, b in zip(mine, p(lang, other))), other) for of, other in groups if of == lang and other != source]
        terms = [((a - b) ** 2 // b, t) for t, a, b in zip(kept[lang], mine, p(lang, None)) if counts[lang, source][t] and a > b]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


@pytest.fixture(scope="module")
def talk(spark):
    rng = random.Random(5)
    vocabulary = [w.decode() for w in words(60, 9)] + ["Éa", "Ab", "aB", "😀"]
    rows = []
    for i in range(150):
        weights = [1 + (k * (i % 5)) % 7 for k in range(len(vocabulary))]
        text = " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 40)))
        rows.append((text if i % 17 else None, rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", "s3", None]), 1, 2))
    rows += [("", "xx", "a", 1, 2), (None, "xx", "b", 1, 2), ("only here", "yy", "a", 1, 2)] + [("copy text copy", "en", "hot", 1, 2)] * 40
    return spark.createDataFrame(rows, "text string, lang string, source string, value int, rank int").repartition(5)


@pytest.mark.parametrize("options", [{}, {"shard_terms": 7, "round_bytes": 900, "source_block": 2}])
def test_source_divergence_against_brute_force(talk, options):
    got = sorted(map(tuple, divergence.source_divergence(talk, **options).collect()))
    assert got == brute_divergence((r.text, r.lang, r.source) for r in talk.collect())


def test_source_divergence_hands_slots_on_when_they_are_many(talk, monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH_TERMS", 10)
    monkeypatch.setattr(divergence, "FLUSH_SLOTS", 20)
    got = sorted(map(tuple, divergence.source_divergence(talk).collect()))
    assert got == brute_divergence((r.text, r.lang, r.source) for r in talk.collect())


def test_source_divergence_on_odd_rows(odd, none):
    got = sorted(map(tuple, divergence.source_divergence(odd, least_docs=1).collect()))
    assert got == brute_divergence([(r.text, r.lang, r.source) for r in odd.collect()], least=1)
    assert divergence.source_divergence(none).count() == 0


def test_rates_stay_exact_for_large_counts():
    counts = [0, 1, 10**9, 9 * 10**11]
    below = 10**12 + 12345
    assert divergence.rates(np.array([counts]), np.array([[below]])).tolist() == [[1 + 10**9 * (c + 1) // below for c in counts]]


# --- packing ---------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(BPE)
    return lambda text: own.encode(text, add_special_tokens=False).ids


def ids_of(found):
    return np.frombuffer(found, "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(pieces_of_text)
def test_encoder_equals_the_library(parts):
    text = "".join(parts)
    own = packing.encoder(BPE)
    assert own.fast is not None
    assert ids_of(own.encode(text)) == own.library.encode(text, add_special_tokens=False).ids


def test_encoder_equals_the_library_on_every_character_and_piece():
    own = packing.encoder(BPE)
    pieces = [own.library.decode([i]) for i in range(own.library.get_vocab_size() - 1)]
    rng = random.Random(2)
    texts = pieces + [f"a{chr(c)} b{chr(c)}{chr(c)} 1{chr(c)}' {chr(c)}s" for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(rng.choices(pieces, k=4)) for _ in range(30000)]
    want = own.library.encode_batch_fast(texts, add_special_tokens=False)
    assert [t for t, w in zip(texts, want) if ids_of(own.encode(t)) != w.ids] == []


@pytest.mark.parametrize("text", [" " * 200_000 + "x", "\n" * 200_000, "x" * 200_000, "!?" * 50_000, "a" + " \t" * 50_000])
def test_encoder_on_long_runs(text):
    own = packing.encoder(BPE)
    want = own.library.encode(text, add_special_tokens=False).ids if text[0] != "x" else ids_of(own.encode(text[:80_000])) * 2 + ids_of(own.encode(text[:40_000]))
    assert ids_of(own.encode(text)) == want


def test_other_kinds_of_files_are_encoded_by_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    own = packing.Encoder(path)
    assert own.fast is None
    assert ids_of(own.encode("Some words")) == own.library.encode("Some words", add_special_tokens=False).ids


def whole_and_gapless(rows, want, window=1024):
    """Every document's ids lie in its pieces, once; sequences have no gaps and are at most a window long. `want`: ids by document."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.id].append(r)
        sequences[r.sequence_id].append(r)
        assert r.length == len(ids_of(r.ids)) > 0
    assert docs.keys() == want.keys()
    for name, found in docs.items():
        found.sort(key=lambda r: r.start)
        assert [i for r in found for i in ids_of(r.ids)] == want[name]
        assert [r.start for r in found] == [sum(x.length for x in found[:k]) for k in range(len(found))]
        assert {r.doc_tokens for r in found} == {len(want[name])}
    for found in sequences.values():
        found.sort(key=lambda r: r.offset)
        assert [r.offset for r in found] == [sum(x.length for x in found[:k]) for k in range(len(found))]
        assert sum(r.length for r in found) <= window
    return sequences


def test_packing_of_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4)
    want = {r.doc_id: [*library(r.text), 0] for r in docs.collect()}
    rows = packing.packed(docs, BPE).collect()
    sequences = whole_and_gapless(rows, want)
    short = [s for s in sequences.values() if sum(r.length for r in s) < 1024]
    assert len(short) <= 1 + sum(map(len, want.values())) // packing.SHARD_TOKENS
    report = packing.packing_report(docs, BPE)
    assert report.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for r in report.collect():
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_deals_a_hot_anchor_to_several_shards(spark, library):
    docs = spark.createDataFrame([(i, "same words here " * (i % 9)) for i in range(600)], "doc_id long, text string").repartition(6)
    want = {r.doc_id: [*library(r.text), 0] for r in docs.collect()}
    sequences = whole_and_gapless(packing.packed(docs, BPE, window=64, shard_tokens=500).collect(), want, 64)
    shards = {s - packing.PACKED >> packing.SHARD_BITS for s in sequences if s >= packing.PACKED}
    assert len(shards) > 5
    assert sum(sum(r.length for r in s) < 64 for s in sequences.values()) <= len(shards)


def test_packing_on_odd_rows(odd, none, library):
    numbered = odd.selectExpr("concat(coalesce(doc_id, -1), '/', monotonically_increasing_id()) AS doc_id", "text", "kept", "size").persist()
    want = {r.doc_id: [*library(r.text or ""), 0] for r in numbered.collect()}
    whole_and_gapless(packing.packed(numbered, BPE, window=128).collect(), want, 128)
    rows = packing.packing_report(odd, BPE).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(r.doc_id for r in odd.collect())
    assert packing.packing_report(none, BPE).count() == 0


def brute_bm25(units, seed, docs, n, mean):
    def of(d):
        held, score = Counter(units[d]), 0.0
        for t in sorted(set(units[seed]) & set(held)):
            idf = math.log1p((n - docs[t] + 0.5) / (docs[t] + 0.5))
            score += idf * held[t] * 2.2 / (held[t] + 1.2 * (0.25 + 0.75 * len(units[d]) / mean))
        return score

    return [of(d) for d in range(len(units))]


def test_index_scores_and_greedy_filling():
    rng = random.Random(3)
    units = [np.array(rng.choices(range(40), [1 + k % 9 for k in range(40)], k=rng.randint(1, 30))) for _ in range(60)]
    docs = Counter(t for u in units for t in set(u.tolist()))
    mean = sum(map(len, units)) / len(units)
    weights = packing.Weights(docs, len(units), mean)
    index = packing.Index(units, weights)
    plain = [u.tolist() for u in units]
    for seed in range(0, 60, 7):
        assert np.allclose(index.scores(seed), brute_bm25(plain, seed, docs, len(units), mean))
    found = packing.fill_windows(units, weights, 50)
    left, at, seed = {d: len(u) for d, u in enumerate(units)}, 0, None
    while left:
        seed = min(left) if seed is None else seed
        scores = index.scores(seed)
        order = [seed, *sorted((d for d in left if d != seed), key=lambda d: (-scores[d], d))]
        room, sequence, following = 50, found[at][3], None
        for d in order:
            if not room:
                break
            n = min(room, left[d])
            assert found[at] == (d, len(units[d]) - left[d], n, sequence, 50 - room)
            at, room, left[d] = at + 1, room - n, left[d] - n
            if left[d]:
                following = d
            else:
                del left[d]
        seed = following
    assert at == len(found)


def test_neighbours_share_windows(spark):
    """Documents of one subject, scattered over the input, end up together."""
    rng = random.Random(11)
    subjects = [[f"{name}{k}" for k in range(30)] for name in ("volcano", "ledger", "violin", "harbour")]
    docs = [(i, " ".join(rng.choices(subjects[i % 4], k=40)), i % 4) for i in range(200)]
    rows = packing.packed(spark.createDataFrame(docs, "doc_id long, text string, start int"), BPE, window=512).collect()
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append(r.id % 4)
    alike = sum(Counter(w).most_common(1)[0][1] for w in windows.values()) / sum(map(len, windows.values()))
    assert alike > 0.8


# --- the toxicity machine ----------------------------------------------------------------------------------------


def by_rules(grammar, tokens):
    """The patterns of a clause by looking around every insult or threat."""
    out = np.zeros(6)
    classes = [toxicity.word_class(t) for t in tokens]
    for k, token in enumerate(tokens):
        threat = token in toxicity.THREATS
        weight = 1.0 if threat else grammar.insult(token)
        if weight <= 0:
            continue
        back = lambda c, n: c in classes[max(0, k - n) : k + 1]
        targeted = back(toxicity.TARGET, toxicity.TARGET_REACH) or toxicity.TARGET in classes[k : k + toxicity.TARGET_REACH + 1]
        if back(toxicity.NEGATION, toxicity.NEGATION_REACH):
            out[2] += weight
        elif toxicity.REPORT in classes[: k + 1]:
            out[3] += weight
        else:
            out[4 * threat + targeted] += weight
    return out


def test_composed_machine_equals_looking_around():
    grammar = toxicity.Grammar({"idiot": 1.5, "moro*": 0.5, "you": 0.25})
    rng = random.Random(9)
    for _ in range(3000):
        tokens = rng.choices(["idiot", "morons", "kill", "you", "not", "said", '"', "a", "b", "c"], [2, 1, 1, 2, 1, 1, 1, 4, 4, 4], k=rng.randint(0, 14))
        assert grammar.clause(tokens).tolist() == by_rules(grammar, tokens).tolist(), tokens


def test_composition_runs_both_machines():
    a, b = toxicity.within(toxicity.NEGATION, 2), toxicity.since(toxicity.REPORT)
    both = toxicity.compose(a, b)
    assert len(both.arcs) == len(a.arcs) * len(b.arcs) and 30 < len(toxicity.MACHINE.arcs) <= 5 * 2 * 6
    rng = random.Random(2)
    for _ in range(200):
        classes = rng.choices(range(4), k=12)
        got = [both.output[s] for s in both.states(classes)]
        assert got == [a.output[x] + b.output[y] for x, y in zip(a.states(classes), b.states(classes))]


# --- rows of one id, null ids, and the pipeline ------------------------------------------------------------------


def test_deduplication_loses_no_text(spark):
    a, b, c = (" ".join(f"{w}{k}" for k in range(30)) for w in ("alpha", "one", "red"))
    near_b = b.replace("one0 ", "other ")
    rows = [(5, a), (5, b), (6, b), (7, near_b), (None, c), (None, c), (None, b), (8, "  "), (9, None), (None, ""), (5, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in near_dup.deduplicated(docs).collect()]
    assert in_order(kept) == in_order([(5, a), (5, b), (None, c), (8, "  "), (9, None), (None, "")])
    found = {(r.id, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()}
    assert found == {(5, 5, True), (6, 5, False), (7, 5, False), (None, None, True), (None, 5, False), (8, 8, True), (9, 9, True)}


def test_near_duplicates_with_a_hot_id_and_copies(spark):
    base = [f"w{k}" for k in range(40)]
    rows = [(1, " ".join(base)) for _ in range(300)] + [(1, " ".join(base[:-1] + [f"x{n}"])) for n in range(100)] + [(n, f"only {n} " * 9) for n in range(2, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    kept = near_dup.deduplicated(docs, k=2).collect()
    assert sum(r.text.startswith("w0") for r in kept) == 1
    assert near_dup.near_duplicates(docs, k=2).filter("component_id = 1").count() == 400


def test_dense_sets_are_found_without_hubs_too(spark, monkeypatch):
    """Groups of texts about one base, at 0.8 to its neighbours and 0.2 to 0.7 to most others, in nodes that are large."""
    rng = random.Random(1)
    base = [f"b{k}" for k in range(60)]
    docs, i = [], 0
    for group in range(60):
        own = base[:20] + [f"g{group}_{k}" for k in range(80)]
        for _ in range(6):
            text = list(own)
            for at in rng.sample(range(20, 100), 3):
                text[at] = f"z{rng.randrange(10**9)}"
            docs.append((i, " ".join(text)))
            i += 1
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = brute_components(docs, 2)
    pairs = Counter(want.values())
    for alike in (near_dup.ALIKE, -1):
        monkeypatch.setattr(near_dup, "ALIKE", alike)
        got = {r.id: r.component_id for r in near_dup.near_duplicates(df, k=2).collect()}
        joined = sum(got[d] == got[want[d]] for d in want if d != want[d])
        assert joined >= 0.99 * sum(n - 1 for n in pairs.values())
        assert all(want[d] == want[got[d]] for d in want)


def test_clean_rows_go_by_text(spark):
    item = " ".join(f"bench{k}" for k in range(20))
    rows = [(None, f"before {item} after"), (None, f"once more {item}"), (None, "clean words only here"), (5, item), (5, "a clean text of five")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.text for r in decontamination.clean_rows(docs, benchmark).collect()) == ["a clean text of five", "clean words only here"]


def paraphrased(rng, words, keep, pool):
    """The words in order, a share of them kept and others put in their places; the last five stay."""
    return [w if k >= len(words) - 5 or rng.random() < keep else rng.choice(pool) for k, w in enumerate(words)]


def test_latent_search_proposes_what_is_found(spark, monkeypatch):
    rng = random.Random(4)
    pool = [f"v{k}" for k in range(4000)]
    items = [(k, " ".join(rng.choices(pool[: 400 + 8 * k], k=rng.randint(20, 60)))) for k in range(60)]
    docs, held = [], set()
    for i in range(400):
        text = rng.choices(pool, k=rng.randint(60, 200))
        if i % 3 == 0:
            k = rng.randrange(60)
            at = rng.randrange(len(text))
            text[at:at] = paraphrased(rng, items[k][1].split(), rng.choice([0.75, 0.85, 1.0]), pool)
            held.add((i, k))
        docs.append((i, " ".join(text)))
    documents = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    both = decontamination.contaminated(documents, benchmark).collect()
    found = {(r.id, r.item_id): r.route for r in both}
    assert held & set(found) == {p for p in held if p in found} and len(held & set(found)) > 0.95 * len(held)
    true = [found[p] for p in held if p in found]
    assert true.count("latent") >= 0.9 * len(true)
    words = {(r.id, r.item_id) for r in both}
    for route in decontamination.ROUTES:  # each route alone: the latent one finds its share, the exact one all
        monkeypatch.setattr(decontamination, "near_stretches", (lambda *a: []) if route == "words" else NEAR)
        monkeypatch.setattr(decontamination, "_stretches", STRETCHES if route == "words" else (lambda *a: (np.zeros(0, int),) * 4))
        block = decontamination.make_block(items, np.ones(decontamination.BUCKETS, np.float32))
        alone = searched(decontamination.fit(block, documents.select("text")), docs)
        assert len(alone & words & held) >= (1.0 if route == "words" else 0.9) * len(words & held)


def gram(block, texts):
    """A'A of the TF-IDF passages of texts, and their number, row by row."""
    import pyarrow as pa

    rows = []
    for words in decontamination.split_words(pa.array(texts)):
        at = decontamination.buckets(words.hash)
        for first, last in zip(*decontamination.passage_starts(words)):
            row = np.zeros(block.n_columns)
            for k in at[first:last]:
                if block.column[k] >= 0:
                    row[block.column[k]] += block.idf[k]
            rows.append(row)
    rows = np.array(rows)
    return rows.T @ rows, len(rows)


@pytest.mark.parametrize("most", [decontamination.MOST_COLUMNS, 10])
def test_latent_space_is_that_of_all_documents(spark, monkeypatch, most):
    """With as many dimensions as words the space keeps A'A of all passages; a fit on some of them cannot, and no text is left out."""
    monkeypatch.setattr(decontamination, "MOST_COLUMNS", most)
    rng = random.Random(3)
    pool = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choices(pool, k=30))) for k in range(5)]
    texts = [" ".join(rng.choices([*pool, *(f"x{k}" for k in range(60))], k=rng.randint(0, 90))) for _ in range(700)]
    idf = np.random.default_rng(1).uniform(0.5, 2, decontamination.BUCKETS).astype(np.float32)
    block = decontamination.make_block(items, idf)
    seen = []
    product = np.linalg.svd
    monkeypatch.setattr(np.linalg, "svd", lambda m, **k: seen.append(m) or product(m, **k))
    decontamination.fit(block, spark.createDataFrame([(t,) for t in texts], "text string").repartition(5))
    own, n = gram(block, texts)
    at, starts, ends, _ = decontamination.item_windows(block)
    windows = block.project(at, starts, ends, np.eye(block.n_columns, dtype=np.float32)).astype(float)
    want = own + n / len(starts) * windows.T @ windows
    assert seen[0] @ seen[0].T == pytest.approx(want, rel=1e-3, abs=1e-3 * want.max())


NEAR, STRETCHES = decontamination.near_stretches, decontamination._stretches


def searched(block, docs):
    """The pairs that the routes as they are now propose and that hold, in this process."""
    import pyarrow as pa

    masks = [decontamination.masks_of(w.tolist()) for w in block.words]
    out = set()
    for words in decontamination.split_words(pa.array([t for _, t in docs])):
        proposed = decontamination.near_stretches(block, words) + list(zip(*(x.tolist() for x in decontamination._stretches(block, words))))
        for d, item, low, high in proposed:
            n = len(block.words[item])
            if decontamination.holds(n, *decontamination.overlap(n, masks[item], words.hash[low:high].tolist())):
                out.add((docs[words.rows.start + d][0], block.ids[item]))
    return out


def test_sharding_with_maps_and_clashing_names(spark):
    rows = [(k % 3, f"text {k % 3}" * 20, {"a": str(k % 2)}, [{"b": k % 2}]) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, about map<string,string>, more array<map<string,int>>")
    got = sharding.shard(docs, 500)
    assert got.select(docs.columns).count() == 40 and {tuple(sorted(r.about.items())) for r in got.collect()} == {(("a", "0"),), (("a", "1"),)}
    assert max(r.shard_bytes for r in got.collect()) <= 500


def test_pipeline_on_odd_and_empty_input(spark, odd, none, tmp_path):
    import corpus_pipeline

    item = " ".join(f"bench{k}" for k in range(20))
    folder = str(tmp_path / "data")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    long_text = " ".join(f"word{k}" for k in range(30))
    extra = spark.createDataFrame([(None, f"{long_text} {n}" + (f" {item}" if n == 2 else ""), "en", None, False, n) for n in range(3)], odd.schema)
    for name, docs in (("odd", odd.unionByName(extra).withColumn("shard", F.lit("x"))), ("none", none)):
        docs.write.parquet(f"{folder}/{name}.parquet")
        read = spark.read.parquet(f"{folder}/{name}.parquet")
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, read, folder).write.parquet(f"{folder}/{name}-{k}")
            read = spark.read.parquet(f"{folder}/{name}-{k}")
        assert [c for c in read.columns if c in docs.columns] == docs.columns
        if name == "none":
            assert read.count() == 0
            continue
        texts = {r.text for r in read.collect()}
        assert all(item not in t for t in texts) and any(t.startswith(long_text) for t in texts)
        assert sum(t.startswith("One two three") for t in texts) == 1 and "" not in texts
