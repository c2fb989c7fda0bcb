"""Operators that SQL cannot state, against brute force, and all operators on odd input."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import (
    components,
    decontamination,
    language_model,
    line_quality,
    mixing,
    near_dup,
    quality_rules,
    secrets,
    sharding,
    token_counts,
    toxicity,
)

WORD = re.compile("[^\x20\x09-\x0d]+")
DATA = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text, k):
    w = words(text)
    return frozenset(zip(*[w[i:] for i in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(docs, k):
    sets = {i: shingle_set(t, k) for i, t in docs}
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            same, total = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * same >= 80 * total:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    rng = np.random.default_rng(3)
    base = [f"w{n}" for n in rng.integers(0, 5000, 300)]
    for n in range(60):  # one group of near-copies around a text, some of them too far from it
        own = list(base)
        for at in rng.integers(0, 300, int(rng.integers(1, 25))):
            own[at] = f"x{rng.integers(0, 10**6)}"
        docs.append((100_000 + n, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.id: r for r in near_dup.near_duplicates(df, k=k).collect()}
    want = brute_components(docs, k)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == want[i]) and r.n_shingles == len(shingle_set(dict(docs)[i], k)) for i, r in got.items())


def test_hubs_reach_sets_near_the_rim(spark):
    """Set 1 is alike to the pivot 0 and stops; sets 2 and 3 are too far from the pivot, but not from set 1."""
    bits = lambda a, b: sum(1 << k for k in range(a, b))
    alike, far = near_dup.ALIKE, near_dup.FAR
    rows = [(0, 0), (1, bits(0, alike)), (2, bits(0, far + 1)), (3, bits(0, far + alike))] + [(n, 0) for n in range(10, 60)]
    tokens = list(range(near_dup.COORDINATES))
    sets = spark.createDataFrame([(i, 100, tokens, b, 0) for i, b in rows], "id long, size int, tokens array<int>, bits_a long, bits_b long")
    hub = {(r.pivot, r.id): r.ring for r in near_dup.leaves(sets, 80)[1].collect()}
    assert hub[0, 1] is False and hub[0, 2] is True and hub[0, 3] is True


def test_far_sketches_are_no_likelier_than_the_recall_allows():
    n, p = near_dup.COORDINATES, (1 - near_dup.SIMILAR_PERCENT / 100) / 2
    beyond = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(near_dup.FAR + 1, n + 1))
    assert n == 128 and beyond < 0.2 * (1 - near_dup.RECALL)
    # the sketches of sets behave so: 400 pairs at similarity 0.8
    rng, far = np.random.default_rng(6), []
    for _ in range(400):
        both = rng.integers(1, 2**63, 900, dtype=np.uint64)
        a, b = (near_dup.mix(near_dup.minwise(x)) & np.uint64(1) for x in (both[:810], both[90:]))
        far.append(int((a != b).sum()))
    assert abs(np.mean(far) - 12.8) < 1 and max(far) <= near_dup.FAR


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 130)}, 200: 200, 300: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_on_odd_input(spark, odd, none):
    rows = near_dup.near_duplicates(odd, k=2).collect()
    assert len(rows) == odd.count()
    by_id = {r.id: r for r in rows if r.id is not None}
    assert by_id[5].component_id == 4 and not by_id[5].kept and by_id[4].kept
    assert by_id[0].n_shingles == by_id[1].n_shingles == by_id[2].n_shingles == 0
    assert [(r.component_id, r.kept) for r in rows if r.id is None] == [(None, True)]
    assert near_dup.near_duplicates(none).count() == 0
    kept = near_dup.deduplicated(odd, k=2)
    assert kept.columns == odd.columns and kept.filter("doc_id = 4").count() == 1 and kept.filter("doc_id = 5").count() == 0


@pytest.fixture(scope="module")
def model_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_every_prefix_equals_the_library(spark, odd, none, model_path):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    texts = {r.doc_id: (r.text or "")[:400] for r in odd.filter("doc_id is not null").collect()}
    texts |= {1000 + r.doc_id: r.text[:600] for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(25).collect()}
    texts |= {2000: "  a  b \n\n c\t<s>▁x ▁", 2001: "don't 123456 ŒßÅ ａ 一二三", 2002: "aaaaaaaaaaaaaaaaaaaaaaaa!!!!!!"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {int(r.id): list(r.prefix_tokens) for r in token_counts.prefix_counts(df, model_path).collect()}
    for i, t in texts.items():
        assert got[i] == [len(x) for x in model.encode([t[:n] for n in range(len(t) + 1)])], t
    counted = {r.id: r for r in token_counts.count_tokens(odd, model_path, limit=50).collect()}
    for r in odd.collect():
        t = r.text or ""
        assert counted[r.doc_id].n_tokens == len(model.encode(t)) and counted[r.doc_id].n_bytes == len(t.encode())
        cut = counted[r.doc_id].fits_chars
        assert len(model.encode(t[:cut])) <= 50 and (cut == len(t) or all(len(model.encode(t[:n])) > 50 for n in range(cut + 1, min(len(t), cut + 30))))
    assert token_counts.count_tokens(none, model_path).count() == 0


def test_secret_spans_equal_the_patterns(odd, none):
    got = {(r.doc_id, r.spans): r for r in secrets.secrets_report(odd).collect()}
    for r in odd.collect():
        spans = []
        for place, rule in enumerate(secrets.RULES):
            found = [(m.start(), place, m.end(), rule.kind) for m in re.finditer(rule.pattern, r.text or "") if len(m.group(rule.group)) >= rule.least]
            spans += found
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))
        assert (r.doc_id, listed) in got
    assert secrets.secrets_report(none).count() == 0


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]+") == []
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == [(frozenset({"aki", "kia"}),)]
    asked = {r.kind: secrets.trigram_query(r.pattern) for r in secrets.RULES}
    for text, kind in (("apikey=abcdef", "assign"), ("PassWD: abcdef", "assign"), ("xoxb-0123456789", "chat"), ("-----BEGIN PRIVATE KEY-----", "pem")):
        assert all(any(all(g in text.lower() for g in s) for s in clause) for clause in asked[kind])


def test_quality_rules_on_odd_input(odd, none):
    rows = {r.doc_id: r for r in quality_rules.quality_report(odd).collect()}
    assert rows[0].base_failed and rows[1].base_failed and not rows[0].kept
    assert rows[4].n_repeat_words == 0 and rows[4].kept
    assert rows[6].n_dup_lines == 2
    assert rows[11].n_repeat_words == 30000 and rows[11].base_failed
    assert quality_rules.quality_report(none).count() == 0
    assert quality_rules.kept_rows(odd).columns == odd.columns


def test_a_document_of_a_bad_host_has_to_pass_every_rule(spark):
    good, odd_one = "some words that say a thing or two in a row here", "a$ b$ c$ d$ e$ f$ g$ h$ i$ j$ k$ l$"
    rows = [(i, odd_one if i % 2 else good, "bad") for i in range(200)] + [(1000 + i, odd_one if i == 0 else good, "fine") for i in range(200)]
    kept = {r.doc_id: r.kept for r in quality_rules.quality_report(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert kept[0] and not kept[1] and kept[1000] and kept[1001]


def test_mixing_on_odd_input(odd, none):
    rows = mixing.mixing_report(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    for size in {r.source_size for r in rows}:
        own = [r for r in rows if r.source_size == size]
        assert sum(r.taken for r in own) == math.floor(own[0].target)
    assert mixing.mixing_report(none).count() == 0 and mixing.mixed_rows(odd).columns == odd.columns


def test_sharding_on_odd_input(odd, none):
    rows = sharding.shard(odd, 1000, prefix_name="out_").collect()
    assert len(rows) == odd.count()
    sums = Counter()
    for r in rows:
        sums[r.out_shard] += r.out_row_bytes
    assert all(sums[r.out_shard] == r.out_shard_bytes for r in rows)
    assert all(n <= 1000 or len({r.doc_id for r in rows if r.out_shard == s and r.out_row_bytes}) == 1 for s, n in sums.items())
    assert sharding.shard(none, 1000, prefix_name="out_").count() == 0


def test_rows_of_one_id_split_like_others(spark):
    rows = [(7, "copy " * 20, n % 2) for n in range(2500)] + [(8, f"text {n} " * 10, 0) for n in range(300)]
    rows += [(None, "no id " * 20, 0)] * 300 + [(1000 + n, f"own {n} " * 10, 0) for n in range(300)] + [(9, "large " * 500, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = sharding.shard(docs.repartition(3), 1000).collect()
    assert Counter((r.doc_id, r.text, r.n) for r in got) == Counter(rows)
    sums, most = Counter(), Counter()
    for r in got:
        sums[r.shard] += r.row_bytes
        most[r.shard] = max(most[r.shard], r.row_bytes)
    assert all(sums[r.shard] == r.shard_bytes for r in got)
    assert all(n <= 1000 or n == most[s] for s, n in sums.items())
    again = sharding.shard(docs.repartition(5), 1000).collect()
    assert Counter((r.doc_id, r.text, r.n, r.shard) for r in got) == Counter((r.doc_id, r.text, r.n, r.shard) for r in again)


def test_decontamination_finds_copies_and_paraphrases(spark, none):
    rng = np.random.default_rng(8)
    item = lambda n: " ".join(f"term{x}" for x in rng.integers(0, 3000, n))
    items = [(k, item(int(rng.integers(15, 60)))) for k in range(30)] + [(98, ""), (99, None)]
    filler = lambda: " ".join(f"word{x}" for x in rng.zipf(1.3, 120) % 5000)
    docs, want = [], set()
    for n in range(300):
        text = filler()
        if n % 3 == 0:
            k = n // 3 % 30
            own = items[k][1].split()
            if n % 2:
                for at in range(0, len(own) - 5, 6):
                    own[at] = f"changed{at}"
            text += " " + " ".join(own).upper() + " " + filler()
            want.add((n, k))
        docs.append((n, text))
    docs += [(500, ""), (501, None)]
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert {(r.id, r.item_id) for r in found.collect()} == want
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontamination.contaminated(none, bench).count() == 0
    assert decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench.limit(0)).count() == 0


def test_decontamination_finds_short_copies_and_sparse_paraphrases(spark):
    rng = np.random.default_rng(12)
    items = [(n, " ".join(f"item{n}x{x}" for x in range(n))) for n in range(3, 61)]
    docs, want = [], set()
    rare = lambda n: " ".join(f"rare{x}" for x in rng.integers(0, 10**9, n))
    for n, t in items:
        docs.append((n, f"{rare(40)} {t} {rare(40)}"))
        want.add((n, n))
        if n % 5 == 0 and n >= 15:  # exactly 60 %: the first words, changed ones, the last three
            own, kept = t.split(), n * 3 // 5
            docs.append((500 + n, f"{rare(40)} {' '.join([*own[: kept - 3], rare(n - kept), *own[-3:]])} {rare(40)}"))
            want.add((500 + n, n))
    docs += [(1000 + k, rare(60)) for k in range(50)]
    docs += [(2000 + k, " ".join(w for n, t in items for w in t.split()[::-1])) for k in range(20)]  # words in the wrong order
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.id, r.item_id) for r in got} == want and all(-1.001 <= r.cosine <= 1.001 for r in got)


def test_stretches_of_a_block_leave_nothing_out():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    text = lambda n: " ".join(f"w{x}" for x in rng.zipf(1.4, n) % 200)
    block = decontamination.make_block([(k, text(int(rng.integers(1, 30)))) for k in range(60)], np.ones(decontamination.BUCKETS, np.float32))
    for words in decontamination.split_words(pa.array([text(int(rng.integers(1, 300))) for _ in range(30)])):
        seen = {}
        for d, k, low, high in zip(*decontamination._stretches(block, words)):
            seen.setdefault((int(d), int(k)), []).append((low, high))
        for k, own in enumerate(block.words):
            n, length = len(own), decontamination.stretch_words(len(own))
            masks = decontamination.masks_of(own.tolist())
            for d in range(len(words.first) - 1):
                for begin in range(words.first[d], words.first[d + 1]):
                    end = min(begin + length, words.first[d + 1])
                    hits = [masks[h] for h in words.hash[begin:end].tolist() if h in masks]
                    if len(hits) >= decontamination.needed(n) and decontamination.common_subsequence(n, hits) >= decontamination.needed(n):
                        assert any(low <= begin and end <= high for low, high in seen[d, k])


def test_common_subsequence_equals_the_table():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 6, 12).tolist(), rng.integers(0, 6, 20).tolist()
        table = np.zeros((13, 21), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        masks = decontamination.masks_of(a)
        assert decontamination.common_subsequence(12, [masks[y] for y in b if y in masks]) == table[-1, -1]


def test_grammar_composes_patterns():
    grammar = toxicity.Grammar({"idiot": 1.0, "moro*": 1.0})
    where = lambda text: int(np.argmax(grammar.features(text)[:6]))
    assert where("such an idiot") == 0 and where("you idiot") == 1 and where("an idiot, you") == 1
    assert where("he is not an idiot") == 2 and where("she said idiot") == 3
    assert where("we will kill time") == 4 and where("kill you") == 5
    assert not grammar.features("a clean text. no harm").any() and grammar.features("those morons")[1] > 0


@pytest.mark.parametrize("module, report, label", [(toxicity, "toxicity_report", "toxic"), (line_quality, "quality_scores", "quality")])
def test_classifiers_on_held_out_labels(spark, odd, none, module, report, label):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = getattr(module, report)(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    ranks, y = scored.score.rank().to_numpy(), scored[label].to_numpy()
    n = y.sum()
    area = (ranks[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))
    assert area > 0.9 and (scored.predicted == y).mean() > 0.95
    model = module.train(docs, labels)
    got = module.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert module.score(none, model).count() == 0
    untrained = module.train(docs, labels.limit(0))
    assert len({round(r.score, 9) for r in module.score(odd, untrained).collect()}) == 1


def test_chain_equals_enumeration():
    rng = np.random.default_rng(2)
    field = line_quality.LineField(rng.normal(size=line_quality.FEATURES), rng.normal(size=(2, 2)))
    x = rng.normal(size=(5, line_quality.FEATURES))
    unary = x @ field.weights
    total, good = 0.0, np.zeros(5)
    for code in range(32):
        labels = [(code >> t) & 1 for t in range(5)]
        weight = math.exp(sum(u for u, v in zip(unary, labels) if v) + sum(field.pairs[a, b] for a, b in zip(labels, labels[1:])))
        total += weight
        good += weight * np.array(labels)
    assert np.allclose(line_quality._chain(field, x), good / total)
    assert np.allclose(line_quality.marginals(field, unary[None], np.array([5]))[0][0], good / total)


def test_language_model_base_scores_and_gain(spark, odd, none):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    both = docs.unionByName(odd.filter("doc_id is null or doc_id = 0").select("doc_id", "text"))
    rows = both.collect()
    training = Counter()
    for r in rows:
        if zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 10:
            training.update([*words(r.text), "\n"])
    total, distinct = sum(training.values()), len(training)
    logs = lambda t: sum(math.log10((training[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in [*words(t), "\n"])
    got = sorted((r.id is None, r.id or 0, r.n_tokens, r.base_score) for r in language_model.score(both).collect())
    want = sorted((r.doc_id is None, r.doc_id or 0, len(words(r.text)) + 1, logs(r.text)) for r in rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-7)
    assert language_model.score(none.select("doc_id", "text")).count() == 0


def test_pipeline_equals_its_stages_by_brute_force(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id for r in quality_rules.quality_report(docs).collect() if r.kept}
    root = brute_components([(i, rows[i].text) for i in sorted(kept)], 5)
    kept = {i for i in kept if root[i] == i}
    items = [words(r.text.lower()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    flat = {i: " " + " ".join(words(rows[i].text.lower())) + " " for i in kept}
    clean = {i for i in kept if not any(" " + " ".join(w[:-1]) + " " in flat[i] for w in items)}
    left = docs.filter(F.col("doc_id").isin(*clean))
    want = Counter({r.doc_id: -(-r.taken // r.size) for r in mixing.mixing_report(left).collect() if r.size and r.taken})
    got = corpus_pipeline.run(spark, DATA).collect()
    assert Counter(r.doc_id for r in got) == want
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.row_bytes
    assert all(sizes[r.shard] == r.shard_bytes <= corpus_pipeline.SHARD_BYTES for r in got)
