"""Toxicity by a weighted finite-state grammar over clauses: insult, threat, target, negation, reported speech.

Each part of the grammar is a small transducer over word classes. They are composed into one machine, whose table drives the
scan of a clause; a second pass from the right looks for targets that follow. The machine writes the weight of every insult or
threat to the pattern of its state, and the weights of the patterns are fitted to labels.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerwatch.llm.logistic import fit_logistic, predict_logistic
from ledgerwatch.llm.quality_rules import windows, word_array
from ledgerwatch.llm.store import bound, crc_fold, stored, text_of

FOLDS, HELD_OUT = 4, 2
CUTOFF = 0.3
FIT_DOCS = 12_000
LEXICON_SIZE = 2_000
LEAST_Z = 6.0
LEAST_TOXIC = 5
STEMS = (4, 5, 6, 7)

# The closed word classes of the grammar, in the four languages of the texts.
THREATS = frozenset(
    "kill kills killing murder hurt destroy beat stab shoot strangle töten umbringen schlagen vernichten tuer frapper détruire matar golpear destruir".split()
)
TARGETS = frozenset("you your yours yourself u he she they them him her these those this du dich dein ihr euch vous toi ton votre tu te usted ustedes él ella".split())
NEGATIONS = frozenset("not no never none isn't aren't don't doesn't wasn't without nicht kein keine nie ne pas jamais aucun sin nunca ningún".split())
REPORTS = frozenset("said says say told claimed wrote quoted called reportedly according sagte sagt schrieb laut dit disait selon écrit dijo dice según escribió".split())

CLAUSE_ENDS = re.compile(r"[.!?;\n]")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|\"")
NEGATION_REACH = 3
TARGET_REACH = 4
FEATURES = ("plain", "targeted", "negated", "reported", "threat", "threat_targeted", "strongest", "clauses", "density")


# Input classes of the transducers.
NEGATION, REPORT, TARGET, OTHER = range(4)


def word_class(token: str) -> int:
    if token in NEGATIONS:
        return NEGATION
    if token in REPORTS or token == '"':
        return REPORT
    return TARGET if token in TARGETS else OTHER


@dataclass(frozen=True)
class Transducer:
    """A machine over word classes, started in state 0: arcs[state][class] is the next state, output[state] what it tells about a word."""

    arcs: tuple[tuple[int, ...], ...]
    output: tuple[tuple[bool, ...], ...]

    def states(self, classes: list[int]) -> list[int]:
        """The state after each word."""
        state, out = 0, []
        for c in classes:
            state = self.arcs[state][c]
            out.append(state)
        return out


def within(wanted: int, reach: int) -> Transducer:
    """Is a word of the wanted class at most `reach` words back? States: out of reach, then 0 to `reach` words back."""
    arcs = [tuple(1 if c == wanted else later for c in range(4)) for later in (0, *range(2, reach + 2), 0)]
    return Transducer(tuple(arcs), ((False,), *[(True,)] * (reach + 1)))


def since(wanted: int) -> Transducer:
    """Has there been a word of the wanted class?"""
    return Transducer((tuple(int(c == wanted) for c in range(4)), (1,) * 4), ((False,), (True,)))


def compose(left: Transducer, right: Transducer) -> Transducer:
    """One machine that runs both on the same words: its states are the pairs that can be reached, its output both outputs."""
    numbers, pairs, arcs = {(0, 0): 0}, [(0, 0)], []
    for a, b in pairs:
        row = []
        for c in range(4):
            pair = left.arcs[a][c], right.arcs[b][c]
            if pair not in numbers:
                numbers[pair] = len(pairs)
                pairs.append(pair)
            row.append(numbers[pair])
        arcs.append(tuple(row))
    return Transducer(tuple(arcs), tuple(left.output[a] + right.output[b] for a, b in pairs))


FOLLOWED = within(TARGET, TARGET_REACH)
MACHINE = compose(compose(within(NEGATION, NEGATION_REACH), since(REPORT)), FOLLOWED)


def pattern(negated: bool, reported: bool, targeted: bool, threat: bool) -> int:
    """The pattern that an insult or threat in this state is written to, by its place in FEATURES."""
    if negated or reported:
        return 2 if negated else 3
    return (4 if threat else 0) + int(targeted)


# Output arcs of the composed machine: the pattern by state, by whether a target follows, and by kind of word.
PATTERNS = tuple(tuple(tuple(pattern(n, r, t or ahead, threat) for threat in (False, True)) for ahead in (False, True)) for n, r, t in MACHINE.output)


@dataclass
class Grammar:
    """Weights of the learned insult words and stems (a stem ends in *), and the automaton that finds them in a text."""

    weights: dict[str, float]
    finder: object = field(default=None, repr=False)

    def automaton(self):
        if self.finder is None:
            import ahocorasick

            self.finder = ahocorasick.Automaton()
            for entry in {w.rstrip("*") for w in self.weights} | THREATS:
                self.finder.add_word(entry, len(entry))
            self.finder.make_automaton()
        return self.finder

    def insult(self, token: str) -> float:
        """The weight of a word: its own, or that of its longest known stem."""
        own = self.weights.get(token)
        if own is not None:
            return own
        return next((w for n in reversed(STEMS) if len(token) > n and (w := self.weights.get(token[:n] + "*")) is not None), 0.0)

    def clause(self, tokens: list[str]) -> np.ndarray:
        """One clause through the composed machine: output weights by pattern, summed over its paths."""
        out = np.zeros(6)
        classes = [word_class(t) for t in tokens]
        ahead = FOLLOWED.states(classes[::-1])[::-1]
        for token, state, follows in zip(tokens, MACHINE.states(classes), ahead):
            threat = token in THREATS
            weight = 1.0 if threat else self.insult(token)
            if weight > 0:
                out[PATTERNS[state][FOLLOWED.output[follows][0]][threat]] += weight
        return out

    def features(self, text: str) -> np.ndarray:
        """Sums over the clauses of a text that hold an insult or a threat; clauses without one score nothing."""
        out = np.zeros(len(FEATURES))
        low = text.lower()
        done, hits = -1, 0
        for end, length in self.automaton().iter(low):
            start = end - length + 1
            if start <= done or (start > 0 and low[start - 1].isalpha()):
                continue
            begin = max(low.rfind(c, 0, start) for c in ".!?;\n") + 1
            stop = CLAUSE_ENDS.search(low, end)
            done = stop.start() if stop else len(low)
            found = self.clause(TOKEN.findall(low[begin:done]))
            if found.any():
                out[:6] += found
                out[6] = max(out[6], found.sum())
                hits += 1
        out[7] = hits
        out[8] = 100.0 * out[:6].sum() / (len(low) / 6 + 20)
        out[:8] = np.log1p(np.maximum(out[:8], 0))
        return out


@dataclass
class ToxicityModel:
    grammar: Grammar
    logistic: tuple

    def score(self, text: str) -> float:
        return float(predict_logistic(self.grammar.features(text)[None, :], self.logistic)[0])


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int, id_col: str = "doc_id") -> DataFrame:
    """(id, text, y) of about `most` labelled documents outside the held-out fold, one of each group of close copies.

    Labels are thinned by a hash of their id to the bound first, so that their broadcast has a known size.
    """
    known = labels.select(labels[id_col].cast("long").alias("id"), labels[label].cast("int").alias("y")).filter("id is not null and y is not null")
    known = known.filter(crc_fold(F.col("id"), folds) != held_out)
    share = min(1.0, most / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("id", F.lit(label)), F.lit(1_000_000)) < int(share * 1_000_000)).dropDuplicates(["id"])
    rows = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, "text").alias("text")).join(F.broadcast(chosen), "id")
    copy_of = F.coalesce(F.array_min(bound(word_array(F.col("text")), windows)), F.xxhash64("text"))
    return stored(rows.withColumn("copy_of", copy_of).dropDuplicates(["copy_of"]).select("id", "text", "y"), "labelled")


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Words and word stems that stand in toxic texts far more often than their share of all texts explains."""
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    stems = F.flatten(F.transform(tokens, lambda t: F.array(*[F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit("*"))) for n in STEMS])))
    entries = F.explode(F.concat(tokens, F.array_distinct(F.array_compact(stems))))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("toxic")).first()
    share = (sizes["toxic"] + 0.5) / (sizes["n"] + 1.0)
    counted = rows.select("y", entries.alias("entry")).groupBy("entry").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("toxic"))
    z = (F.col("toxic") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)))
    odds = F.log((F.col("toxic") + 0.5) / (F.col("n") - F.col("toxic") + 0.5)) - float(np.log(share / (1 - share)))
    good = counted.withColumn("z", z).withColumn("odds", odds).filter((F.col("z") > LEAST_Z) & (F.col("toxic") >= LEAST_TOXIC) & (F.col("odds") > 1.5) & (F.length("entry") > 2))
    best = good.orderBy(F.desc("z"), "entry").limit(LEXICON_SIZE).collect()
    return {r.entry: float(min(r.odds, 6.0)) / 3.0 for r in best}


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Lexicon and pattern weights from at most about FIT_DOCS labelled documents.

    The weights are fitted to patterns found with a lexicon that has not seen the document: each half of the documents
    is read with the words of the other. The lexicon that is kept is learned from all of them.
    """
    rows = labelled(docs, labels, "toxic", FOLDS, HELD_OUT, FIT_DOCS)
    half = F.pmod(F.xxhash64(F.col("id"), F.lit("half")), F.lit(2))
    features = []
    for side in (0, 1):
        features += _features(rows.filter(half == side).select("id", "text", "y"), Grammar(learn_lexicon(rows.filter(half != side))))
    y = np.array([r.y for r in features], float)
    x = np.array([r.features for r in features], float).reshape(len(y), len(FEATURES))
    return ToxicityModel(Grammar(learn_lexicon(rows)), fit_logistic(x, y))


def _features(rows: DataFrame, grammar: Grammar) -> list:
    def run(batches):
        for batch in batches:
            found = [grammar.features(t).tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(found, pa.list_(pa.float64()))], names=["y", "features"])

    return rows.mapInArrow(run, "y int, features array<double>").collect()


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, score and the weights of the patterns found (a column per pattern) for every row of `docs`, on whole texts.

    Null or empty text: nothing found, so the score of a text without insults. Null id: kept as it is. Equal rows: equal
    scores. Empty input: empty result. Without labels of both kinds every text has the same score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ToxicityModel(Grammar(model.grammar.weights), model.logistic))
    whole = isinstance(docs.schema[id_col].dataType, IntegralType)

    def run(batches):
        own = shared.value
        for batch in batches:
            rows = [own.grammar.features(t) for at in range(0, len(batch), 256) for t in batch.column(1).slice(at, 256).to_pylist()]
            x = np.array(rows, float).reshape(len(batch), len(FEATURES))
            columns = [pa.array(predict_logistic(x, own.logistic)), *[pa.array(x[:, k]) for k in range(len(FEATURES))]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "score", *FEATURES])

    given = docs.select(docs[id_col].cast("long" if whole else "string").alias("id"), text_of(docs, text).alias("text"))
    schema = f"id {'bigint' if whole else 'string'}, score double, " + ", ".join(f"{f} double" for f in FEATURES)
    return given.mapInArrow(run, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, train(docs, labels))
    held_out = (crc_fold(F.col("id"), FOLDS) == HELD_OUT).alias("held_out")
    return scored.select(F.col("id").alias("doc_id"), held_out, "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
