"""Secret scans: trigram queries derived from each rule, postings intersected, candidates verified by the rule itself."""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as codes
from re import _parser as patterns

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.store import stored, text_of

MOST_STRINGS = 64
GRAMS_PER_SPELLING = 2
# Fixed value: letters of running text, frequent ones first; what is not in it is rarer still.
FREQUENT = " etaoinshrdlcumwfgypbvkjxqz"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, the group whose length counts, and the least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
# The three base kinds, in their order; the others are added by this operator.
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)

Clause = tuple[frozenset[str], ...]


def _choices(node) -> list[str] | None:
    """All lower-case strings that a small node can match, or None."""
    kind, value = node
    if kind is codes.LITERAL:
        return [chr(value).lower()]
    if kind is codes.IN and all(k is codes.LITERAL for k, _ in value):
        return sorted({chr(v).lower() for _, v in value})
    if kind is codes.SUBPATTERN:
        return _strings(value[3])
    if kind is codes.BRANCH:
        parts = [_strings(p) for p in value[1]]
        return None if None in parts else sorted({s for p in parts for s in p})
    if kind is codes.MAX_REPEAT and value[:2] == (0, 1):
        inner = _strings(value[2])
        return None if inner is None else ["", *inner]
    return None


def _strings(nodes) -> list[str] | None:
    out = [""]
    for node in nodes:
        more = _choices(node)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = [a + b for a in out for b in more]
    return out


def _rarest(spelling: str) -> list[str]:
    grams = {spelling[i : i + 3] for i in range(len(spelling) - 2)}
    rarity = lambda g: sum(FREQUENT.index(c) if c in FREQUENT else len(FREQUENT) for c in g)
    return sorted(grams, key=lambda g: (-rarity(g), g))[:GRAMS_PER_SPELLING]


def trigram_query(pattern: str) -> list[Clause]:
    """The Boolean query a pattern implies over lower-case trigrams: every clause must hold, a clause being a choice of sets.

    Runs of characters with few spellings give a clause: the trigrams of one of the spellings must all be in the text. A run
    with a spelling of under three characters says nothing. No clause at all means that the rule has to scan every text.
    Of a spelling's trigrams the two with the rarest letters are asked for: fewer only let more candidates through.
    """
    clauses: list[Clause] = []

    def finish(run: list[str]) -> None:
        grams = {frozenset(_rarest(s)) for s in run}
        if grams and frozenset() not in grams:
            needed = [g for g in grams if not any(other < g for other in grams)]
            clauses.append(tuple(sorted(needed, key=sorted)))

    run = [""]
    for node in patterns.parse(pattern):
        more = _choices(node)
        if more is not None and len(run) * len(more) <= MOST_STRINGS:
            run = [a + b for a in run for b in more]
            continue
        finish(run)
        run = more if more is not None else [""]
    finish(run)
    return clauses


def postings(docs: DataFrame, grams: list[str], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(gram, id) for the trigrams that some rule asks for; the others would never be looked up."""
    low = F.lower(text_of(docs, text))
    here = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(g)), F.lit(g)) for g in grams]))
    return docs.select(F.explode(here).alias("gram"), docs[id_col].alias("id"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, kinds): the rules whose trigram query an id's postings satisfy. Rules without a query are not in it.

    Rows of one id share their postings, so a rule may be tried on a text without need, but never missed.
    """
    spark = docs.sparkSession
    asked = [
        (gram, rule.kind, c, s, len(grams), len(query))
        for rule in rules
        for query in [trigram_query(rule.pattern)]
        for c, clause in enumerate(query)
        for s, grams in enumerate(clause)
        for gram in sorted(grams)
    ]
    schema = "gram string, kind string, clause int, spelling int, n_grams int, n_clauses int"
    wanted = spark.createDataFrame(asked, schema)
    index = stored(postings(docs, sorted({a[0] for a in asked}), id_col, text), "secret-postings")
    met = index.join(F.broadcast(wanted), "gram").groupBy("id", "kind", "clause", "spelling")
    spellings = met.agg(F.count_distinct("gram").alias("found"), F.first("n_grams").alias("n_grams"), F.first("n_clauses").alias("n_clauses"))
    clauses = spellings.filter(F.col("found") == F.col("n_grams")).groupBy("id", "kind")
    full = clauses.agg(F.count_distinct("clause").alias("held"), F.first("n_clauses").alias("n_clauses"))
    return full.filter(F.col("held") == F.col("n_clauses")).groupBy("id").agg(F.collect_set("kind").alias("kinds"))


def rule_spans(text: Column, rule: Rule) -> Column:
    """Spans (start, end) in code points of the leftmost matches of a rule that are long enough, in order.

    Splitting by the pattern gives the gaps between its matches, so gap and match lengths in turn give the positions.
    """
    match = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else match
    lengths = F.transform(
        F.arrays_zip(F.split(text, rule.pattern).alias("gap"), match.alias("match"), counted.alias("counted")),
        lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["match"]).alias("match"), F.length(x["counted"]).alias("counted")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + F.coalesce(x["match"], F.lit(0))
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        enough = F.coalesce(x["counted"] >= rule.least, F.lit(False))
        return F.struct(end.alias("at"), F.when(enough, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    found = F.aggregate(lengths, start, step, lambda state: state["spans"])
    return F.when(text.rlike(_quick(rule)), found).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def _quick(rule: Rule) -> str:
    """A pattern that is found wherever the rule has a match that is long enough."""
    if rule.group == 0 and rule.least > 1 and rule.pattern.endswith("]+") and rule.pattern.count("+") == 1:
        head = rule.pattern[: rule.pattern.rindex("[")]
        return f"{rule.pattern[:-1]}{{{max(1, rule.least - _width(head))},}}"
    return rule.pattern


def _width(pattern: str) -> int:
    return patterns.parse(pattern).getwidth()[1]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id and, for every row of `docs`, an array column per rule kind with the spans of its matches.

    Rules with a trigram query are tried on their candidates, the others on every text. Texts are scanned whole.
    Null or empty text: no spans. Null id: postings of all such rows are shared, spans are their own. Equal rows: each has
    its spans. Empty input: empty result.
    """
    left = docs.select(docs[id_col].alias("id"), text_of(docs, text).alias("t"))
    tried = candidates(docs, rules, id_col, text).withColumnRenamed("id", "candidate")
    both = left.join(tried, left["id"].eqNullSafe(tried["candidate"]), "left").drop("candidate")
    none = F.array().cast("array<struct<start:int,end:int>>")
    columns = []
    for rule in rules:
        spans = rule_spans(F.col("t"), rule)
        asked = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        columns.append((F.when(asked, spans).otherwise(none) if trigram_query(rule.pattern) else spans).alias(rule.kind))
    return both.select("id", *columns)


def listed(kinds: list[str]) -> Column:
    """kind:start:end of the spans of some kinds, by start, then in the order of the kinds, comma-joined."""
    def tagged(kind: str, place: int) -> Column:
        return F.transform(F.col(kind), lambda s: F.struct(s["start"], F.lit(place).alias("place"), s["end"], F.lit(kind).alias("kind")))

    ordered = F.sort_array(F.concat(*[tagged(kind, place) for place, kind in enumerate(kinds)]))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets_report(docs: DataFrame) -> DataFrame:
    found = scan(docs)
    base = [r.kind for r in RULES if r.base]
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in base]
    digest = F.sha2(listed(base).cast("binary"), 256).alias("base_sha256")
    return found.select(F.col("id").alias("doc_id"), *counts, digest, listed([r.kind for r in RULES]).alias("spans"))
