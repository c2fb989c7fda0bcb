"""The SQL that the registered queries are compared with, written from the definitions."""

from __future__ import annotations

from ledgerwatch.llm import divergence, fill_middle, mixing, quality_rules, secrets, sharding
from ledgerwatch.llm.queries import SHARD_BYTES

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def secrets_sql() -> str:
    parts = []
    for place, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"""SELECT row, {place} AS place, '{rule.kind}' AS kind, {int(rule.base)} AS base, i, g, m, c, {rule.least} AS least FROM (
            SELECT row, g, m, c, unnest(range(1, len(m) + 1)) AS i FROM (SELECT row, string_split_regex(t, '{pattern}') AS g,
            regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS c FROM d WHERE len(regexp_extract_all(t, '{pattern}')) > 0))"""
        )
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents), every AS ({" UNION ALL ".join(parts)}),
    spans AS (SELECT row, place, kind, base, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s,
        length(m[i]) AS n FROM every WHERE length(c[i]) >= least),
    said AS (SELECT row, place, base, s, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT) AS span, kind FROM spans),
    per AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(span, ',' ORDER BY s, place) FILTER (base = 1) AS base_spans, string_agg(span, ',' ORDER BY s, place) AS spans FROM said GROUP BY row)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
        sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN per USING (row)"""


def quality_sql() -> str:
    q = quality_rules
    rates = ", ".join(f"(sum({r}) OVER (PARTITION BY host) + m_{r} * k_{r}) / (count(*) OVER (PARTITION BY host) + k_{r}) AS rate_{r}" for r in q.RULES[1:])
    mean = ", ".join(f"sum(f_{r}) / sum(n) AS m_{r}, sum(n * (f_{r} / n) * (f_{r} / n)) / sum(n) AS q_{r}" for r in q.RULES[1:])
    strength = ", ".join(
        f"m_{r}, CASE WHEN q_{r} - m_{r} * m_{r} > 1e-12 THEN least(1e6, greatest(1.0, m_{r} * (1 - m_{r}) / (q_{r} - m_{r} * m_{r}) - 1)) ELSE 1e6 END AS k_{r}"
        for r in q.RULES[1:]
    )
    bad = " OR ".join(f"({r} = 1 AND rate_{r} > {q.HOST_LIMIT})" for r in q.RULES[1:])
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, source AS host, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
    win AS (SELECT row, i, w[i:i + {q.WINDOW - 1}] AS g FROM (SELECT row, w, unnest(range(1, len(w) - {q.WINDOW - 2})) AS i FROM d)),
    twice AS (SELECT row, i FROM win QUALIFY count(*) OVER (PARTITION BY row, g) > 1),
    covered AS (SELECT row, count(DISTINCT i + k) AS n_repeat_words FROM twice, range({q.WINDOW}) AS r(k) GROUP BY row),
    lines AS (SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT row, unnest(string_split(t, chr(10))) AS line FROM d)
        WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY row),
    c AS (SELECT row, doc_id, coalesce(host, '-null-') AS host, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
        length(t) - length(regexp_replace(t, '{q.SYMBOLS}', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words FROM d LEFT JOIN covered USING (row) LEFT JOIN lines USING (row)),
    f AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.REPEAT_PERCENT} * n_words AS base_failed,
        CAST(10 * n_symbols > n_words AS INT) AS fails_symbols, CAST(10 * n_dup_lines > 3 * n_lines AS INT) AS fails_lines,
        CAST(word_chars < 2 * n_words OR word_chars > 15 * n_words AS INT) AS fails_length FROM c),
    h AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, {", ".join(f"CAST(sum({r}) AS DOUBLE) AS f_{r}" for r in q.RULES[1:])} FROM f GROUP BY host),
    p AS (SELECT {strength} FROM (SELECT {mean} FROM h)),
    v AS (SELECT f.*, {rates} FROM f, p)
    SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({bad}) AS kept FROM v"""


def sharding_sql() -> str:
    bits = sharding.HASH_BITS
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(strlen(text), 0) AS row_bytes,
        to_base(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, {bits // 4}) AS BIGINT), 2, {bits}) AS digits FROM documents),
    every AS (SELECT row, doc_id, row_bytes, depth, digits[1:depth] AS shard FROM d, range({bits + 1}) AS r(depth)),
    sized AS (SELECT *, sum(row_bytes) OVER (PARTITION BY depth, shard) AS shard_bytes FROM every)
    SELECT doc_id, row_bytes, shard, CAST(depth AS INT) AS shard_depth, CAST(shard_bytes AS BIGINT) AS shard_bytes FROM sized
    WHERE shard_bytes <= {SHARD_BYTES} OR depth = {bits} QUALIFY row_number() OVER (PARTITION BY row ORDER BY depth) = 1"""


def mixing_ctes() -> str:
    """CTEs up to `taken_rows`: row, doc_id, size, source_size, target, taken."""
    cap, weights = mixing.EPOCHS, list(mixing.WEIGHTS)
    return f"""sized AS (SELECT row, doc_id, coalesce('+' || source, '-') AS src, len({WORDS}) AS size,
        substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, {mixing.KEY_DIGITS}) AS key FROM docs),
    s AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size, {weights}[(row_number() OVER (ORDER BY src) - 1) % {len(weights)} + 1] AS weight FROM sized GROUP BY src),
    r AS (SELECT *, source_size * {cap} AS cap, sum(source_size) OVER () - coalesce(sum(source_size * {cap}) OVER before, 0) AS rest,
        sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open FROM s
        WINDOW before AS (ORDER BY source_size * {cap} / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    l AS (SELECT coalesce(max(CAST(rest AS DOUBLE) / CAST(open AS DOUBLE)) FILTER (CAST(rest AS DOUBLE) / CAST(open AS DOUBLE) <= cap / weight), 0) AS level FROM r),
    t AS (SELECT src, source_size, least(CAST(cap AS DOUBLE), level * weight) AS target FROM r, l),
    u AS (SELECT sized.*, source_size, target, CAST(floor(target) AS BIGINT) AS words,
        CASE WHEN source_size = 0 THEN 0 ELSE least({cap}, CAST(floor(target) AS BIGINT) // source_size) END AS copies,
        sum(size) OVER (PARTITION BY src ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM sized JOIN t USING (src)),
    taken_rows AS (SELECT row, doc_id, size, source_size, target, copies, CAST(copies * size + greatest(0, least(words - copies * source_size - start, size)) AS BIGINT) AS taken FROM u)"""


def mixing_sql() -> str:
    return f"""WITH docs AS (SELECT row_number() OVER () AS row, * FROM documents), {mixing_ctes()}
    SELECT doc_id, size, source_size, target, taken FROM taken_rows"""


def divergence_sql() -> str:
    v = divergence
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    p = f"1 + {v.SCALE}::HUGEINT * (n + 1) // (total + kept)"
    f = "((p - q) * (p - q)) // q"
    return f"""WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all({lower}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    every AS (SELECT row, lang, source, unnest(w) AS term FROM d),
    kept_terms AS (SELECT lang, term FROM every GROUP BY lang, term HAVING count(DISTINCT row) >= {v.LEAST_DOCS}),
    vocabulary AS (SELECT lang, count(*) AS kept FROM kept_terms GROUP BY lang),
    counts AS (SELECT lang, source, term, count(*) AS n FROM every JOIN kept_terms USING (lang, term) GROUP BY lang, source, term),
    groups AS (SELECT g.lang, g.source, coalesce(total, 0) AS total, coalesce(kept, 0) AS kept FROM (SELECT DISTINCT lang, source FROM d) AS g
        LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source) USING (lang, source) LEFT JOIN vocabulary USING (lang)),
    dense AS (SELECT g.lang, g.source, term, coalesce(n, 0) AS n, total, kept FROM groups AS g JOIN kept_terms USING (lang) LEFT JOIN counts USING (lang, source, term)),
    rates AS (SELECT lang, source, term, n, {p} AS p FROM dense),
    whole AS (SELECT lang, term, {p} AS q FROM (SELECT lang, term, sum(n)::HUGEINT AS n, any_value(kept) AS kept, any_value(t.total) AS total FROM dense
        JOIN (SELECT lang, sum(total) AS total FROM groups GROUP BY lang) AS t USING (lang) GROUP BY lang, term)),
    pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum({f}) AS value FROM rates AS x JOIN (SELECT lang, source, term, p AS q FROM rates) AS y
            ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source) AS s
        ON a.lang = s.lang AND a.source = s.source AND b.source = s.other),
    terms AS (SELECT lang, source, term AS item, {f} AS value FROM rates JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
    parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
    FROM parts QUALIFY part = 'pair' OR rank <= {v.TOP_TERMS}"""


def fill_in_middle_sql() -> str:
    m = fill_middle
    h = ", ".join(f"CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
    psm, spm = "'<P>' || prefix || '<S>' || suffix || '<M>' || middle", "'<S>' || suffix || '<P>' || prefix || '<M>' || middle"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{m.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w, {h} FROM d),
    c AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b FROM u),
    s AS (SELECT doc_id, t, n, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:n], '') AS suffix,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {m.FORM_PERCENT} THEN 'plain'
        WHEN h4 % 100 < {m.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN {psm} ELSE {spm} END) AS output_sha256, sha256(t) AS restored_sha256 FROM s"""


ORACLE: dict[str, str] = {
    "op3_secret_scan": secrets_sql(),
    "op4_quality_rules": quality_sql(),
    "op7_sharding": sharding_sql(),
    "op10_mixing": mixing_sql(),
    "op12_source_divergence": divergence_sql(),
    "op13_fill_in_middle": fill_in_middle_sql(),
}
