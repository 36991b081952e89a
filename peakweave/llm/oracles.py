"""DuckDB SQL for the queries whose result SQL can state as a whole."""

from __future__ import annotations

from peakweave.llm import decontamination, embedding_dedup, fill_in_middle, licenses, quality_rules, vector_codes

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def license_sql() -> str:
    """Votes of all K-grams, diagonals, clusters of neighbouring diagonals, coverage."""
    k, slack, least, long = licenses.K, licenses.SLACK, licenses.LEAST, licenses.LONG
    rows = ",\n".join(f"({t}, '{label}', {str(base).lower()}, {len(text)}, {list(text)!r})"
                      for t, (label, text, base) in enumerate(licenses.TEMPLATES))
    return f"""WITH t AS (SELECT * FROM (VALUES {rows}) AS v(t, label, base, size, w)),
tg AS (SELECT t, a AS place, array_to_string(w[a + 1:a + {k}], ' ') AS g FROM t, unnest(range(size - {k - 1})) u(a)),
d AS (SELECT doc_id, {WORDS} AS w FROM documents),
dg AS (SELECT doc_id, p AS pos, array_to_string(w[p + 1:p + {k}], ' ') AS g FROM d, unnest(range(len(w) - {k - 1})) u(p)),
dia AS (SELECT doc_id, t, pos - place AS diagonal, min(place) AS low, list(DISTINCT place) AS places FROM dg JOIN tg USING (g) GROUP BY ALL),
gap AS (SELECT dia.*, label, base, size, coalesce(diagonal - lag(diagonal) OVER x > {slack}, false) AS apart FROM dia JOIN t USING (t) WINDOW x AS (PARTITION BY doc_id, t ORDER BY diagonal)),
cl AS (SELECT *, CASE WHEN base THEN diagonal ELSE sum(apart::INT) OVER (PARTITION BY doc_id, t ORDER BY diagonal) END AS cluster FROM gap),
spans AS (SELECT doc_id, t, label, base, size, cluster, min(diagonal + low) AS start FROM cl GROUP BY ALL),
cov AS (SELECT doc_id, t, cluster, count(DISTINCT a + o) AS covered FROM cl, unnest(places) x(a), unnest(range({k})) y(o) GROUP BY ALL),
ok AS (SELECT s.*, covered / size AS coverage FROM spans s JOIN cov USING (doc_id, t, cluster)
WHERE covered / size >= CASE WHEN base OR size < {long} THEN 1.0 ELSE {least} END),
per AS (SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score FROM ok GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
coalesce(labels, '') AS labels, cast(coalesce(score, 0) AS DOUBLE) AS score FROM d LEFT JOIN per USING (doc_id)"""


def decontamination_sql() -> str:
    n = decontamination.WINDOW
    return f"""WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT row_number() OVER () AS item, coalesce(cast(item_id AS VARCHAR), '') AS item_id, {WORDS} AS w FROM benchmark),
win AS (SELECT item, item_id, j, least({n}, len(w)) AS n, array_to_string(w[j:j + least({n}, len(w)) - 1], ' ') AS g
FROM b, unnest(range(1, len(w) - least({n}, len(w)) + 2)) u(j) WHERE len(w) > 0),
grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) u(i)),
hit AS (SELECT doc_id, i, j, n, item, item_id FROM grams JOIN win USING (n, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) u(p) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hit GROUP BY doc_id),
runs AS (SELECT doc_id, n, i - row_number() OVER (PARTITION BY doc_id, item, i - j ORDER BY i) AS run, item, i - j AS diagonal FROM hit),
longest AS (SELECT doc_id, max(length) AS length FROM (SELECT doc_id, count(*) + n - 1 AS length FROM runs GROUP BY doc_id, n, run, item, diagonal) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
coalesce(n_hit, 0) > 0 AS contaminated, coalesce(length, 0) AS longest_match
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN longest USING (doc_id)"""


def quality_rules_sql() -> str:
    """Counts, the exact binomial test of every cutoff, the strictest one before the first failure, and its verdict."""
    q = quality_rules
    stratum = " + ".join(f"(n_words >= {low})::INT" for low in q.STRATA[1:])
    values = {"symbol_ratio": "n_symbols / nullif(word_chars, 0)", "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
              "repeat_ratio": "n_repeat_words / nullif(n_words, 0)", "long_word_ratio": "n_long_words / nullif(n_words, 0)",
              "upper_ratio": "n_upper / nullif(word_chars, 0)"}
    cuts = ", ".join(f"('{rule}', {i}, {cut!r}::DOUBLE)" for rule, steps in q.GRID.items() for i, cut in enumerate(steps))
    limit, error = q.LIMIT / len(q.GRID), q.DELTA / (len(q.GRID) * len(q.STRATA))
    rule_rows = " UNION ALL ".join(f"SELECT doc_id, stratum, base_failed, {k} AS place, '{rule}' AS rule, coalesce({expr}, 0.0) AS value FROM m"
                                   for k, (rule, expr) in enumerate(values.items()))
    return rf"""WITH s AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM s, unnest(range(1, len(w) - 1)) u(i)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g), unnest(range(i, i + 3)) u(p) WHERE c > 1 GROUP BY doc_id),
c AS (SELECT s.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(lines) AS n_lines,
len(list_filter(w, lambda x: strlen(x) > 15)) AS n_long_words, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper FROM s LEFT JOIN r ON r.doc_id = s.doc_id),
m AS (SELECT *, {stratum} AS stratum, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c),
v AS ({rule_rows}), cuts AS (SELECT * FROM (VALUES {cuts}) AS t(rule, step, cut)),
trial AS (SELECT min(s.doc_id) AS doc_id FROM s JOIN labels USING (doc_id) WHERE quality IN (0, 1) GROUP BY s.text HAVING min(quality) = 1),
seen AS (SELECT stratum, rule, step, cut, count(*) AS n, count(*) FILTER (WHERE value > cut) AS k FROM v JOIN trial USING (doc_id) JOIN cuts USING (rule)
WHERE NOT base_failed GROUP BY ALL),
test AS (SELECT stratum, rule, step, cut, CASE WHEN k >= n THEN 1 ELSE (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({limit}) + (n - i) * ln(1 - {limit})))
FROM unnest(range(k + 1)) u(i)) END > {error} AS fails FROM seen),
open_ AS (SELECT *, sum(fails::INT) OVER (PARTITION BY stratum, rule ORDER BY step) AS failures FROM test),
chosen AS (SELECT stratum, rule, min_by(cut, -step) AS cut FROM open_ WHERE failures = 0 GROUP BY ALL),
verdict AS (SELECT doc_id, string_agg(rule, ',' ORDER BY place) AS failed FROM v JOIN chosen USING (stratum, rule) WHERE value > cut GROUP BY doc_id)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, cast(stratum AS INTEGER) AS stratum,
coalesce(failed, '') AS failed_rules, NOT base_failed AND failed IS NULL AS kept FROM m LEFT JOIN verdict ON verdict.doc_id = m.doc_id"""


def vector_codes_sql() -> str:
    """Each round's codebooks as a table; all distances of parts to entries, the least with the lower index."""
    parts, entries, scale = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.SCALE

    def near(r: int) -> str:
        return f"""near{r} AS MATERIALIZED (SELECT row, part, min(struct_pack(d := list_sum([(v[k] - e[k]) * (v[k] - e[k]) FOR k IN range(1, len(v) + 1)]), entry := entry)) AS best
FROM part JOIN book{r} USING (part) GROUP BY row, part)"""

    def book(r: int) -> str:
        return f"""book{r} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM book{r - 1} b LEFT JOIN (
SELECT part, entry, list(mean ORDER BY k) AS e FROM (SELECT part, best.entry AS entry, k, cast(floor(sum(v[k]) / count(*)) AS BIGINT) AS mean
FROM near{r - 1} JOIN part USING (row, part), unnest(range(1, len(v) + 1)) u(k) GROUP BY ALL) GROUP BY part, entry) m USING (part, entry))"""

    rounds = ",\n".join(f"{near(r)},\n{book(r + 1)}" for r in range(vector_codes.ROUNDS))
    return f"""WITH x AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, label, [cast(floor(cast(c AS DOUBLE) * {scale}) AS BIGINT) FOR c IN embedding] AS x FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
part AS MATERIALIZED (SELECT row, vec_id, p AS part, x[p * len(x) // {parts} + 1:(p + 1) * len(x) // {parts}] AS v FROM x, unnest(range({parts})) u(p)),
book0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS e FROM part
WHERE vec_id IN (SELECT vec_id FROM x ORDER BY vec_id LIMIT {entries})),
{rounds},
{near(vector_codes.ROUNDS)},
code AS (SELECT row, string_agg(lpad(lower(to_hex(best.entry)), 2, '0'), '' ORDER BY part) AS code, cast(sum(best.d) AS BIGINT) AS error FROM near{vector_codes.ROUNDS} GROUP BY row),
sha AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{vector_codes.ROUNDS})
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM x JOIN code USING (row), sha"""


def embedding_dedup_sql() -> str:
    """All pairs of a label, and what links reach."""
    return f"""WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS MATERIALIZED (SELECT row, label, e, sqrt(list_sum([c * c FOR c IN e])) AS size FROM v WHERE label IS NOT NULL AND e IS NOT NULL
AND len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(e, lambda c: c <> 0)) > 0),
link AS MATERIALIZED (SELECT a.row AS a, b.row AS b FROM ok a JOIN ok b ON a.label = b.label AND a.row <> b.row
WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= {embedding_dedup.LIMIT}),
reach AS (SELECT row AS a, row AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a AS row, min(vec_id) AS component_id FROM reach JOIN v ON v.row = reach.b GROUP BY a),
n AS (SELECT a AS row, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN least USING (row) LEFT JOIN n USING (row)"""


def fill_in_middle_sql() -> str:
    """Lines as a list, cut where the hash of the id says."""
    salt, rate, share = fill_in_middle.SALT, fill_in_middle.RATE, fill_in_middle.SPM_SHARE

    def lines(a: str, b: str) -> str:
        """Lines a + 1 to b with their ends; the last has none when all are taken and the text ends without one."""
        return f"CASE WHEN {b} > {a} THEN array_to_string(l[{a} + 1:{b}], chr(10)) || CASE WHEN {b} < len(l) THEN chr(10) ELSE '' END ELSE '' END"

    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{salt}:' || coalesce(cast(doc_id AS VARCHAR), '')) AS x FROM documents),
s AS (SELECT *, string_split(text, chr(10)) AS l, CASE WHEN text = '' THEN 0 ELSE len(text) - len(replace(text, chr(10), '')) + (right(text, 1) <> chr(10))::INT END AS n,
[cast('0x' || substr(x, 8 * k + 1, 8) AS BIGINT) FOR k IN range(4)] AS h FROM d),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b FROM s),
p AS (SELECT *, {lines("0", "a")} AS prefix, {lines("a", "b")} AS middle, {lines("b", "n")} AS suffix,
CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= {rate} THEN 'plain'
WHEN h[4] % 100 < {share} THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, cast(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN len(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN len(middle) END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""
