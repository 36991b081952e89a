"""Text, question-answering and simplification metric queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from peakweave.functions import text as tx
from peakweave.metrics import benchmarks, evaluate, get
from peakweave.metrics import qa
from peakweave.metrics import textgen as tg
from peakweave.plans.queries.metrics import rounded
from peakweave.plans.queries.registry import joined, query, r
from peakweave.plans.queries.views import table, view


def hypotheses(spark, sf):
    """Every prediction repeats its reference with changed words, then the reply; the reply is a second reference."""
    return view(spark, sf, "text_pairs").select(
        "id", F.concat(F.replace("reference", F.lit("on"), F.lit("an")), F.lit(" "), "prediction").alias("prediction"),
        "reference", F.array("reference", "prediction").alias("references"), F.col("prediction").alias("source"))


def single(spark, sf):
    return hypotheses(spark, sf).drop("references")


HYP_SQL = """hyp AS (SELECT id, replace(reference, 'on', 'an') || ' ' || prediction AS prediction, reference, prediction AS reply FROM text_pairs)"""
_13A = "replace(replace(replace({0}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
for _old, _new in tx.ENTITIES_13A:
    _13A = f"replace({_13A}, '{_old}', '{_new}')"
_13A = f"(' ' || {_13A} || ' ')"
for _p, _r in tx.RULES_13A:
    _13A = f"regexp_replace({_13A}, '{_p.replace('{', '{{').replace('}', '}}')}', '{_r.replace('$', chr(92))}', 'g')"
_WORDS = "list_filter(regexp_split_to_array({0}, '\\s+'), lambda w: w <> '')"


def sql_13a(c: str) -> str:
    return _WORDS.format(_13A.format(c))


def sql_words(c: str) -> str:
    return _WORDS.format(c)


def grams_sql(orders: int, sides: str, sep: str = " ") -> str:
    """gram rows from toks(id, k, t): k = -1 for the prediction, 0… for the references."""
    return f"""toks AS ({sides}),
grams AS (SELECT id, k, n, array_to_string(t[i:i + n - 1], '{sep}') AS gram FROM toks, range(1, {orders + 1}) a(n), unnest(range(1, len(t) - n + 2)) b(i)),
cnt AS (SELECT id, k, n, gram, count(*) AS c FROM grams GROUP BY 1, 2, 3, 4),
hits AS (SELECT h.id, r.k, h.n, sum(least(h.c, r.c)) AS m FROM cnt h JOIN cnt r ON h.k = -1 AND r.k >= 0 AND h.id = r.id AND h.n = r.n AND h.gram = r.gram GROUP BY 1, 2, 3)"""


SIDES_MULTI = f"SELECT id, -1 AS k, {sql_13a('prediction')} AS t FROM hyp UNION ALL SELECT id, 0, {sql_13a('reference')} FROM hyp UNION ALL SELECT id, 1, {sql_13a('reply')} FROM hyp"
SIDES_SINGLE = f"SELECT id, -1 AS k, {sql_13a('prediction')} AS t FROM hyp UNION ALL SELECT id, 0, {sql_13a('reference')} FROM hyp"
CORPUS_SQL = """clip AS (SELECT h.id, h.n, h.gram, least(h.c, max(r.c)) AS m FROM cnt h JOIN cnt r ON h.k = -1 AND r.k >= 0 AND h.id = r.id AND h.n = r.n AND h.gram = r.gram GROUP BY h.id, h.n, h.gram, h.c),
ms AS (SELECT n, sum(m) AS m FROM clip GROUP BY n), ps AS (SELECT n, sum(c) AS p FROM cnt WHERE k = -1 GROUP BY n),
lens AS (SELECT h.id, len(h.t) AS h, min(len(r.t)) AS shortest, min_by(len(r.t), abs(len(r.t) - len(h.t)) * 1000000 + len(r.t)) AS closest FROM toks h JOIN toks r ON h.id = r.id AND h.k = -1 AND r.k >= 0 GROUP BY h.id, h.t),
tot AS (SELECT sum(h) AS sys, sum(shortest) AS short, sum(closest) AS close FROM lens),
ord AS (SELECT ps.n, coalesce(m, 0) AS m, p FROM ps LEFT JOIN ms ON ps.n = ms.n)"""


# --- tokens ----------------------------------------------------------------------------------

@query(f"WITH t AS (SELECT doc_id, {sql_13a('text')} AS t FROM documents) SELECT doc_id, len(t) AS n, md5(array_to_string(t, ' ')) AS digest FROM t")
def tokenize_13a(spark, sf):
    """Whole documents tokenised by the mteval v13a convention."""
    t = table(spark, sf, "documents").select("doc_id", tx.tokenize_13a("text").alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n"), F.md5(F.array_join("t", " ")).alias("digest"))


NORM_SQL = "array_to_string(list_filter(regexp_split_to_array(translate(lower({0}), '" + tx.PUNCTUATION.replace("'", "''").replace("{", "{{").replace("}", "}}") + "', ''), '\\s+'), lambda w: w NOT IN ('', 'a', 'an', 'the')), ' ')"


@query(f"SELECT doc_id, md5({NORM_SQL.format('text')}) AS digest FROM documents")
def normalize_answers(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(tx.normalize_answer("text")).alias("digest"))


@query(f"""WITH t AS (SELECT item_id, {sql_words('text')} AS t FROM benchmark)
SELECT item_id, n, i, array_to_string(t[i:i + n - 1], ' ') AS gram FROM t, range(1, 5) a(n), unnest(range(1, len(t) - n + 2)) b(i)""")
def word_ngrams(spark, sf):
    """Word n-grams of orders 1 to 4 with their positions."""
    t = table(spark, sf, "benchmark").select("item_id", tx.words("text").alias("t"))
    orders = F.array(*[F.struct(F.lit(n).cast("long").alias("n"), tx.ngrams("t", n).alias("g")) for n in range(1, 5)])
    return t.select("item_id", F.inline(orders)).select("item_id", "n", F.posexplode("g").alias("p", "gram")).select(
        "item_id", "n", (F.col("p") + 1).cast("long").alias("i"), "gram")


@query(f"""WITH {HYP_SQL}, t AS (SELECT id, string_split(translate(lower(translate(prediction, '.,;:', '')), '/', ' '), ' ') AS a,
string_split(translate(lower(translate(reply, '.,;:', '')), '/', ' '), ' ') AS b FROM hyp)
SELECT id, round(len(list_intersect(list_distinct(a), list_distinct(b))) / len(list_distinct(list_concat(a, b))), 6) + 0.0 AS jaccard FROM t""", ("text_pairs",))
def token_jaccard(spark, sf):
    return hypotheses(spark, sf).select("id", r(tx.jaccard("prediction", "source")).alias("jaccard"))


# --- n-gram metrics --------------------------------------------------------------------------

@query(f"""WITH {HYP_SQL}, {grams_sql(4, SIDES_MULTI)}, {CORPUS_SQL}
SELECT round(exp(avg(ln(m / p))) * any_value(CASE WHEN sys / short > 1 THEN 1.0 ELSE exp(1 - short / sys) END), 6) AS bleu, round(any_value(sys / short), 6) AS length_ratio,
cast(any_value(sys) AS BIGINT) AS translation_length, cast(any_value(short) AS BIGINT) AS reference_length, string_agg(cast(cast(round(1e6 * m / p, 0) AS BIGINT) AS VARCHAR), ',' ORDER BY n) AS precisions FROM ord, tot""", ("text_pairs",))
def bleu(spark, sf):
    out = tg.bleu(hypotheses(spark, sf), "id")
    return rounded(out.select("bleu", "length_ratio", "translation_length", "reference_length",
                              joined(F.transform("precisions", lambda x: F.round(x * 1e6).cast("long"))).alias("precisions")))


@query(f"""WITH {HYP_SQL}, {grams_sql(4, SIDES_MULTI)}, {CORPUS_SQL}, g AS (SELECT id, id // 1000 % 3 AS grp FROM hyp),
gm AS (SELECT grp, n, sum(m) AS m FROM clip JOIN g USING (id) GROUP BY 1, 2), gp AS (SELECT grp, n, sum(c) AS p FROM cnt JOIN g USING (id) WHERE k = -1 GROUP BY 1, 2),
gl AS (SELECT grp, sum(h) AS sys, sum(shortest) AS short FROM lens JOIN g USING (id) GROUP BY 1)
SELECT grp, round(exp(avg(ln(m / p))) * any_value(CASE WHEN sys / short > 1 THEN 1.0 ELSE exp(1 - short / sys) END), 6) + 0.0 AS bleu FROM gm JOIN gp USING (grp, n) JOIN gl USING (grp) GROUP BY grp""", ("text_pairs",))
def bleu_by_group(spark, sf):
    """Found by name, one row per group of conversations."""
    rows = hypotheses(spark, sf).withColumn("grp", F.floor(F.col("id") / 1000) % 3)
    return rounded(evaluate(rows, ["bleu"], ["grp"]).select("grp", "bleu"))


SIDES_WORDS = f"SELECT id, -1 AS k, {sql_words('prediction')} AS t FROM hyp UNION ALL SELECT id, 0, {sql_words('reference')} FROM hyp UNION ALL SELECT id, 1, {sql_words('reply')} FROM hyp"


@query(f"""WITH {HYP_SQL}, {grams_sql(4, SIDES_WORDS)}, {CORPUS_SQL}
SELECT round(exp(avg(ln(m / p))) * any_value(CASE WHEN sys / short > 1 THEN 1.0 ELSE exp(1 - short / sys) END), 6) AS bleu, cast(any_value(sys) AS BIGINT) AS translation_length FROM ord, tot""", ("text_pairs",))
def bleu_words(spark, sf):
    """With a tokenizer of the caller's choice."""
    return rounded(tg.bleu(hypotheses(spark, sf), "id", tokenizer=tx.words).select("bleu", "translation_length"))


GROUPS_SQL = f"""{HYP_SQL}, {grams_sql(5, SIDES_MULTI)}, {CORPUS_SQL}, g AS (SELECT id, id // 1000 % 3 AS grp FROM hyp),
gm AS (SELECT grp, n, sum(m) AS m FROM clip JOIN g USING (id) WHERE n < 5 GROUP BY 1, 2), gp AS (SELECT grp, n, sum(c) AS p FROM cnt JOIN g USING (id) WHERE k = -1 AND n < 5 GROUP BY 1, 2),
gl AS (SELECT grp, sum(h) AS sys, sum(shortest) AS short, sum(closest) AS close FROM lens JOIN g USING (id) GROUP BY 1),
bl AS (SELECT grp, exp(avg(ln(m / p))) * any_value(CASE WHEN sys / short > 1 THEN 1.0 ELSE exp(1 - short / sys) END) AS bleu,
100 * exp(avg(ln(m / p))) * any_value(CASE WHEN sys >= close THEN 1.0 ELSE exp(1 - close / sys) END) AS score FROM gm JOIN gp USING (grp, n) JOIN gl USING (grp) GROUP BY grp),
ga AS (SELECT id, k, sum(c) AS a FROM cnt WHERE n < 5 GROUP BY 1, 2), gt AS (SELECT id, k, sum(m) AS tp FROM hits WHERE n < 5 GROUP BY 1, 2),
gr AS (SELECT r.id, r.k, coalesce(tp, 0) AS tp, greatest(h.a, r.a) AS a FROM ga h JOIN ga r ON h.id = r.id AND h.k = -1 AND r.k >= 0 LEFT JOIN gt ON gt.id = r.id AND gt.k = r.k),
gb AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tp / a DESC, k) AS rk FROM gr), gg AS (SELECT grp, sum(tp) / sum(a) AS google_bleu FROM gb JOIN g USING (id) WHERE rk = 1 GROUP BY grp),
nc AS (SELECT grp, n, gram, sum(c) AS c FROM cnt JOIN g USING (id) WHERE k >= 0 GROUP BY 1, 2, 3), nw AS (SELECT grp, sum(len(t)) AS w FROM toks JOIN g USING (id) WHERE k >= 0 GROUP BY 1),
ni AS (SELECT a.grp, a.n, a.gram, log2(coalesce(b.c, w) / a.c) AS i FROM nc a JOIN nw USING (grp) LEFT JOIN nc b ON b.grp = a.grp AND b.n = a.n - 1 AND a.n > 1 AND b.gram = array_to_string(string_split(a.gram, ' ')[1:a.n - 1], ' ')),
nh AS (SELECT r.id, r.k, r.n, sum(i * least(h.c, r.c)) AS gain FROM cnt h JOIN cnt r ON h.k = -1 AND r.k >= 0 AND h.id = r.id AND h.n = r.n AND h.gram = r.gram JOIN g ON g.id = r.id JOIN ni f ON f.grp = g.grp AND f.n = h.n AND f.gram = h.gram GROUP BY 1, 2, 3),
ns AS (SELECT r.id, r.k, n, len(h.t) AS h, len(r.t) AS r, greatest(len(h.t) - n + 1, 0) AS den FROM toks r JOIN toks h ON h.k = -1 AND r.k >= 0 AND h.id = r.id, range(1, 6) a(n)),
nb AS (SELECT ns.id, ns.n, h, r, den, coalesce(gain, 0) AS gain, row_number() OVER (PARTITION BY ns.id, ns.n ORDER BY CASE WHEN den > 0 THEN coalesce(gain, 0) / den ELSE 0 END DESC, coalesce(gain, 0) DESC, den DESC, r DESC) AS rk FROM ns LEFT JOIN nh ON nh.id = ns.id AND nh.k = ns.k AND nh.n = ns.n),
no AS (SELECT grp, n, sum(gain) AS gain, sum(den) AS den, sum(h) AS h, sum(r) AS r FROM nb JOIN g USING (id) WHERE rk = 1 GROUP BY 1, 2),
nx AS (SELECT grp, sum(CASE WHEN den > 0 THEN gain / den ELSE 0 END) * CASE WHEN sum(h) < sum(r) THEN exp(ln(0.5) / pow(ln(1.5), 2) * pow(ln(sum(h) / sum(r)), 2)) ELSE 1 END AS nist_mt FROM no GROUP BY grp)"""


@query(f"WITH {GROUPS_SQL} SELECT grp, round(bleu, 6) + 0.0 AS bleu, round(score, 6) + 0.0 AS score, round(google_bleu, 6) + 0.0 AS google_bleu, round(nist_mt, 6) + 0.0 AS nist_mt FROM bl JOIN gg USING (grp) JOIN nx USING (grp)", ("text_pairs",))
def ngram_report(spark, sf):
    """Four corpus metrics by name and group, read once."""
    rows = hypotheses(spark, sf).withColumn("grp", F.floor(F.col("id") / 1000) % 3)
    return rounded(evaluate(rows, ["bleu", "sacrebleu", "google_bleu", "nist_mt"], ["grp"]).select(
        "grp", "bleu", "score", "google_bleu", "nist_mt"))


REPEATED_SQL = f"""rep AS (SELECT id // 2000 AS key, prediction, reference FROM hyp), hyp2 AS (SELECT row_number() OVER () AS id, prediction, reference FROM rep)"""


@query(f"""WITH {HYP_SQL}, {REPEATED_SQL}, {grams_sql(4, SIDES_SINGLE.replace('hyp', 'hyp2'))}, tot AS (SELECT id, k, sum(c) AS a FROM cnt GROUP BY 1, 2), tp AS (SELECT id, sum(m) AS tp FROM hits GROUP BY 1),
per AS (SELECT r.id, coalesce(tp, 0) AS tp, greatest(h.a, r.a) AS a FROM tot h JOIN tot r ON h.id = r.id AND h.k = -1 AND r.k = 0 LEFT JOIN tp ON tp.id = r.id)
SELECT round(sum(tp) / sum(a), 6) AS google_bleu FROM per""", ("text_pairs",))
def google_bleu_repeated_ids(spark, sf):
    """Several texts share an id; each is scored for itself."""
    rows = single(spark, sf).withColumn("id", F.floor(F.col("id") / 2000))
    return rounded(tg.google_bleu(rows, "id"))


@query(f"""WITH {HYP_SQL}, {grams_sql(4, SIDES_SINGLE)}, {CORPUS_SQL}
SELECT round(exp(avg(ln((m + 1) / (p + 1)))) * any_value(CASE WHEN sys / short > 1 THEN 1.0 ELSE exp(1 - short / sys) END), 6) AS bleu FROM ord, tot""", ("text_pairs",))
def bleu_smoothed(spark, sf):
    return rounded(tg.bleu(single(spark, sf), "id", smooth=True).select("bleu"))


@query(f"""WITH {HYP_SQL}, {grams_sql(4, SIDES_MULTI)}, {CORPUS_SQL}
SELECT round(100 * exp(avg(ln(m / p))) * any_value(CASE WHEN sys >= close THEN 1.0 ELSE exp(1 - close / sys) END), 6) AS score,
string_agg(cast(m AS VARCHAR), ',' ORDER BY n) AS counts, string_agg(cast(p AS VARCHAR), ',' ORDER BY n) AS totals, cast(any_value(sys) AS BIGINT) AS sys_len, cast(any_value(close) AS BIGINT) AS ref_len FROM ord, tot""", ("text_pairs",))
def sacrebleu(spark, sf):
    out = tg.sacrebleu(hypotheses(spark, sf), "id")
    return rounded(out.select("score", joined("counts").alias("counts"), joined("totals").alias("totals"), "sys_len", "ref_len"))


@query(f"""WITH {HYP_SQL}, {grams_sql(4, SIDES_MULTI)}, tot AS (SELECT id, k, sum(c) AS a FROM cnt GROUP BY 1, 2), tp AS (SELECT id, k, sum(m) AS tp FROM hits GROUP BY 1, 2),
per AS (SELECT r.id, r.k, coalesce(tp, 0) AS tp, greatest(h.a, r.a) AS a FROM tot h JOIN tot r ON h.id = r.id AND h.k = -1 AND r.k >= 0 LEFT JOIN tp ON tp.id = r.id AND tp.k = r.k),
best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tp / a DESC, k) AS rk FROM per) SELECT round(sum(tp) / sum(a), 6) AS google_bleu FROM best WHERE rk = 1""", ("text_pairs",))
def google_bleu(spark, sf):
    return rounded(tg.google_bleu(hypotheses(spark, sf), "id"))


def _chars(c: str) -> str:
    return f"string_split(regexp_replace({c}, '\\s+', '', 'g'), '')"


SIDES_CHARS = f"SELECT id, -1 AS k, {_chars('prediction')} AS t FROM hyp UNION ALL SELECT id, 0, {_chars('reference')} FROM hyp UNION ALL SELECT id, 1, {_chars('reply')} FROM hyp"
CHRF_SQL = """sizes AS (SELECT id, k, n, sum(c) AS c FROM cnt GROUP BY 1, 2, 3),
st AS (SELECT r.id, r.k, r.n, coalesce(m, 0) AS m, h.c AS h, r.c AS r FROM sizes r JOIN sizes h ON h.k = -1 AND r.k >= 0 AND h.id = r.id AND h.n = r.n LEFT JOIN hits x ON x.id = r.id AND x.k = r.k AND x.n = r.n),
sc AS (SELECT id, k, avg(m / h) AS p, avg(m / r) AS q FROM st GROUP BY 1, 2), best AS (SELECT id, k FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE WHEN p + q > 0 THEN 5 * p * q / (4 * p + q) ELSE 0 END DESC, k) AS rk FROM sc) WHERE rk = 1),
corpus AS (SELECT n, sum(m) AS m, sum(h) AS h, sum(r) AS r FROM st JOIN best USING (id, k) GROUP BY n), pr AS (SELECT avg(m / h) AS p, avg(m / r) AS q FROM corpus)"""


@query(f"WITH {HYP_SQL}, {grams_sql(6, SIDES_CHARS, '')}, {CHRF_SQL} SELECT round(100 * 5 * p * q / (4 * p + q), 6) AS score FROM pr", ("text_pairs",))
def chrf(spark, sf):
    return rounded(tg.chrf(hypotheses(spark, sf), "id").select("score"))


def _marked_words(c: str) -> str:
    """Words, with a punctuation mark at a word's end, else at its start, as a token of its own."""
    mark = "[" + "".join("\\" + ch for ch in tx.PUNCTUATION).replace("'", "''") + "]"
    return (f"flatten(list_transform({sql_words(c)}, lambda w: CASE WHEN length(w) = 1 THEN [w] WHEN regexp_matches(w, '{mark}$') THEN [w[:-2], w[-1:]] "
            f"WHEN regexp_matches(w, '^{mark}') THEN [w[1:1], w[2:]] ELSE [w] END))")


def _renamed(sql: str, prefix: str) -> str:
    for name in ("toks", "grams", "cnt", "hits"):
        sql = re.sub(rf"\b{name}\b", prefix + name, sql)
    return sql


SIDES_MARKED = f"SELECT id, -1 AS k, {_marked_words('prediction')} AS t FROM hyp UNION ALL SELECT id, 0, {_marked_words('reference')} FROM hyp UNION ALL SELECT id, 1, {_marked_words('reply')} FROM hyp"
BOTH_KINDS_SQL = f"""{_renamed(grams_sql(6, SIDES_CHARS, ''), 'c_')}, {_renamed(grams_sql(2, SIDES_MARKED), 'w_')},
cnt AS (SELECT id, k, n, c FROM c_cnt UNION ALL SELECT id, k, n + 6, c FROM w_cnt), hits AS (SELECT * FROM c_hits UNION ALL SELECT id, k, n + 6, m FROM w_hits)"""


@query(f"WITH {HYP_SQL}, {BOTH_KINDS_SQL}, {CHRF_SQL} SELECT round(100 * 5 * p * q / (4 * p + q), 6) AS score, 6 AS char_order, 2 AS word_order, 2 AS beta FROM pr", ("text_pairs",))
def chrf_plus_plus(spark, sf):
    """chrF with word bigrams."""
    return rounded(tg.chrf(hypotheses(spark, sf), "id", word_order=2))


def _rouge(c: str) -> str:
    return f"list_filter(string_split(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"


SIDES_ROUGE = f"SELECT id, -1 AS k, {_rouge('prediction')} AS t FROM hyp UNION ALL SELECT id, 0, {_rouge('reference')} FROM hyp UNION ALL SELECT id, 1, {_rouge('reply')} FROM hyp"


@query(f"""WITH {HYP_SQL}, {grams_sql(2, SIDES_ROUGE)}, st AS (SELECT r.id, r.k, n, greatest(len(h.t) - n + 1, 0) AS h, greatest(len(r.t) - n + 1, 0) AS r FROM toks r JOIN toks h ON h.k = -1 AND r.k >= 0 AND h.id = r.id, range(1, 3) a(n)),
f AS (SELECT st.id, st.n, max(CASE WHEN m > 0 THEN 2 * (m / h) * (m / r) / (m / h + m / r) ELSE 0 END) AS f FROM st LEFT JOIN hits x ON x.id = st.id AND x.k = st.k AND x.n = st.n GROUP BY 1, 2)
SELECT id, round(max(f) FILTER (WHERE n = 1), 6) + 0.0 AS rouge1, round(max(f) FILTER (WHERE n = 2), 6) + 0.0 AS rouge2 FROM f GROUP BY id""", ("text_pairs",))
def rouge_ngrams(spark, sf):
    """Per row, against the better reference."""
    return rounded(tg.rouge_rows(hypotheses(spark, sf), "id", ("rouge1", "rouge2")))


@query()
def rouge_sequences(spark, sf):
    """Longest-common-subsequence scores (too slow in SQL; brute force in the tests)."""
    return rounded(tg.rouge(hypotheses(spark, sf), "id", ("rougeL", "rougeLsum")))


# --- error rates -----------------------------------------------------------------------------

# one byte per character for the byte-wise SQL function: letters outside ASCII become unused control characters
ACCENTS = "óéñèüäößíêçÉÑÈÜÄÖÓÊÍÇ"
CODES = " || ".join(f"chr({i})" for i in [*range(1, 9), *range(14, 27)])


def _bytes(c: str) -> str:
    return f"translate(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '{ACCENTS}', {CODES})"


@query(f"""WITH {HYP_SQL} SELECT round(sum(levenshtein({_bytes('prediction')}, {_bytes('reference')})) / sum(length(trim(regexp_replace(reference, '\\s+', ' ', 'g')))), 6) + 0.0 AS cer FROM hyp""", ("text_pairs",))
def character_error_rate(spark, sf):
    return rounded(evaluate(single(spark, sf), ["cer"]))


def changed_items(spark, sf):
    """Benchmark texts against themselves with words taken out and changed."""
    changed = F.replace(F.replace("text", F.lit(" the "), F.lit(" ")), F.lit("on"), F.lit("an"))
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), changed.alias("prediction"), F.col("text").alias("reference"))


# The table of the dynamic programme, one row per step of the recursion. What comes from the left in a row is a running
# extreme: min over k <= j of (step[k] + j - k) for edits, max over k <= j of step[k] for the common subsequence.
CHANGED_SQL = "changed AS (SELECT item_id AS id, replace(replace(text, ' the ', ' '), 'on', 'an') AS prediction, text AS reference FROM benchmark)"
EDITS_SQL = """dp AS (SELECT id, 0 AS i, range(0, len(r) + 1) AS line FROM pairs UNION ALL
SELECT id, i + 1, list_transform(range(0, len(r) + 1), lambda j: j + list_min(list_transform(range(0, j + 1), lambda k: CASE WHEN k = 0 THEN i + 1 ELSE least(line[k + 1] + 1, line[k] + (r[k] <> h[i + 1])::INT) - k END)))
FROM dp JOIN pairs USING (id) WHERE i < len(h)), last AS (SELECT id, line[len(r) + 1] AS d, len(h) AS h, len(r) AS r FROM dp JOIN pairs USING (id) WHERE i = len(h))"""
COMMON_SQL = """dp AS (SELECT id, 0 AS i, list_transform(range(0, len(r) + 1), lambda j: 0::BIGINT) AS line FROM pairs UNION ALL
SELECT id, i + 1, list_transform(range(0, len(r) + 1), lambda j: list_max(list_transform(range(0, j + 1), lambda k: CASE WHEN k = 0 THEN 0::BIGINT ELSE greatest(line[k + 1], line[k] + (r[k] = h[i + 1])::BIGINT) END)))
FROM dp JOIN pairs USING (id) WHERE i < len(h)), last AS (SELECT id, line[len(r) + 1] AS d, len(h) AS h, len(r) AS r FROM dp JOIN pairs USING (id) WHERE i = len(h))"""


@query(f"""WITH RECURSIVE {CHANGED_SQL}, pairs AS (SELECT id, {sql_words('prediction')} AS h, {sql_words('reference')} AS r FROM changed), {EDITS_SQL}
SELECT round(sum(d) / sum(r), 6) + 0.0 AS wer FROM last""")
def word_error_rate(spark, sf):
    """Word-level edit distance."""
    return rounded(evaluate(changed_items(spark, sf), ["wer"]))


@query()
def word_error_rate_conversations(spark, sf):
    """Word-level edit distance over all conversations (too slow in SQL; brute force in the tests)."""
    return rounded(evaluate(single(spark, sf), ["wer"]))


@query(f"""WITH RECURSIVE {CHANGED_SQL}, pairs AS (SELECT id, {_rouge('prediction')} AS h, {_rouge('reference')} AS r FROM changed), {COMMON_SQL}
SELECT id, round(2 * d / (h + r), 6) + 0.0 AS "rougeL" FROM last""")
def rouge_longest_sequence(spark, sf):
    """F-measure of the longest common subsequence, per text."""
    rows = tg.rouge_rows(changed_items(spark, sf), "id", ("rougeL",))
    return rounded(rows.select("id", "rougeL"))


@query(r"""SELECT round(avg((p = q)::INT), 6) + 0.0 AS exact_match FROM (SELECT translate(translate(lower(regexp_replace(event_type, 'c.', '', 'g')), '_-', ''), '0123456789', '') AS p,
translate(lower(regexp_replace(CASE WHEN value > 20 THEN upper(event_type) || '7' ELSE 'click!' END, 'c.', '', 'g')), '!0123456789', '') AS q FROM events)""")
def exact_match(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_type").alias("prediction"), F.when(
        F.col("value") > 20, F.concat(F.upper("event_type"), F.lit("7"))).otherwise("click!").alias("reference"))
    return rounded(evaluate(rows, [get("exact_match", regexes_to_ignore=["c."], ignore_case=True, ignore_punctuation=True, ignore_numbers=True)]))


# --- simplification --------------------------------------------------------------------------

def _13a_lower(c: str) -> str:
    return f"(CASE WHEN len({sql_13a(f'lower({c})')}) = 0 THEN [''] ELSE {sql_13a(f'lower({c})')} END)"


SIDES_SARI = f"SELECT id, -1 AS k, {_13a_lower('prediction')} AS t FROM hyp UNION ALL SELECT id, 0, {_13a_lower('reply')} FROM hyp UNION ALL SELECT id, 1, {_13a_lower('reference')} FROM hyp"
SARI_SQL = f"""{grams_sql(4, SIDES_SARI)},
g AS (SELECT id, n, gram, coalesce(sum(c) FILTER (WHERE k = 0), 0) AS s, coalesce(sum(c) FILTER (WHERE k = -1), 0) AS c, coalesce(sum(c) FILTER (WHERE k = 1), 0) AS r FROM cnt GROUP BY 1, 2, 3),
x AS (SELECT id, n, sum(CASE WHEN least(s, c) > 0 THEN least(s, c, r) / least(s, c) END) AS kp, count(*) FILTER (WHERE least(s, c) > 0) AS kn, sum(least(s, c, r)) AS kg, sum(least(s, r)) AS ka,
  sum(CASE WHEN s > c THEN greatest(s - c - r, 0) / (s - c) END) AS dp, count(*) FILTER (WHERE s > c) AS dn, count(*) FILTER (WHERE c > 0 AND s = 0 AND r > 0) AS ag, count(*) FILTER (WHERE c > 0 AND s = 0) AS an, count(*) FILTER (WHERE r > 0 AND s = 0) AS aa FROM g GROUP BY 1, 2),
y AS (SELECT id, n, CASE WHEN kn > 0 THEN kp / kn ELSE 1 END AS p, CASE WHEN ka > 0 THEN kg / ka ELSE 1 END AS q, CASE WHEN dn > 0 THEN dp / dn ELSE 1 END AS d, CASE WHEN an > 0 THEN ag / an ELSE 1 END AS e, CASE WHEN aa > 0 THEN ag / aa ELSE 1 END AS f FROM x),
z AS (SELECT id, CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END AS keep, d, CASE WHEN e + f > 0 THEN 2 * e * f / (e + f) ELSE 0 END AS ad FROM y),
rows_ AS (SELECT id, (sum(keep) + 4 - count(*)) / 4 AS keep, (sum(d) + 4 - count(*)) / 4 AS del, (sum(ad) + 4 - count(*)) / 4 AS ad FROM z GROUP BY id)"""


@query(f"WITH {HYP_SQL}, {SARI_SQL} SELECT id, round(keep, 9) AS keep, round(del, 9) AS del, round(ad, 9) AS \"add\", round((keep + del + ad) / 3, 9) AS sari FROM rows_", ("text_pairs",))
def sari_rows(spark, sf):
    """Keep, delete and add scores of every text."""
    return rounded(tg.sari_rows(single(spark, sf), "id"), 9)


@query(f"""WITH {HYP_SQL}, {SARI_SQL}, {grams_sql(4, SIDES_SINGLE).replace('toks', 'toks2').replace('grams', 'grams2').replace('cnt', 'cnt2').replace('hits', 'hits2')},
{CORPUS_SQL.replace('toks', 'toks2').replace('cnt', 'cnt2')}
SELECT (SELECT round(100 * avg((keep + del + ad) / 3), 6) FROM rows_) AS sari, (SELECT round(100 * exp(avg(ln(m / p))) * any_value(CASE WHEN sys >= close THEN 1.0 ELSE exp(1 - close / sys) END), 6) FROM ord, tot) AS sacrebleu,
(SELECT round(100 * avg(({NORM_SQL.format('prediction')} = {NORM_SQL.format('reference')})::INT), 6) + 0.0 FROM hyp) AS exact""", ("text_pairs",))
def split_and_rephrase(spark, sf):
    """sari, sacrebleu and normalised exact match together."""
    return rounded(tg.wiki_split(single(spark, sf), "id"))


@query(f"""WITH {HYP_SQL}, {grams_sql(5, SIDES_SINGLE)}, corpus AS (SELECT n, gram, sum(c) AS c FROM cnt WHERE k >= 0 GROUP BY 1, 2), words_ AS (SELECT sum(len(t)) AS w FROM toks WHERE k >= 0),
info AS (SELECT a.n, a.gram, log2(coalesce(b.c, w) / a.c) AS i FROM corpus a CROSS JOIN words_ LEFT JOIN corpus b ON b.n = a.n - 1 AND a.n > 1 AND b.gram = array_to_string(string_split(a.gram, ' ')[1:a.n - 1], ' ')),
num AS (SELECT h.n, sum(i * least(h.c, r.c)) AS num FROM cnt h JOIN cnt r ON h.k = -1 AND r.k = 0 AND h.id = r.id AND h.n = r.n AND h.gram = r.gram JOIN info f ON f.n = h.n AND f.gram = h.gram GROUP BY h.n),
den AS (SELECT n, sum(c) AS den FROM cnt WHERE k = -1 GROUP BY n), lens AS (SELECT sum(len(t)) FILTER (WHERE k = -1) / sum(len(t)) FILTER (WHERE k = 0) AS q FROM toks)
SELECT round(sum(num / den) * any_value(CASE WHEN q < 1 THEN exp(ln(0.5) / pow(ln(1.5), 2) * pow(ln(q), 2)) ELSE 1 END), 6) AS nist_mt FROM num JOIN den ON num.n = den.n, lens""", ("text_pairs",))
def nist(spark, sf):
    return rounded(tg.nist(single(spark, sf), "id"))


@query(f"""WITH {HYP_SQL}, {grams_sql(4, SIDES_SINGLE)}, {CORPUS_SQL}
SELECT round(100 * exp(avg(ln(m / p))) * any_value(CASE WHEN sys >= close THEN 1.0 ELSE exp(1 - close / sys) END), 6) AS bleu FROM ord, tot""", ("text_pairs",))
def suite_speech_translation(spark, sf):
    return rounded(benchmarks.xtreme_s(single(spark, sf), "covost2", "id"))


# --- question answering ----------------------------------------------------------------------

def questions(spark, sf):
    """Answers: the reference and the reply, none where the reference is long; every question stands a second time under an id without a prediction."""
    rows = hypotheses(spark, sf)
    answers = F.when(F.length("reference") > 1200, F.array().cast("array<string>")).otherwise(F.array("reference", "source"))
    refs = rows.select("id", answers.alias("answers"))
    refs = refs.unionByName(refs.withColumn("id", -1 - F.col("id")))
    texts = F.when(F.col("id") % 3 == 0, F.concat(F.lit("The "), "reference", F.lit("!"))).when(F.length("source") > 1200, "").otherwise(F.col("prediction"))
    preds = rows.select("id", texts.alias("prediction"), ((F.col("id") % 97) / 97).alias("no_answer_probability"))
    return preds, refs


SIDES_QA = f"""SELECT id, -1 AS k, string_split({NORM_SQL.format('p')}, ' ') AS t FROM q WHERE p IS NOT NULL UNION ALL SELECT id, 0, string_split({NORM_SQL.format('reference')}, ' ') FROM q WHERE has
UNION ALL SELECT id, 1, string_split({NORM_SQL.format('reply')}, ' ') FROM q WHERE has"""
QA_SQL = f"""q AS (SELECT id, reference, reply, length(reference) <= 1200 AS has, id % 97 / 97 AS na, CASE WHEN id % 3 = 0 THEN 'The ' || reference || '!' WHEN length(reply) > 1200 THEN '' ELSE prediction END AS p FROM hyp
UNION ALL SELECT -1 - id, reference, reply, length(reference) <= 1200, NULL, NULL FROM hyp),
sides AS (SELECT id, k, list_filter(t, lambda w: w <> '') AS t FROM ({SIDES_QA})),
{grams_sql(1, 'SELECT id, k, t FROM sides')},
f AS (SELECT r.id, max(CASE WHEN m > 0 THEN 2 * (m / len(h.t)) * (m / len(r.t)) / (m / len(h.t) + m / len(r.t)) ELSE 0 END) AS f1, max((h.t = r.t)::INT) AS em FROM toks r JOIN toks h ON h.k = -1 AND r.k >= 0 AND h.id = r.id LEFT JOIN hits x ON x.id = r.id AND x.k = r.k GROUP BY r.id)"""


@query(f"""WITH {HYP_SQL}, {QA_SQL} SELECT round(100 * avg(coalesce(em, 0)), 6) + 0.0 AS exact_match, round(100 * avg(coalesce(f1, 0)), 6) + 0.0 AS f1 FROM q LEFT JOIN f ON q.id = f.id""", ("text_pairs",))
def answer_scores(spark, sf):
    """Exact match and token F1 over all questions, unanswered ones included."""
    return rounded(qa.squad(*questions(spark, sf)))


@query(f"""WITH {HYP_SQL}, {QA_SQL} SELECT round(100 * avg(coalesce(em, 0)), 6) + 0.0 AS exact_match, round(100 * avg(coalesce(f1, 0)), 6) + 0.0 AS f1 FROM q LEFT JOIN f ON q.id = f.id""", ("text_pairs",))
def answer_scores_repeated_questions(spark, sf):
    """Every question twice under its id: each counts, and the scores stay what they are."""
    preds, refs = questions(spark, sf)
    return rounded(qa.squad(preds, refs.unionByName(refs)))


@query(f"""WITH {HYP_SQL}, {QA_SQL} SELECT abs(q.id) // 1000 % 3 AS grp, round(100 * avg(coalesce(em, 0)), 6) + 0.0 AS exact_match, round(100 * avg(coalesce(f1, 0)), 6) + 0.0 AS f1
FROM q LEFT JOIN f ON q.id = f.id GROUP BY 1""", ("text_pairs",))
def answer_scores_by_group(spark, sf):
    """Found by name, one row per group; answers and predictions in one frame."""
    preds, refs = questions(spark, sf)
    rows = refs.join(preds, "id", "left").withColumn("grp", F.floor(F.abs("id") / 1000) % 3)
    return rounded(evaluate(rows, ["squad"], ["grp"]))


@query(f"""WITH {HYP_SQL}, {QA_SQL} SELECT round(avg(coalesce(em, 0)), 6) + 0.0 AS exact_match, round(avg(coalesce(f1, 0)), 6) + 0.0 AS f1 FROM q LEFT JOIN f ON q.id = f.id""", ("text_pairs",))
def answer_scores_fraction(spark, sf):
    return rounded(qa.record(*questions(spark, sf)))


@query(f"""WITH {HYP_SQL}, {QA_SQL}, raw_ AS (SELECT q.id, has, na, p, CASE WHEN p IS NULL THEN NULL WHEN has THEN coalesce(em, 0) ELSE (p = '')::INT END AS em, CASE WHEN p IS NULL THEN NULL WHEN has THEN coalesce(f1, 0) ELSE (p = '')::INT END AS f1 FROM q LEFT JOIN f ON q.id = f.id),
s AS (SELECT *, CASE WHEN p IS NULL THEN 0 WHEN na > 0.6 THEN (NOT has)::INT ELSE em END AS e2, CASE WHEN p IS NULL THEN 0 WHEN na > 0.6 THEN (NOT has)::INT ELSE f1 END AS f2 FROM raw_),
sweep AS (SELECT na, id, row_number() OVER w AS i, sum(CASE WHEN has THEN em WHEN p <> '' THEN -1 ELSE 0 END) OVER w AS re, sum(CASE WHEN has THEN f1 WHEN p <> '' THEN -1 ELSE 0 END) OVER w AS rf FROM raw_ WHERE p IS NOT NULL WINDOW w AS (ORDER BY na, id ROWS UNBOUNDED PRECEDING)),
b AS (SELECT greatest(max(re), 0) AS be, greatest(max(rf), 0) AS bf, count(*) AS n, CASE WHEN max(re) > 0 THEN (SELECT na FROM sweep ORDER BY re DESC, i LIMIT 1) ELSE 0.0 END AS te, CASE WHEN max(rf) > 0 THEN (SELECT na FROM sweep ORDER BY round(rf, 9) DESC, i LIMIT 1) ELSE 0.0 END AS tf FROM sweep)
SELECT round(100 * avg(e2), 6) + 0.0 AS exact, round(100 * avg(f2), 6) + 0.0 AS f1, count(*) AS total, round(100 * avg(e2) FILTER (WHERE has), 6) + 0.0 AS "HasAns_exact", round(100 * avg(f2) FILTER (WHERE has), 6) + 0.0 AS "HasAns_f1", count(*) FILTER (WHERE has) AS "HasAns_total",
round(100 * avg(e2) FILTER (WHERE NOT has), 6) + 0.0 AS "NoAns_exact", round(100 * avg(f2) FILTER (WHERE NOT has), 6) + 0.0 AS "NoAns_f1", count(*) FILTER (WHERE NOT has) AS "NoAns_total",
round(any_value(100 * ((SELECT count(*) FROM q WHERE NOT has) + be) / n), 6) + 0.0 AS best_exact, round(any_value(te), 6) + 0.0 AS best_exact_thresh, round(any_value(100 * ((SELECT count(*) FROM q WHERE NOT has) + bf) / n), 6) + 0.0 AS best_f1, round(any_value(tf), 6) + 0.0 AS best_f1_thresh FROM s, b""", ("text_pairs",))
def answer_scores_unanswerable(spark, sf):
    """With unanswerable questions, a no-answer threshold and the best thresholds."""
    preds, refs = questions(spark, sf)
    return rounded(qa.squad_v2(preds, refs, threshold=0.6))


@query(f"""WITH {HYP_SQL}, {QA_SQL}, raw_ AS (SELECT q.id, has, na, CASE WHEN has THEN coalesce(em, 0) ELSE 0 END AS em, CASE WHEN has THEN coalesce(f1, 0) ELSE 0 END AS f1, has::INT AS o FROM q LEFT JOIN f ON q.id = f.id WHERE p IS NOT NULL),
s AS (SELECT na, count(*) AS c, sum(em) AS em, sum(f1) AS f1, sum(o) AS o FROM raw_ GROUP BY na), w AS (SELECT *, sum(c) OVER x AS seen, sum(em) OVER x AS ce, sum(f1) OVER x AS cf, sum(o) OVER x AS co FROM s WINDOW x AS (ORDER BY na ROWS UNBOUNDED PRECEDING)),
n AS (SELECT count(*) AS n FROM q WHERE has)
SELECT round(100 * sum(ce / seen * em / n), 6) + 0.0 AS pr_exact_ap, round(100 * sum(cf / seen * f1 / n), 6) + 0.0 AS pr_f1_ap, round(100 * sum(co / seen * o / n), 6) + 0.0 AS pr_oracle_ap FROM w, n""", ("text_pairs",))
def answer_precision_recall(spark, sf):
    """Average precision along the no-answer probability."""
    return rounded(qa.answer_precision_recall(*questions(spark, sf)))


def span_lists(spark, sf):
    """Sentences as spans: the gold ones of the reference, predicted ones of the changed text."""
    rows = hypotheses(spark, sf)
    sentences = lambda c: F.filter(F.split(c, r"\."), lambda s: F.trim(s) != "")
    return (rows.select("id", sentences(F.col("prediction")).alias("prediction")),
            rows.select("id", sentences(F.col("reference")).alias("answers")))


def _sentences(c: str) -> str:
    return f"list_filter(string_split({c}, '.'), lambda s: trim(s, ' ') <> '')"


def _tokset(c: str) -> str:
    return f"list_distinct(string_split(translate(lower(translate({c}, '.,;:', '')), '/', ' '), ' '))"


SPAN_SQL = f"""sp AS (SELECT id, {_sentences('prediction')} AS p, {_sentences('reference')} AS g FROM hyp),
ps AS (SELECT id, i, p[i] AS s, {_tokset('p[i]')} AS t FROM sp, unnest(range(1, len(p) + 1)) b(i)), gs AS (SELECT id, i, g[i] AS s, {_tokset('g[i]')} AS t FROM sp, unnest(range(1, len(g) + 1)) b(i)),
pr AS (SELECT ps.id, ps.i AS a, gs.i AS b, len(list_intersect(ps.t, gs.t)) / len(list_distinct(list_concat(ps.t, gs.t))) >= 0.5 AS hit, {NORM_SQL.format('ps.s')} = {NORM_SQL.format('gs.s')} AS same FROM ps JOIN gs ON ps.id = gs.id),
per AS (SELECT sp.id, len(sp.p) AS np, len(sp.g) AS ng, count(DISTINCT b) FILTER (WHERE hit) AS tp, count(DISTINCT a) FILTER (WHERE hit) AS ok, coalesce(max(same::INT), 0) AS em FROM sp LEFT JOIN pr ON sp.id = pr.id GROUP BY 1, 2, 3),
sc AS (SELECT id, CASE WHEN tp + np - ok > 0 THEN tp / (tp + np - ok) END AS p, CASE WHEN ng > 0 THEN tp / ng END AS r, em FROM per)"""


@query(f"WITH {HYP_SQL}, {SPAN_SQL} SELECT id, round(p, 6) + 0.0 AS precision, round(r, 6) + 0.0 AS recall, cast(em AS DOUBLE) AS exact FROM sc", ("text_pairs",))
def span_scores(spark, sf):
    preds, refs = span_lists(spark, sf)
    return rounded(qa.span_scores(refs.join(preds, "id"), "id"))


@query(f"""WITH {HYP_SQL}, {SPAN_SQL}, o AS (SELECT r, max(p) OVER (ORDER BY r DESC, p DESC, id DESC ROWS UNBOUNDED PRECEDING) AS best, row_number() OVER (ORDER BY r, p, id) AS i FROM sc),
seg AS (SELECT r, best, lead(r) OVER w AS r1, lead(best) OVER w AS p1, i FROM o WINDOW w AS (ORDER BY i))
SELECT (SELECT round(100 * avg(em), 6) + 0.0 FROM sc) AS exact_match, (SELECT round(100 * avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END), 6) + 0.0 FROM sc) AS f1,
round(coalesce(sum((r1 - r) * (p1 + best) / 2), 0), 6) + 0.0 AS aupr, (SELECT round(coalesce(min_by(best, i), 0), 6) + 0.0 FROM o WHERE r >= 0.8) AS prec_at_80_recall, (SELECT round(coalesce(min_by(best, i), 0), 6) + 0.0 FROM o WHERE r >= 0.9) AS prec_at_90_recall FROM seg""", ("text_pairs",))
def contract_spans(spark, sf):
    """Span precision and recall per question, the area under their curve and precision at recall."""
    preds, refs = span_lists(spark, sf)
    return rounded(qa.cuad(preds, refs))
