"""DuckDB SQL for every query in ``catalog.QUERIES`` that SQL can express.

Each statement recomputes the answer from the raw tables with no Spark ML
code: cleaning with the same three patterns, Java-style tokenizing, the stop
word list inlined, the vocabulary by (count desc, term asc), IDF as
``ln((N+1)/(df+1))``, Naive Bayes in closed form, chi-square from counts.
Column names and types follow the Spark side; doubles are rounded to 6 places.
"""

from __future__ import annotations

from ..functions.stopwords import sql_list_literal
from ..operators.lemma import EXCEPTIONS, SUFFIX_RULES

SW = sql_list_literal()


def CLEAN(x: str) -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace({x}, '<[^>]+>', '', 'g'), "
            f"'[^a-zA-Z ]', '', 'g'), '\\b\\w{{1,2}}\\b', '', 'g')")


def TOKENIZE(x: str) -> str:
    """Java ``lower().split("\\s")``: inner empties kept, trailing ones dropped."""
    return (f"(CASE WHEN regexp_full_match({x}, '\\s+') THEN []::VARCHAR[] "
            f"ELSE string_split_regex(regexp_replace(lower({x}), '\\s+$', ''), '\\s') END)")


def NO_STOP(x: str) -> str:
    return f"list_filter({x}, lambda t: NOT list_contains({SW}, lower(t)))"


def LEMMAS(x: str) -> str:
    """Each space-separated token by the suffix rules and exceptions."""
    cases = " ".join(f"WHEN t = '{w}' THEN '{v}'" for w, v in reversed(EXCEPTIONS.items()))
    for pattern, replacement in SUFFIX_RULES:
        with_sql = replacement.replace("$1", "\\1")
        cases += f" WHEN regexp_matches(t, '{pattern}') THEN regexp_replace(t, '{pattern}', '{with_sql}')"
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda t: CASE {cases} ELSE t END), ' ')"


DOCS = """docs AS (
  SELECT doc_id, text, lang AS emotion,
         CASE ((doc_id % 10) + 10) % 10 WHEN 8 THEN 'test' WHEN 9 THEN 'val' ELSE 'train' END AS split
  FROM documents)"""

LABEL_IDS = """label_ids AS (
  SELECT emotion, CAST(row_number() OVER (ORDER BY n DESC, emotion) - 1 AS INTEGER) AS label
  FROM (SELECT emotion, count(*) AS n FROM docs WHERE split = 'train' GROUP BY emotion))"""

PREPARED = f"""prepared0 AS MATERIALIZED (
  SELECT d.doc_id, d.text, d.emotion, d.split, l.label, {LEMMAS(CLEAN('d.text'))} AS text_c
  FROM docs d JOIN label_ids l USING (emotion)),
weights AS (
  SELECT label, count(*) AS n, count(*) / sum(count(*)) OVER () AS weight,
         sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight_inverse
  FROM prepared0 WHERE split = 'train' GROUP BY label),
prepared AS MATERIALIZED (
  SELECT p.*, w.weight FROM prepared0 p JOIN weights w USING (label))"""

BASE = f"WITH {DOCS},\n{LABEL_IDS},\n{PREPARED}"

# Per-document token lists of the feature sets: G1 (cleaned, no stop words), G3 (raw).
G1_TOKENS = f"""g1tok AS MATERIALIZED (
  SELECT doc_id, split, label, weight, {NO_STOP(TOKENIZE('text_c'))} AS toks FROM prepared)"""
G3_TOKENS = f"""g3tok AS MATERIALIZED (
  SELECT doc_id, split, label, weight, {TOKENIZE('text')} AS toks FROM prepared)"""


def FEATURES(tok: str, p: str) -> str:
    """Vocabulary (top 1000 on train), term counts, IDF on train, TF-IDF for one token CTE."""
    return f"""{p}_terms AS MATERIALIZED (
  SELECT doc_id, split, term, count(*) AS n
  FROM (SELECT doc_id, split, unnest(toks) AS term FROM {tok}) GROUP BY doc_id, split, term),
{p}_vocab AS MATERIALIZED (
  SELECT term, count, idx FROM (
    SELECT term, CAST(sum(n) AS BIGINT) AS count,
           CAST(row_number() OVER (ORDER BY sum(n) DESC, term) - 1 AS INTEGER) AS idx
    FROM {p}_terms WHERE split = 'train' GROUP BY term) WHERE idx < 1000),
{p}_tf AS MATERIALIZED (
  SELECT t.doc_id, v.idx AS feature, CAST(sum(t.n) AS BIGINT) AS tf
  FROM {p}_terms t JOIN {p}_vocab v USING (term) GROUP BY t.doc_id, v.idx),
{p}_ntrain AS (SELECT count(*) AS n FROM prepared WHERE split = 'train'),
{p}_df AS (
  SELECT f.feature, count(*) AS dfc
  FROM {p}_tf f JOIN prepared p USING (doc_id) WHERE p.split = 'train' GROUP BY f.feature),
{p}_idf AS (
  SELECT v.idx AS feature, v.term, ln((nt.n + 1.0) / (coalesce(d.dfc, 0) + 1.0)) AS idf,
         coalesce(d.dfc, 0) AS dfc, nt.n AS ntrain
  FROM {p}_vocab v LEFT JOIN {p}_df d ON d.feature = v.idx, {p}_ntrain nt),
{p}_tfidf AS (
  SELECT f.doc_id, f.feature, f.tf, f.tf * i.idf AS value
  FROM {p}_tf f JOIN {p}_idf i USING (feature))"""


def DOC_SUMMARY(p: str) -> str:
    return f"""SELECT p.doc_id, p.split, p.label, round(p.weight, 6) AS weight,
       CAST(count(x.feature) FILTER (WHERE x.value <> 0) AS BIGINT) AS nnz,
       round(coalesce(sum(x.value), 0.0), 6) AS total
FROM prepared p LEFT JOIN {p}_tfidf x USING (doc_id)
GROUP BY p.doc_id, p.split, p.label, p.weight"""


PAIRS = """pairs AS (
  SELECT CAST(quality AS DOUBLE) AS label, CAST(1 - toxic AS DOUBLE) AS prediction FROM labels)"""


def PER_CLASS(pairs: str = "pairs") -> str:
    return f"""conf AS (
  SELECT label, prediction, count(*) AS n FROM {pairs} GROUP BY label, prediction),
per AS (
  SELECT class, sum(act) AS actual_n, sum(pred) AS predicted_n, sum(tp) AS tp FROM (
    SELECT label AS class, CAST(n AS DOUBLE) AS act, 0.0 AS pred,
           CAST(CASE WHEN label = prediction THEN n ELSE 0 END AS DOUBLE) AS tp FROM conf
    UNION ALL
    SELECT prediction AS class, 0.0 AS act, CAST(n AS DOUBLE) AS pred, 0.0 AS tp FROM conf)
  GROUP BY class),
pr AS (
  SELECT *, CASE WHEN predicted_n = 0 THEN 0.0 ELSE tp / predicted_n END AS precision,
            CASE WHEN actual_n = 0 THEN 0.0 ELSE tp / actual_n END AS recall FROM per),
pcm AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                 ELSE 2 * precision * recall / (precision + recall) END AS f_measure FROM pr)"""


WEIGHTED_SELECT = """SELECT round(sum(actual_n * precision) / sum(actual_n), 6) AS precision,
       round(sum(actual_n * recall) / sum(actual_n), 6) AS recall,
       round(sum(actual_n * f_measure) / sum(actual_n), 6) AS f1Score,
       round(sum(tp) / sum(actual_n), 6) AS accuracy
FROM pcm"""

SWAPPED_PAIRS = """spairs AS (SELECT prediction AS label, label AS prediction FROM pairs)"""


def _q(body: str) -> str:
    return body.strip()


SQL: dict[str, str] = {}

SQL["parse_labeled_line"] = _q("""
WITH parts AS (
  SELECT doc_id, lang, string_split(text, chr(10)) AS ls FROM documents),
lines AS (
  SELECT doc_id, lang, CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS line_no, unnest(ls) AS line FROM parts),
v AS (SELECT doc_id, line_no, string_split(line || ';' || lang, ';') AS p FROM lines)
SELECT doc_id, line_no, p[1] AS text, p[2] AS emotion FROM v
""")

SQL["strip_tags"] = "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS stripped FROM pages"

SQL["keep_letters"] = "SELECT doc_id, regexp_replace(text, '[^a-zA-Z ]', '', 'g') AS letters FROM documents"

SQL["drop_short_words"] = _q("""
SELECT conv_id, turn,
       regexp_replace(regexp_replace(text, '[^a-zA-Z ]', '', 'g'), '\\b\\w{1,2}\\b', '', 'g') AS dropped
FROM conversations
""")

SQL["clean_text"] = f"SELECT doc_id, {CLEAN('text')} AS text_c FROM documents"

SQL["lemmatize"] = f"SELECT doc_id, {LEMMAS(CLEAN('text'))} AS lemmatized FROM documents"

SQL["tokenize"] = _q(f"""
WITH t AS (SELECT doc_id, {TOKENIZE('text')} AS w FROM documents)
SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS token FROM t
""")

SQL["remove_stopwords"] = _q(f"""
WITH t AS (SELECT doc_id, {NO_STOP(TOKENIZE(CLEAN('text')))} AS w FROM documents)
SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS token FROM t
""")

SQL["ngrams"] = _q(f"""
WITH t AS (SELECT doc_id, {NO_STOP(TOKENIZE(CLEAN('text')))} AS f FROM documents),
g AS (SELECT doc_id, list_transform(generate_series(1, len(f) - 1), lambda i: f[i] || ' ' || f[i + 1]) AS w
      FROM t)
SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS ngram FROM g
""")

SQL["label_index"] = f"{BASE}\nSELECT label, emotion FROM label_ids"

SQL["split_sizes"] = _q(f"""
WITH {DOCS}
SELECT split, count(*) AS n_rows, CAST(3 AS BIGINT) AS n_cols FROM docs GROUP BY split
""")

SQL["class_counts"] = f"WITH {DOCS}\nSELECT split, emotion, count(*) AS n FROM docs GROUP BY split, emotion"

SQL["filter_class"] = f"{BASE}\nSELECT doc_id, split, emotion, label FROM prepared WHERE label = 0"

SQL["class_weights"] = f"{BASE}\nSELECT label, n, round(weight, 6) AS weight FROM weights"

SQL["class_weights_inverse"] = f"{BASE}\nSELECT label, n, round(weight_inverse, 6) AS weight FROM weights"

SQL["apply_class_weight"] = f"{BASE}\nSELECT doc_id, split, label, round(weight, 6) AS weight FROM prepared"

SQL["drop_null_rows"] = _q("""
SELECT d.doc_id, d.lang, l.quality, l.toxic
FROM documents d JOIN labels l USING (doc_id)
WHERE d.doc_id IS NOT NULL AND d.lang IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL
""")

SQL["label_names"] = f"{BASE}\nSELECT doc_id, label, emotion AS name FROM prepared"

SQL["preview"] = f"{BASE}\nSELECT doc_id, emotion, label, split, text_c FROM prepared ORDER BY doc_id LIMIT 5"

SQL["weighted_metrics"] = f"WITH {PAIRS},\n{PER_CLASS()}\n{WEIGHTED_SELECT}"

SQL["weighted_metrics_swapped"] = f"WITH {PAIRS},\n{SWAPPED_PAIRS},\n{PER_CLASS('spairs')}\n{WEIGHTED_SELECT}"

SQL["weighted_metrics_beta2"] = (f"WITH {PAIRS},\n{PER_CLASS()}\n{WEIGHTED_SELECT}").replace(
    "precision + recall = 0 THEN 0.0", "4 * precision + recall = 0 THEN 0.0").replace(
    "2 * precision * recall / (precision + recall)", "5 * precision * recall / (4 * precision + recall)")

SQL["accuracy"] = _q(f"""
WITH {PAIRS}
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pairs
""")

SQL["confusion_matrix"] = f"WITH {PAIRS}\nSELECT label, prediction, count(*) AS n FROM pairs GROUP BY label, prediction"

SQL["per_class_metrics"] = _q(f"""
WITH {PAIRS},
{PER_CLASS()}
SELECT class, round(actual_n, 6) AS actual_n, round(predicted_n, 6) AS predicted_n, round(tp, 6) AS tp,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f_measure, 6) AS f_measure
FROM pcm
""")

SQL["distinct_labels"] = _q(f"""
WITH {PAIRS}
SELECT DISTINCT id FROM (SELECT label AS id FROM pairs UNION ALL SELECT prediction AS id FROM pairs)
""")

SQL["union_results"] = _q(f"""
WITH {PAIRS},
{SWAPPED_PAIRS},
r AS (WITH {PER_CLASS()} {WEIGHTED_SELECT}),
s AS (WITH {PER_CLASS('spairs')} {WEIGHTED_SELECT})
SELECT *, 'right' AS orientation FROM r
UNION ALL
SELECT *, 'swapped' AS orientation FROM s
""")

G1 = f"{BASE},\n{G1_TOKENS},\n{FEATURES('g1tok', 'g1')}"
G3 = f"{BASE},\n{G3_TOKENS},\n{FEATURES('g3tok', 'g3')}"

SQL["vocabulary"] = f"{G1}\nSELECT term, count, idx FROM g1_vocab"

SQL["term_counts"] = f"{G1}\nSELECT doc_id, feature, tf FROM g1_tf"

SQL["idf"] = f"{G1}\nSELECT feature, term, round(idf, 6) AS idf FROM g1_idf"

SQL["tfidf"] = f"{G1}\nSELECT doc_id, feature, round(value, 6) AS tfidf FROM g1_tfidf WHERE value <> 0"

SQL["features_clean_tfidf"] = f"{G1}\n{DOC_SUMMARY('g1')}"

SQL["features_raw_tfidf"] = f"{G3}\n{DOC_SUMMARY('g3')}"

SQL["hashed_bigram_totals"] = _q(f"""
{BASE},
{G1_TOKENS}
SELECT doc_id, CAST(greatest(len(toks) - 1, 0) AS BIGINT) AS n_bigrams FROM g1tok
""")

SQL["features_hashed_bigrams"] = _q(f"""
{BASE},
{G1_TOKENS}
SELECT split, count(*) AS n_docs, CAST(sum(greatest(len(toks) - 1, 0)) AS BIGINT) AS n_bigrams
FROM g1tok GROUP BY split
""")

SQL["feature_roundtrip"] = _q(f"""
{G3},
nz AS (SELECT doc_id, count(*) AS k FROM g3_tf GROUP BY doc_id)
SELECT p.split, count(*) AS n_rows, CAST(coalesce(sum(nz.k), 0) AS BIGINT) AS nnz
FROM prepared p LEFT JOIN nz USING (doc_id) GROUP BY p.split
""")

# Chi-square per feature on training rows.  A feature's categories are its
# distinct TF-IDF values, zero included; with idf > 0 they are the distinct
# term counts, with idf = 0 (term in every row) there is one category.
# statistic = N * sum(o^2 / (row_total * label_total)) - N over non-empty cells.
def CHI2(p: str) -> str:
    """CTEs ending in ``chi2 (feature, dof, statistic)`` for feature set ``p`` on training rows."""
    return f"""tr AS (SELECT doc_id, label FROM prepared WHERE split = 'train'),
ntr AS (SELECT count(*) AS n, count(DISTINCT label) AS k FROM tr),
lab AS (SELECT label, count(*) AS c FROM tr GROUP BY label),
present AS (
  SELECT f.feature, CASE WHEN i.dfc < i.ntrain THEN f.tf ELSE 0 END AS v, tr.label
  FROM {p}_tf f JOIN tr USING (doc_id) JOIN {p}_idf i USING (feature)),
nonzero AS (
  SELECT feature, v, label, count(*) AS o FROM present WHERE v > 0 GROUP BY feature, v, label),
zero AS (
  SELECT i.feature, 0 AS v, lab.label,
         lab.c - coalesce((SELECT count(*) FROM present p
                           WHERE p.feature = i.feature AND p.label = lab.label AND p.v > 0), 0) AS o
  FROM {p}_idf i, lab),
cells AS (SELECT * FROM nonzero UNION ALL SELECT * FROM zero WHERE o > 0),
rowt AS (SELECT feature, v, sum(o) AS r FROM cells GROUP BY feature, v),
stat AS (
  SELECT c.feature, sum(c.o * c.o / (rowt.r * lab.c)) AS s
  FROM cells c JOIN rowt USING (feature, v) JOIN lab USING (label) GROUP BY c.feature),
nv AS (SELECT feature, count(*) AS nvals FROM rowt GROUP BY feature),
chi2 AS (
  SELECT stat.feature, CAST((nv.nvals - 1) * (ntr.k - 1) AS BIGINT) AS dof,
         CASE WHEN (nv.nvals - 1) * (ntr.k - 1) = 0 THEN 0.0 ELSE ntr.n * stat.s - ntr.n END AS statistic
  FROM stat JOIN nv USING (feature), ntr)"""


# log of the chi-square tail with d degrees of freedom at x: z = x / 2, a = d / 2.  Below a + 1 from the series of
# the lower tail; above, as the finite sum e^-z z^(a-1) / gamma(a) + ... down to gamma(1) (even d) or to
# erfc(sqrt z) (odd d), added up by logarithms.  erfc is 1 - its series below z = 20 and asymptotic beyond.
def LOG_P(p: str) -> str:
    """CTE ``logp (feature, dof, statistic, log_p)`` after ``CHI2``."""
    return f"""az AS (SELECT feature, dof, statistic, dof / 2.0 AS a, statistic / 2.0 AS z FROM chi2),
small AS (
  SELECT feature, ln(1 - least(1 - 1e-16, sum(exp(-z + (a + i) * ln(z) - lgamma(a + i + 1))))) AS log_p
  FROM az, generate_series(0, 3000) AS g(i) WHERE dof > 0 AND z > 0 AND z < a + 1 GROUP BY feature),
erfc AS (
  SELECT feature, CASE WHEN z >= 20 THEN -z - 0.5 * ln(pi() * z) + ln(1 - 1 / (2 * z) + 3 / (4 * z ^ 2)
              - 15 / (8 * z ^ 3) + 105 / (16 * z ^ 4) - 945 / (32 * z ^ 5))
         ELSE ln(greatest(1e-300, 1 - (SELECT sum(exp(-z + (0.5 + i) * ln(z) - lgamma(i + 1.5)))
                                       FROM generate_series(0, 200) AS g(i)))) END AS t
  FROM az WHERE dof > 0 AND z >= a + 1 AND dof % 2 = 1),
terms AS (
  SELECT feature, -z + (a - j) * ln(z) - lgamma(a - j + 1) AS t
  FROM az, generate_series(1, 20000) AS g(j) WHERE dof > 0 AND z >= a + 1 AND a - j >= 0
  UNION ALL SELECT feature, t FROM erfc),
top AS (SELECT feature, max(t) AS m FROM terms GROUP BY feature),
large AS (SELECT terms.feature, max(m) + ln(sum(exp(t - m))) AS log_p FROM terms JOIN top USING (feature)
          GROUP BY terms.feature),
logp AS (
  SELECT az.feature, az.dof, az.statistic, coalesce(small.log_p, large.log_p, 0.0) AS log_p
  FROM az LEFT JOIN small USING (feature) LEFT JOIN large USING (feature))"""


SQL["chi2_statistic"] = _q(f"""
{G3},
{CHI2('g3')},
{LOG_P('g3')}
SELECT feature, dof, round(statistic, 6) AS statistic, round(log_p, 4) + 0.0 AS log_p FROM logp
""")

# Selection by log p-value, or by statistic per degree of freedom; ties by index, G1 features.  Equal tables can
# differ in the last bit by the order of summation, so both are compared at 1e-9 before the index decides.
SELECTED = {
    "chi2": (f"{CHI2('g1')},\n{LOG_P('g1')}", "logp", "round(log_p, 9)"),
    "chi2_by_statistic": (CHI2('g1'), "chi2", "round(CASE WHEN dof > 0 THEN statistic / dof ELSE 0.0 END, 9) DESC"),
}
for _name, (_ctes, _from, _order) in SELECTED.items():
    _ranked = f"""{G1},
{_ctes},
ranked AS (SELECT feature, row_number() OVER (ORDER BY {_order}, feature) AS rk FROM {_from})"""
    _query = "chi2_selection" if _name == "chi2" else "chi2_selection_by_statistic"
    SQL[_query] = f"""{_ranked}
SELECT r.feature, v.term FROM ranked r JOIN g1_vocab v ON v.idx = r.feature WHERE r.rk <= 300"""
    SQL[f"features_{_name}"] = f"""{_ranked},
sel_tfidf AS (SELECT x.* FROM g1_tfidf x JOIN ranked USING (feature) WHERE rk <= 300)
{DOC_SUMMARY('sel')}"""

# Multinomial Naive Bayes on G3 TF-IDF with class-share weights, smoothing 1.
NB = f"""{G3},
classes AS (SELECT label, sum(weight) AS w FROM prepared WHERE split = 'train' GROUP BY label),
tot AS (SELECT sum(w) AS w, count(*) AS k FROM classes),
nfeat AS (SELECT count(*) AS m FROM g3_vocab),
pi AS (SELECT c.label, ln(c.w + 1.0) - ln(tot.w + tot.k * 1.0) AS pi FROM classes c, tot),
fsum AS (
  SELECT p.label, x.feature, sum(p.weight * x.value) AS s
  FROM g3_tfidf x JOIN prepared p USING (doc_id) WHERE p.split = 'train' GROUP BY p.label, x.feature),
csum AS (SELECT label, sum(s) AS s FROM fsum GROUP BY label),
theta AS (
  SELECT c.label, v.idx AS feature,
         ln(coalesce(f.s, 0.0) + 1.0) - ln(coalesce(cs.s, 0.0) + nfeat.m * 1.0) AS theta
  FROM classes c CROSS JOIN g3_vocab v CROSS JOIN nfeat
  LEFT JOIN fsum f ON f.label = c.label AND f.feature = v.idx
  LEFT JOIN csum cs ON cs.label = c.label)"""

SQL["nb_model"] = _q(f"""
{NB}
SELECT label, -1 AS feature, round(pi, 6) AS log_prob FROM pi
UNION ALL
SELECT label, feature, round(theta, 6) AS log_prob FROM theta
""")

SQL["nb_predict"] = _q(f"""
{NB},
held AS (SELECT doc_id, split FROM prepared WHERE split <> 'train'),
dot AS (
  SELECT x.doc_id, t.label, sum(t.theta * x.value) AS s
  FROM g3_tfidf x JOIN held USING (doc_id) JOIN theta t USING (feature) GROUP BY x.doc_id, t.label),
score AS (
  SELECT h.doc_id, h.split, pi.label, pi.pi + coalesce(dot.s, 0.0) AS score
  FROM held h CROSS JOIN pi LEFT JOIN dot ON dot.doc_id = h.doc_id AND dot.label = pi.label),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rk FROM score)
SELECT doc_id, split, CAST(label AS DOUBLE) AS prediction FROM best WHERE rk = 1
""")

NB_PAIRS = f"""{NB},
held AS (SELECT doc_id, split, label FROM prepared WHERE split <> 'train'),
dot AS (
  SELECT x.doc_id, t.label, sum(t.theta * x.value) AS s
  FROM g3_tfidf x JOIN held USING (doc_id) JOIN theta t USING (feature) GROUP BY x.doc_id, t.label),
score AS (
  SELECT h.doc_id, pi.label AS cls, pi.pi + coalesce(dot.s, 0.0) AS score
  FROM held h CROSS JOIN pi LEFT JOIN dot ON dot.doc_id = h.doc_id AND dot.label = pi.label),
best AS (
  SELECT doc_id, cls, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cls) AS rk FROM score),
nbpairs AS (
  SELECT h.split, CAST(h.label AS DOUBLE) AS label, CAST(b.cls AS DOUBLE) AS prediction
  FROM held h JOIN best b ON b.doc_id = h.doc_id AND b.rk = 1)"""

SQL["nb_per_class_metrics"] = _q(f"""
{NB_PAIRS},
{PER_CLASS('nbpairs')}
SELECT pcm.class, round(actual_n, 6) AS actual_n, round(predicted_n, 6) AS predicted_n, round(tp, 6) AS tp,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f_measure, 6) AS f_measure,
       label_ids.emotion AS name
FROM pcm LEFT JOIN label_ids ON CAST(label_ids.label AS DOUBLE) = pcm.class
""")

SQL["nb_confusion_matrix"] = _q(f"""
{NB_PAIRS}
SELECT label, prediction, count(*) AS n FROM nbpairs GROUP BY label, prediction
""")

SQL["nb_weighted_metrics"] = f"{NB_PAIRS},\n{PER_CLASS('nbpairs')}\n{WEIGHTED_SELECT}"

SQL["nb_weighted_metrics_swapped"] = _q(f"""
{NB_PAIRS},
nbswap AS (SELECT prediction AS label, label AS prediction FROM nbpairs),
{PER_CLASS('nbswap')}
{WEIGHTED_SELECT}
""")

SQL["nb_confusion_matrix_wide"] = _q(f"""
{NB_PAIRS},
ids AS (SELECT DISTINCT CAST(label AS DOUBLE) AS label FROM nbpairs)
SELECT ids.label,
       count(*) FILTER (WHERE n.prediction = 0) AS p0, count(*) FILTER (WHERE n.prediction = 1) AS p1,
       count(*) FILTER (WHERE n.prediction = 2) AS p2, count(*) FILTER (WHERE n.prediction = 3) AS p3
FROM ids JOIN nbpairs n USING (label) GROUP BY ids.label
""")


def on_g1(sql: str) -> str:
    """A Naive Bayes statement on G1 instead of G3."""
    return sql.replace(G3, G1).replace("g3_", "g1_")


SQL["nb_predict_clean"] = on_g1(SQL["nb_predict"])

# Streaming scores of held-out rows equal the batch predictions.
SQL["stream_nb_predict"] = SQL["nb_predict"]
SQL["stream_nb_predict_clean"] = SQL["nb_predict_clean"]

# Trained models: the rows scored, and that each prediction has the highest score.
for _clf in ("svm", "logreg", "mlp"):
    SQL[f"{_clf}_predict_checked"] = f"{BASE}\nSELECT doc_id, split, label, true AS ok FROM prepared WHERE split <> 'train'"

SQL["cv_grid_checked"] = _q(f"""
WITH {DOCS}
SELECT CAST(i AS INTEGER) AS maxIter, CAST(r AS DOUBLE) AS regParam, count(*) AS n_train, true AS ok
FROM docs, (VALUES (10), (50), (100)) AS a(i), (VALUES (0.1), (0.01), (0.001)) AS b(r)
WHERE split = 'train' GROUP BY i, r
""")

SQL["cv_best_checked"] = f"WITH {DOCS}\nSELECT split, count(*) AS n, true AS ok FROM docs WHERE split <> 'train' GROUP BY split"

SQL["n_chars_box_by_lang"] = _q("""
SELECT lang, CAST(min(n_chars) AS DOUBLE) AS min, round(quantile_cont(n_chars, 0.25), 6) AS q1,
       round(quantile_cont(n_chars, 0.5), 6) AS median, round(quantile_cont(n_chars, 0.75), 6) AS q3,
       CAST(max(n_chars) AS DOUBLE) AS max
FROM documents GROUP BY lang
""")

# Naive Bayes on G1 and G3, test and val, both orientations: a result table in closed form.
def _result_part(fs: str, split: str, orientation: str) -> str:
    pairs = NB_PAIRS if fs == "G3" else on_g1(NB_PAIRS)
    pick = "label, prediction" if orientation == "right" else "prediction AS label, label AS prediction"
    name = {"G1": "countVectorizer+iDF", "G3": "unCleanData+countVectorizer+iDF"}[fs]
    number = 4 * (fs == "G3") + 2 * (split == "val") + (2 if orientation == "swapped" else 1)
    per = PER_CLASS(f"(SELECT {pick} FROM nbpairs WHERE split = '{split}')")
    return f"""SELECT '{name}' AS dataModel, '{split}' AS modelName, '{orientation}' AS orientation, r.*, 'df{number}' AS dataFrameNo
FROM ({pairs},
{per}
{WEIGHTED_SELECT}) AS r"""


RESULTS = "results AS (" + "\nUNION ALL\n".join(
    _result_part(fs, split, o) for fs in ("G1", "G3") for split in ("test", "val") for o in ("right", "swapped")) + ")"
RUN = "CAST(regexp_extract(dataFrameNo, '[0-9]+$') AS INTEGER)"

SQL["nb_results"] = f"WITH {RESULTS}\nSELECT * FROM results"
SQL["nb_results_column_max"] = f"""WITH {RESULTS}
SELECT {', '.join(f'max({c}) AS {c}' for c in ('dataModel', 'modelName', 'orientation', 'precision', 'recall', 'f1Score',
                                               'accuracy', 'dataFrameNo'))} FROM results"""
SQL["nb_results_series"] = f"WITH {RESULTS}\nSELECT {RUN} AS run, dataFrameNo, f1Score, recall, precision FROM results"
SQL["nb_best_run"] = f"WITH {RESULTS}\nSELECT * FROM results ORDER BY f1Score DESC, {RUN} LIMIT 1"
for _query, _by in (("nb_results_by_features", "dataModel"), ("nb_results_by_split", "modelName")):
    SQL[_query] = f"""WITH {RESULTS}
SELECT {_by}, max(f1Score) AS max_f1Score, round(avg(f1Score), 6) AS avg_f1Score, count(*) AS n_runs
FROM results GROUP BY {_by}"""

SQL["cv_folds"] = _q(f"""
{BASE}
SELECT CAST(((doc_id % 3) + 3) % 3 AS INTEGER) AS fold, label, count(*) AS n
FROM prepared WHERE split = 'train' GROUP BY 1, 2
""")

# Invariant: every (feature set, classifier) pair once, scored on all validation rows, within range.
SQL["experiment_results"] = _q(f"""
WITH {DOCS},
runs AS (
  SELECT s.name AS dataModel, c.name AS modelName, 'df' || (3 * s.i + c.i + 1) AS dataFrameNo
  FROM (VALUES (0, 'countVectorizer+iDF'), (1, 'countVectorizer+iDF+chisquare'),
               (2, 'unCleanData+countVectorizer+iDF'), (3, 'ngram+hashingtf+iDF')) AS s(i, name),
       (VALUES (0, 'svm'), (1, 'lr'), (2, 'nb')) AS c(i, name))
SELECT dataFrameNo, dataModel, modelName, count(*) AS n_scored, true AS ok
FROM runs, docs WHERE split = 'val' GROUP BY ALL
""")
