"""SQL (DuckDB dialect) that computes the registered queries independently.

Queries without an entry train MLlib models or depend on Spark's murmur3
hashing; ``tests/test_models.py`` holds their results against invariants.
"""

from __future__ import annotations

from ..operators.perturb import NEUTRAL_SENTENCES, NOISE_PHRASES
from ..operators.significance import POISSON1_CDF_16BIT

# Spark's default English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


STOPS = f"({_quoted(STOP_WORDS)})"


def h32(seed, *keys) -> str:
    return f"('0x' || substr(md5(concat_ws(':', '{seed}', {', '.join(keys)})), 1, 8))::BIGINT"


def unif(seed, *keys) -> str:
    return f"({h32(seed, *keys)} / 4294967296.0)"


def rnd(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {name}"


CLEAN = (r"trim(lower(regexp_replace(regexp_replace(regexp_replace(text, 'https?://\S+', '', 'g'), "
         r"'[^a-zA-Z\s]', '', 'g'), '\s+', ' ', 'g')))")

STATS = r"""
  length(text)::DOUBLE AS text_length,
  len(string_split_regex(text, '\s+'))::DOUBLE AS word_count,
  length(text)::DOUBLE / len(string_split_regex(text, '\s+')) AS avg_word_length,
  CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^A-Z]', '', 'g'))::DOUBLE / length(text) ELSE 0.0 END AS caps_ratio,
  (length(text) - length(replace(text, '!', '')))::DOUBLE AS exclamation_count
"""
STAT_NAMES = ["text_length", "word_count", "avg_word_length", "caps_ratio", "exclamation_count"]
ROUNDED_STATS = ", ".join(rnd(c, c) for c in STAT_NAMES)

LABELLED = "SELECT d.*, l.quality AS label FROM documents d JOIN labels l USING (doc_id)"
LABELLED_STATS = f"SELECT doc_id, label, {STATS} FROM ({LABELLED})"
CLEAN_DOCS = f"SELECT doc_id, t AS text FROM (SELECT doc_id, {CLEAN} AS t FROM documents) WHERE length(t) >= 100"
ARTICLES = ("SELECT doc_id, CAST(NULL AS VARCHAR) AS title, text, lang AS subject, CAST(NULL AS VARCHAR) AS date, "
            f"source, label::INTEGER AS label FROM ({LABELLED})")
RAW_ARTICLES = """
  SELECT d.doc_id, CAST(NULL AS VARCHAR) AS title, d.text, nullif(d.lang, 'es') AS subject, CAST(NULL AS VARCHAR) AS date,
         CASE WHEN d.source = 'src3' THEN '  ' ELSE d.source END AS source, l.quality::INTEGER AS label
  FROM documents d LEFT JOIN labels l USING (doc_id)"""
CLEAN_ARTICLES = f"""
  SELECT doc_id, coalesce(title, 'Unknown') AS title, text, coalesce(subject, 'general') AS subject,
         coalesce(date, 'unknown') AS date, coalesce(source, 'unknown') AS source, label
  FROM ({ARTICLES}) WHERE length(text) >= 100
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"""

DOC_PREDICTIONS = f"""
  WITH s AS ({LABELLED_STATS})
  SELECT doc_id AS row_id, 'len_rule' AS model, label, text_length AS score, (text_length >= 500)::INT AS prediction FROM s
  UNION ALL SELECT doc_id, 'word_rule', label, -avg_word_length, (avg_word_length < 6.5)::INT FROM s
  UNION ALL SELECT doc_id, 'caps_rule', label, -caps_ratio, (caps_ratio < 0.02)::INT FROM s"""
LINE_PREDICTIONS = """
  SELECT 'price_rule' AS model, (l_returnflag = 'R')::INT AS label, l_extendedprice AS score, (l_extendedprice >= 50000)::INT AS prediction FROM lineitem
  UNION ALL SELECT 'discount_rule', (l_returnflag = 'R')::INT, l_discount, (l_discount >= 0.05)::INT FROM lineitem
  UNION ALL SELECT 'net_rule', (l_returnflag = 'R')::INT, l_extendedprice * (1 - l_discount), (l_extendedprice * (1 - l_discount) >= 40000)::INT FROM lineitem"""


def _cells(source: str, keys: str) -> str:
    return f"""
  SELECT {keys},
    count(*) FILTER (label = 1 AND prediction = 1) AS "TP", count(*) FILTER (label <> 1 AND prediction = 1) AS "FP",
    count(*) FILTER (label = 1 AND prediction <> 1) AS "FN", count(*) FILTER (label <> 1 AND prediction <> 1) AS "TN"
  FROM ({source}) GROUP BY {keys}"""


def _metrics(source: str, keys: str, extra: str = "") -> str:
    """Class-wise precision/recall first, then their averages."""
    return f"""
  WITH c AS ({_cells(source, keys)}),
  r AS (SELECT *, ("TP"+"FN")::DOUBLE AS pos, ("TN"+"FP")::DOUBLE AS neg,
      coalesce("TP" / nullif("TP"+"FP", 0), 0) AS p1, coalesce("TP" / nullif("TP"+"FN", 0), 0) AS r1,
      coalesce("TN" / nullif("TN"+"FN", 0), 0) AS p0, coalesce("TN" / nullif("TN"+"FP", 0), 0) AS r0 FROM c),
  f AS (SELECT *, coalesce(2*p1*r1 / nullif(p1+r1, 0), 0) AS f1, coalesce(2*p0*r0 / nullif(p0+r0, 0), 0) AS f0 FROM r)
  SELECT {keys}, "TP", "FP", "FN", "TN", ("TP"+"TN") / (pos+neg) AS accuracy,
    (f1*pos + f0*neg) / (pos+neg) AS f1_weighted, (p1*pos + p0*neg) / (pos+neg) AS precision_weighted,
    (r1*pos + r0*neg) / (pos+neg) AS recall_weighted, f1 AS f1_positive, p1 AS precision_positive, r1 AS recall_positive
    {extra} FROM f"""


METRIC_NAMES = ["accuracy", "f1_weighted", "precision_weighted", "recall_weighted",
                "f1_positive", "precision_positive", "recall_positive"]


def _rounded_metrics(source: str, keys: str, digits: int = 6) -> str:
    cols = ", ".join(rnd(c, c, digits) for c in METRIC_NAMES)
    return f'SELECT {keys}, "TP", "FP", "FN", "TN", {cols} FROM ({_metrics(source, keys)})'


def _auc(source: str, keys: str) -> str:
    """Mann-Whitney form with mid-ranks."""
    return f"""
  WITH p AS ({source}),
  r AS (SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY score)
                + (count(*) OVER (PARTITION BY {keys}, score) - 1) / 2.0 AS mid FROM p)
  SELECT {keys}, (sum(mid) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0)
         / nullif(sum(label) * (count(*) - sum(label)), 0)::DOUBLE AS auc FROM r GROUP BY {keys}"""


def _roc(source: str) -> str:
    return f"""
  WITH g AS (SELECT model, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM ({source}) GROUP BY model, score),
  c AS (SELECT model, score AS threshold,
          sum(neg) OVER w / (sum(neg) OVER (PARTITION BY model))::DOUBLE AS fpr,
          sum(pos) OVER w / (sum(pos) OVER (PARTITION BY model))::DOUBLE AS tpr
        FROM g WINDOW w AS (PARTITION BY model ORDER BY score DESC))
  SELECT model, round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM c
  UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM c"""


RULE_PAIRS = (("len_rule", "word_rule"), ("len_rule", "caps_rule"), ("word_rule", "caps_rule"))


def _mcnemar_pairs(source: str, pairs=RULE_PAIRS) -> str:
    wanted = ", ".join(f"('{a}', '{b}')" for a, b in pairs)
    return f"""
  WITH p AS ({source})
  SELECT a.model AS model_1, b.model AS model_2,
    count(*) FILTER (a.prediction = a.label AND b.prediction <> b.label) AS b_correct1_wrong2,
    count(*) FILTER (a.prediction <> a.label AND b.prediction = b.label) AS c_wrong1_correct2
  FROM p a JOIN p b USING (row_id)
  WHERE (a.model, b.model) IN ({wanted})
  GROUP BY 1, 2"""


LINE_PAIRS = """
  WITH w AS (SELECT l_returnflag = 'R' AS y, l_extendedprice >= 50000 AS p1, l_discount >= 0.05 AS p2,
                    l_extendedprice * (1 - l_discount) >= 40000 AS p3 FROM lineitem)
  SELECT 'price_rule' AS model_1, 'discount_rule' AS model_2, count(*) FILTER (p1 = y AND p2 <> y) AS b_correct1_wrong2,
         count(*) FILTER (p1 <> y AND p2 = y) AS c_wrong1_correct2 FROM w
  UNION ALL SELECT 'price_rule', 'net_rule', count(*) FILTER (p1 = y AND p3 <> y), count(*) FILTER (p1 <> y AND p3 = y) FROM w
  UNION ALL SELECT 'discount_rule', 'net_rule', count(*) FILTER (p2 = y AND p3 <> y), count(*) FILTER (p2 <> y AND p3 = y) FROM w"""


def _mcnemar_test(pairs: str) -> str:
    """The normal tail is integrated by Simpson's rule over ten units."""
    return f"""
  WITH t AS (SELECT *, b_correct1_wrong2 AS b, c_wrong1_correct2 AS c FROM ({pairs})),
  x AS (SELECT *, CASE WHEN b + c = 0 THEN 0.0 ELSE (abs(b - c) - 1)::DOUBLE ** 2 / (b + c) END AS chi2 FROM t),
  q AS (SELECT *, CASE WHEN b + c = 0 THEN 1.0 ELSE 2 / sqrt(pi()) * (10.0 / 2000) / 3 * list_sum(list_transform(range(0, 2001),
      lambda i: (CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-((sqrt(chi2 / 2) + i * 10.0 / 2000) ** 2)))) END AS p FROM x)
  SELECT model_1, model_2, b_correct1_wrong2, c_wrong1_correct2, round(chi2, 6) AS chi2, round(p, 6) AS p_value,
         chi2 > 3.841458820694124 AS significant_005 FROM q"""


def _bootstrap(replicates: int, source: str = DOC_PREDICTIONS) -> str:
    weight = "CASE " + " ".join(f"WHEN u < {c} THEN {k}" for k, c in enumerate(POISSON1_CDF_16BIT)) + f" ELSE {len(POISSON1_CDF_16BIT)} END"
    cols = []
    for n in ("f1", "acc"):
        cols.append(f"round(avg({n}), 6) AS {n}_mean, round(quantile_cont({n}, 0.025), 6) AS {n}_ci_lower, round(quantile_cont({n}, 0.975), 6) AS {n}_ci_upper")
    return f"""
  WITH p AS ({source}),
  u AS (SELECT p.*, r.replicate, ('0x' || substr(md5(concat_ws(':', '42', row_id, replicate // 8)), (1 + 4 * (replicate % 8))::INT, 4))::BIGINT AS u
        FROM p, range(0, {replicates}) r(replicate)),
  w AS (SELECT *, {weight} AS w FROM u),
  c AS (SELECT model, replicate, sum(w * label * prediction) AS tp, sum(w * (1 - label) * prediction) AS fp,
               sum(w * label * (1 - prediction)) AS fn, sum(w) AS n, sum(w * (label = prediction)::INT) AS good FROM w GROUP BY 1, 2),
  m AS (SELECT model, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)::DOUBLE AS f1, coalesce(good / nullif(n, 0), 0)::DOUBLE AS acc FROM c)
  SELECT model, {', '.join(cols)} FROM m GROUP BY model"""


HASH_SPLIT = ("CASE WHEN {h} % 10000 < 7000 THEN 'train' WHEN {h} % 10000 < 8500 THEN 'validation' ELSE 'test' END")


def split_of(*keys) -> str:
    return HASH_SPLIT.format(h=h32(42, *keys))


IDS = "SELECT d.doc_id, l.quality AS label FROM documents d JOIN labels l USING (doc_id)"

TOKENS = f"""
  SELECT doc_id, list_filter(string_split(text, ' '), lambda w: w NOT IN {STOPS}) AS words FROM ({CLEAN_DOCS})"""
TF = f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM ({TOKENS})) GROUP BY 1, 2"
DF = f"SELECT term, count(*) AS df FROM ({TF}) GROUP BY term"
N_DOCS = f"(SELECT count(*) FROM ({CLEAN_DOCS}))"
IDF = f"SELECT term, df, CASE WHEN df >= 5 THEN ln(({N_DOCS} + 1) / (df + 1)) ELSE 0.0 END AS idf FROM ({DF})"
VOCABULARY = f"""
  SELECT word, count(*) AS documents FROM (
    SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '\\b[a-z]{{2,}}\\b')) AS word FROM ({CLEAN_DOCS}))
  WHERE word NOT IN {STOPS} GROUP BY word"""

NB = f"""
  WITH lab AS (SELECT doc_id, quality AS label FROM labels),
  docs AS (SELECT t.doc_id, label FROM ({TOKENS}) t JOIN lab USING (doc_id)),
  tf AS (SELECT f.*, label FROM ({TF}) f JOIN docs USING (doc_id)),
  t AS (SELECT term, sum(tf * (1 - label))::BIGINT AS n0, sum(tf * label)::BIGINT AS n1 FROM tf GROUP BY term),
  s AS (SELECT sum(n0) AS s0, sum(n1) AS s1, count(*) AS d FROM t),
  theta AS (SELECT term, n0, n1, ln((n0 + 1.0) / (s0 + d)) AS theta0, ln((n1 + 1.0) / (s1 + d)) AS theta1 FROM t, s),
  prior AS (SELECT ln((sum(label) + 1.0) / (count(*) + 2.0)) - ln((sum(1 - label) + 1.0) / (count(*) + 2.0)) AS odds FROM docs)"""

RUN_LOG = """
  SELECT CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'strong_scaling' ELSE 'weak_scaling' END AS experiment,
         event_type AS profile, (user_id % 4 + 1)::INT AS executors, (user_id % 4 + 1) * 25 AS pct, value FROM events"""

NOISE_BUDGET = f"""
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {h32(42, 'doc_id')}, doc_id) AS r,
         count(*) OVER (PARTITION BY label) AS n FROM ({IDS})"""

PHRASES = "[" + _quoted(p.capitalize() + "." for p in NOISE_PHRASES) + "]"
NEUTRAL = "[" + _quoted(NEUTRAL_SENTENCES) + "]"

HOST = "lower(regexp_extract(url, '^https?://([^/:?#]+)', 1))"

ORACLE = {
    # sources and sinks
    "schema_enforced_articles": ARTICLES,
    "schema_violations": """
  WITH d AS (SELECT doc_id % 11 = 0 AS no_url, coalesce(lang = 'de', true) AS no_date, doc_id % 7 = 0 AS bad_length, length(text) < 100 AS no_text FROM documents)
  SELECT 'url:null' AS violation, count(*) AS rows FROM d WHERE no_url HAVING count(*) > 0
  UNION ALL SELECT 'crawl_date:null', count(*) FROM d WHERE no_date HAVING count(*) > 0
  UNION ALL SELECT 'content_length:type', count(*) FROM d WHERE bad_length HAVING count(*) > 0
  UNION ALL SELECT 'text:null', count(*) FROM d WHERE no_text HAVING count(*) > 0
  UNION ALL SELECT 'ok', count(*) FROM d WHERE NOT (no_url OR no_date OR bad_length OR no_text) HAVING count(*) > 0""",
    "scan_articles": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "scan_projected": "SELECT doc_id, n_chars FROM documents WHERE n_chars >= 100",
    "partitioned_roundtrip": f"SELECT subject, count(*) AS rows, sum(label)::BIGINT AS positives FROM ({CLEAN_ARTICLES}) GROUP BY subject",
    "split_roundtrip": f"SELECT doc_id, label, {split_of('doc_id')} AS split FROM ({IDS})",
    "csv_roundtrip": f"SELECT doc_id, text, label FROM ({LABELLED})",
    "report_export_roundtrip": _rounded_metrics(DOC_PREDICTIONS, "model", 4),
    # projections
    "text_statistics": f"SELECT doc_id, {ROUNDED_STATS} FROM (SELECT doc_id, {STATS} FROM documents)",
    "text_stats_transformer": f"SELECT doc_id, {ROUNDED_STATS} FROM (SELECT doc_id, {STATS} FROM documents)",
    "clean_text": CLEAN_DOCS,
    "label_names": "SELECT doc_id, quality AS label, CASE quality WHEN 0 THEN 'Reliable' WHEN 1 THEN 'Unreliable' END AS label_name FROM labels",
    "fill_defaults": f"""
  SELECT doc_id, coalesce(title, 'Unknown') AS title, coalesce(subject, 'general') AS subject, coalesce(date, 'unknown') AS date,
         coalesce(source, 'unknown') AS source, label FROM ({RAW_ARTICLES})""",
    "text_stats_by_class": "SELECT label, CASE label WHEN 0 THEN 'Reliable' WHEN 1 THEN 'Unreliable' END AS label_name, count(*) AS rows, "
    + ", ".join(f"round(avg({c}), 6) AS avg_{c}, round(stddev_samp({c}), 6) AS std_{c}" for c in STAT_NAMES)
    + f" FROM ({LABELLED_STATS}) GROUP BY label",
    "text_stats_summary": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c})::DOUBLE AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, "
        f"round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM ({LABELLED_STATS})" for c in STAT_NAMES),
    # filters, duplicates, set operations
    "clean_articles": CLEAN_ARTICLES,
    "dedup_text": "SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
    "split_subtract": f"""
  WITH ids AS ({IDS}) SELECT * FROM ids EXCEPT SELECT * FROM ids WHERE {h32(42, 'label', 'doc_id')} % 10000 < 7000""",
    "distinct_subjects": "SELECT count(DISTINCT lang) AS distinct_values FROM documents",
    "union_classes": f"SELECT doc_id, lang, source, label, CASE label WHEN 0 THEN 'Reliable' WHEN 1 THEN 'Unreliable' ELSE 'Unknown' END AS label_name FROM ({LABELLED})",
    "seeded_shuffle": f"SELECT doc_id, row_number() OVER (ORDER BY {h32(42, 'doc_id')}, doc_id) AS position FROM documents",
    "limit_sample": f"SELECT doc_id, lang FROM documents ORDER BY {h32(42, 'doc_id')}, doc_id LIMIT 500",
    # audits and aggregates
    "row_counts": "SELECT count(*) AS rows FROM documents",
    "class_distribution": f"SELECT label, count(*) AS count, CASE label WHEN 0 THEN 'Reliable' WHEN 1 THEN 'Unreliable' END AS label_name FROM ({IDS}) GROUP BY label",
    "class_imbalance": f"""
  WITH c AS (SELECT label, count(*) AS count FROM ({IDS}) GROUP BY label), x AS (SELECT sum(count) AS s, max(count) / min(count) AS ratio FROM c)
  SELECT label, CASE label WHEN 0 THEN 'Reliable' WHEN 1 THEN 'Unreliable' END AS label_name, count,
         round(count * 100.0::DOUBLE / s, 6) AS share_pct, round(ratio, 6) AS imbalance_ratio,
         CASE WHEN ratio < 1.5 THEN 'balanced' ELSE 'imbalanced' END AS verdict FROM c, x""",
    "null_audit": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL OR trim({c}::VARCHAR) = '') AS blank_rows FROM ({RAW_ARTICLES})"
        for c in ("title", "text", "subject", "date", "source", "label")),
    "quality_funnel": f"""
  WITH d AS (SELECT text, length(text) >= 100 AS ok, length({CLEAN}) >= 100 AS clean_ok FROM documents)
  SELECT 1 AS step, 'raw' AS stage, count(*) AS rows FROM d UNION ALL SELECT 2, 'text_present', count(text) FROM d
  UNION ALL SELECT 3, 'long_enough', count(*) FROM d WHERE ok UNION ALL SELECT 4, 'distinct_text', count(DISTINCT text) FROM d WHERE ok
  UNION ALL SELECT 5, 'cleaned', count(DISTINCT text) FROM d WHERE ok AND clean_ok""",
    "data_quality_summary": f"""
  WITH a AS ({RAW_ARTICLES})
  SELECT 'total_records' AS metric, count(*) AS value FROM a
  UNION ALL SELECT 'records_after_cleaning', count(DISTINCT text) FROM a WHERE length(text) >= 100
  UNION ALL SELECT 'blank_texts', count(*) FROM a WHERE text IS NULL OR trim(text) = ''
  UNION ALL SELECT 'duplicate_texts', count(text) - count(DISTINCT text) FROM a
  UNION ALL SELECT 'labelled_records', count(label) FROM a
  UNION ALL SELECT 'positive_records', count(*) FROM a WHERE label = 1
  UNION ALL SELECT 'english_records', count(*) FROM a WHERE subject = 'en'
  UNION ALL SELECT 'blank_sources', count(*) FROM a WHERE source IS NULL OR trim(source) = ''""",
    # splits and folds
    "hash_split": f"SELECT doc_id, {split_of('doc_id')} AS split FROM documents",
    "stratified_split": f"SELECT doc_id, label, {split_of('label', 'doc_id')} AS split FROM ({IDS})",
    "stratified_split_exact": f"""
  SELECT doc_id, label, CASE WHEN r <= floor(0.7 * n + 0.5) THEN 'train' WHEN r <= floor(0.85 * n + 0.5) THEN 'validation' ELSE 'test' END AS split
  FROM ({NOISE_BUDGET})""",
    "split_summary": f"""
  WITH s AS (SELECT label, {split_of('doc_id')} AS split FROM ({IDS})), names AS (SELECT unnest(['train', 'validation', 'test']) AS split)
  SELECT names.split, count(label) AS rows, count(*) FILTER (label = 1) AS positives,
         round(count(*) FILTER (label = 1) / greatest(count(label), 1), 6) AS positive_ratio
  FROM names LEFT JOIN s USING (split) GROUP BY names.split""",
    "fold_assignment": f"""
  SELECT doc_id, label, ({h32(42, 'doc_id')} % 5)::INT AS fold_plain, ((r - 1) % 5)::INT AS fold_stratified FROM ({NOISE_BUDGET})""",
    "fraction_samples": f"""
  SELECT doc_id, CASE WHEN b < 2500 THEN 0.25 WHEN b < 5000 THEN 0.5 WHEN b < 7500 THEN 0.75 ELSE 1.0 END::DOUBLE AS data_fraction
  FROM (SELECT doc_id, {h32(42, 'doc_id')} % 10000 AS b FROM documents)""",
    "class_weights": f"""
  SELECT doc_id, label, round(count(*) OVER () / ((SELECT count(DISTINCT label) FROM ({IDS})) * count(*) OVER (PARTITION BY label))::DOUBLE, 6) AS weight
  FROM ({IDS})""",
    "undersample": f"""
  WITH i AS ({IDS}), c AS (SELECT label, count(*) AS n FROM i GROUP BY label), r AS (SELECT label, (SELECT min(n) FROM c) / n::DOUBLE AS rate FROM c)
  SELECT doc_id, label FROM i JOIN r USING (label) WHERE {unif(42, 'doc_id')} < rate""",
    # evaluation
    "classification_metrics": _rounded_metrics(DOC_PREDICTIONS, "model"),
    "confusion_report": f'SELECT model, "TP", "FP", "FN", "TN", round(accuracy, 4) AS accuracy FROM ({_metrics(DOC_PREDICTIONS, "model")})',
    "roc_curve": _roc(DOC_PREDICTIONS),
    "auc_by_model": f"SELECT model, round(auc, 6) AS auc FROM ({_auc(DOC_PREDICTIONS, 'model')})",
    "lineitem_metrics": _rounded_metrics(LINE_PREDICTIONS, "model"),
    "lineitem_roc_curve": _roc(LINE_PREDICTIONS),
    # What must hold of a sketch: its size and its bounds.
    "lineitem_roc_sketch": f"SELECT DISTINCT model, true AS bounded, true AS rates_within, true AS area_within FROM ({LINE_PREDICTIONS})",
    "lineitem_auc": f"SELECT model, round(auc, 6) AS auc FROM ({_auc(LINE_PREDICTIONS, 'model')})",
    "lineitem_mcnemar": _mcnemar_test(LINE_PAIRS),
    "mcnemar_pairs": _mcnemar_pairs(DOC_PREDICTIONS),
    "mcnemar_test": _mcnemar_test(_mcnemar_pairs(DOC_PREDICTIONS)),
    "bootstrap_ci": _bootstrap(1000),
    "best_grid_point": f"""
  WITH g AS (SELECT 'len_rule' AS model, i AS grid_index, label, (length(text) >= [100, 250, 500, 1000, 2000][i + 1])::INT AS prediction
             FROM ({LABELLED}), range(0, 5) r(i)),
  m AS (SELECT model, grid_index, round(f1_weighted, 6) AS f1_weighted FROM ({_metrics('SELECT * FROM g', 'model, grid_index')}))
  SELECT model, grid_index::INT AS grid_index, f1_weighted FROM m ORDER BY f1_weighted DESC, grid_index LIMIT 1""",
    # reports
    "scaling_report": f"""
  WITH r AS (SELECT experiment, profile, executors, count(*) AS runs, avg(value) AS t FROM ({RUN_LOG}) GROUP BY 1, 2, 3),
  b AS (SELECT profile, t AS base FROM r QUALIFY row_number() OVER (PARTITION BY experiment, profile ORDER BY executors) = 1)
  SELECT experiment, profile, executors, runs, round(t, 6) AS train_time_s,
    CASE WHEN experiment = 'strong_scaling' THEN round(base / t, 6) END AS speedup,
    CASE WHEN experiment = 'strong_scaling' THEN round(base / t / executors, 6) END AS efficiency,
    CASE WHEN experiment = 'strong_scaling' THEN round(t / 60 * executors * 0.10, 6) END AS cost_usd
  FROM r JOIN b USING (profile)""",
    "scaling_combined": f"""
  SELECT experiment, variable, CASE WHEN experiment = 'weak_scaling' THEN count(*) ELSE max(executors) END::BIGINT AS value, round(avg(value), 6) AS train_time_s
  FROM (SELECT *, CASE WHEN experiment = 'weak_scaling' THEN pct || '% data' ELSE executors || ' cores' END AS variable FROM ({RUN_LOG})) GROUP BY 1, 2""",
    # terms
    "tokenize": f"SELECT doc_id, len(string_split(text, ' '))::INT AS n_tokens, replace(text, ' ', '|') AS tokens FROM ({CLEAN_DOCS})",
    "remove_stopwords": f"SELECT doc_id, len(words)::INT AS n_tokens, array_to_string(words, '|') AS tokens FROM ({TOKENS})",
    "hashing_tf": f"SELECT doc_id, 16384 AS vector_size, len(words)::DOUBLE AS total_terms FROM ({TOKENS})",
    "term_frequency": TF,
    "document_frequency": f"SELECT term, df FROM ({DF}) WHERE df >= 5",
    "idf_weights": f"SELECT term, df, round(idf, 6) AS idf FROM ({IDF})",
    "tfidf": f"SELECT doc_id, term, tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf FROM ({TF}) JOIN ({IDF}) USING (term) WHERE idf <> 0",
    "vocabulary": VOCABULARY,
    "bucket_words": f"""
  SELECT bucket, array_to_string(list_sort(list(word))[1:3], ', ') AS words
  FROM (SELECT word, {h32(42, 'word')} % 1024 AS bucket FROM ({VOCABULARY})) GROUP BY bucket""",
    "naive_bayes_params": f"{NB} SELECT term, n0, n1, round(theta0, 6) AS theta0, round(theta1, 6) AS theta1 FROM theta",
    "naive_bayes_predict": f"""{NB},
  m AS (SELECT doc_id, sum(tf * (theta1 - theta0)) AS g FROM tf JOIN theta USING (term) GROUP BY doc_id),
  z AS (SELECT doc_id, label, odds + coalesce(g, 0) AS margin FROM docs LEFT JOIN m USING (doc_id), prior)
  SELECT doc_id, label, round(margin, 6) AS margin, (margin > 0)::INT::DOUBLE AS prediction FROM z""",
    "top_terms": f"""{NB},
  w AS (SELECT term, round(theta1 - theta0, 6) AS weight FROM theta)
  SELECT term, weight, row_number() OVER (ORDER BY weight DESC, term)::INT AS rank FROM w ORDER BY weight DESC, term LIMIT 20""",
    "features_assembled": f"""
  SELECT doc_id, 16389 AS vector_size, {ROUNDED_STATS} FROM (SELECT doc_id, {CLEAN} AS c, {STATS} FROM documents) WHERE length(c) >= 100""",
    # perturbation
    "label_flip": f"""
  SELECT doc_id, CASE WHEN f THEN 1 - label ELSE label END AS label, f AS flipped
  FROM (SELECT *, r > floor(floor(n * 0.1) / 2) AND r <= floor(n * 0.1) AS f FROM ({NOISE_BUDGET}))""",
    "cross_contaminate": f"""
  WITH b AS ({NOISE_BUDGET}),
  dn AS (SELECT doc_id AS donor_id, label, row_number() OVER (PARTITION BY label ORDER BY {h32('42-donor', 'doc_id')}, doc_id) AS r FROM b),
  sz AS (SELECT label, count(*) AS n FROM b GROUP BY label),
  ch AS (SELECT b.doc_id, 1 - b.label AS other, b.r, sz.n AS donors FROM b JOIN sz ON sz.label = 1 - b.label WHERE b.r <= floor(floor(b.n * 0.1) / 2)),
  pr AS (SELECT ch.doc_id, dn.donor_id FROM ch JOIN dn ON dn.label = ch.other AND dn.r = (ch.r - 1) % ch.donors + 1),
  t AS (SELECT doc_id, text, label, list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '') AS ws FROM ({LABELLED}))
  SELECT t.doc_id, t.label, pr.donor_id, CASE WHEN pr.donor_id IS NULL THEN t.text
    ELSE array_to_string(list_slice(t.ws, 1, len(t.ws) // 2), ' ') || ' ' || d.text END AS text
  FROM t LEFT JOIN pr ON pr.doc_id = t.doc_id LEFT JOIN documents d ON d.doc_id = pr.donor_id""",
    "append_neutral": f"""
  SELECT doc_id, CASE WHEN {unif('neutral', 'doc_id')} < 0.25 THEN text || ' ' || {NEUTRAL}[{h32('neutral-pick', 'doc_id')} % {len(NEUTRAL_SENTENCES)} + 1] ELSE text END AS text
  FROM documents""",
    "insert_noise": f"""
  WITH p AS (SELECT doc_id, text, list_transform(string_split(text, '. '), lambda x, i: CASE WHEN i < len(string_split(text, '. ')) THEN x || '.' ELSE x END) AS parts, {PHRASES} AS ph,
      {h32('noise-first', 'doc_id')} % 15 AS a, {h32('noise-step', 'doc_id')} % 14 + 1 AS s,
      {h32('noise-count', 'doc_id')} % 2 = 1 AS two, {h32('noise-at', 'doc_id')} % 1073741824 AS q, {unif('noise', 'doc_id')} < 0.45 AS hit FROM documents),
  x AS (SELECT *, q % (len(parts) + 1) AS pos FROM p)
  SELECT doc_id, CASE WHEN hit THEN array_to_string(list_concat(list_concat(parts[1:pos],
      CASE WHEN two THEN [ph[(a + s) % 15 + 1], ph[a + 1]] ELSE [ph[a + 1]] END), parts[pos + 1:]), ' ') ELSE text END AS text FROM x""",
    # crawl
    "crawl_articles": r"""
  WITH p AS (SELECT *, lower(regexp_extract(html, '<html[^>]*\slang="([A-Za-z]+)', 1)) AS language FROM pages)
  SELECT page_id, url, language, length(html)::INT AS content_length,
    trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'),
      '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text
  FROM p WHERE language = 'en' QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1""",
    "weak_labels": f"""
  SELECT page_id, host, CASE
      WHEN host LIKE '%.cheap-pills.example.com' OR host = 'cheap-pills.example.com' OR host LIKE '%.casino-win.example.com'
        OR host = 'casino-win.example.com' OR host LIKE '%.spam-farm.example.org' OR host = 'spam-farm.example.org' THEN 1
      WHEN host LIKE '%.example.net' OR host = 'example.net' OR host LIKE '%.thther.example.org' OR host = 'thther.example.org' THEN 0 END AS label
  FROM (SELECT page_id, {HOST} AS host FROM pages)""",
    "labelled_documents": f"SELECT doc_id, lang, source, label FROM ({LABELLED})",
}

_RULE_FOLDS = f"SELECT *, ({h32(42, 'row_id')} % 5)::INT AS fold FROM ({DOC_PREDICTIONS})"
_FOLD_METRICS = _metrics(_RULE_FOLDS, "model, fold")
ORACLE["cv_summary"] = f"""
  SELECT model, round(avg(f1_weighted), 6) AS avg_f1, round(stddev_pop(f1_weighted), 6) AS std_f1,
         round(avg(auc), 6) AS avg_auc, round(stddev_pop(auc), 6) AS std_auc
  FROM ({_FOLD_METRICS}) JOIN ({_auc(_RULE_FOLDS, 'model, fold')}) USING (model, fold) GROUP BY model"""
ORACLE["cv_stability"] = f"""
  WITH s AS (SELECT model, stddev_pop(f1_weighted) AS std FROM ({_FOLD_METRICS}) GROUP BY model)
  SELECT model, round(std, 6) AS std_f1, CASE WHEN std < 0.01 THEN 'Very Stable (std < 0.01)' WHEN std < 0.03 THEN 'Stable (std < 0.03)'
    WHEN std < 0.05 THEN 'Moderately Stable' ELSE 'Unstable (high variance — potential overfitting)' END AS stability FROM s"""

_RULE_SPLITS = f"SELECT *, {split_of('row_id')} AS split FROM ({DOC_PREDICTIONS})"
_SPLIT_METRICS = _rounded_metrics(f"SELECT * FROM ({_RULE_SPLITS}) WHERE split <> 'train'", "split, model")
ORACLE["metrics_by_split"] = _SPLIT_METRICS
ORACLE["compare_runs"] = f"""
  WITH m AS ({_SPLIT_METRICS}), t AS (SELECT profile, avg(value) AS s FROM ({RUN_LOG}) GROUP BY profile),
  n(a, b, p) AS (VALUES ('len_rule', 'base_len', 'view'), ('word_rule', 'base_word', 'click'), ('caps_rule', 'base_caps', 'purchase'))
  SELECT n.a AS "Algorithm", v.accuracy AS a_accuracy, v.f1_positive AS a_f1, round(t.s, 6) AS a_time_s, n.b AS baseline,
         x.accuracy AS b_accuracy, x.f1_positive AS b_f1
  FROM n JOIN m v ON v.model = n.a AND v.split = 'validation' JOIN m x ON x.model = n.a AND x.split = 'test' JOIN t ON t.profile = n.p"""


# Naive Bayes in closed form, fitted on some labelled documents and asked on
# others; the margin is rounded so that texts of the same words tie.
NB_SMOOTHING = {"nb_half": 0.5, "nb_one": 1.0}


def _nb(name: str, a: float, within: str, asked: str) -> str:
    return f"""
  SELECT row_id, '{name}' AS model, label, score, (score > 0)::INT AS prediction FROM (
    WITH docs AS (SELECT t.doc_id, t.words, l.quality AS label, {split_of('t.doc_id')} AS split, ({h32('fold', 't.doc_id')} % 5)::INT AS fold
                  FROM ({TOKENS}) t JOIN labels l USING (doc_id)),
    tf AS (SELECT doc_id, label, term, count(*) AS tf, any_value(split) AS split, any_value(fold) AS fold
           FROM (SELECT doc_id, label, split, fold, unnest(words) AS term FROM docs) GROUP BY 1, 2, 3),
    t AS (SELECT term, sum(tf * (1 - label)) AS n0, sum(tf * label) AS n1 FROM tf WHERE {within} GROUP BY term),
    s AS (SELECT sum(n0) AS s0, sum(n1) AS s1, count(*) AS d FROM t),
    gain AS (SELECT term, ln((n1 + {a}) / (s1 + {a} * d)) - ln((n0 + {a}) / (s0 + {a} * d)) AS g FROM t, s),
    prior AS (SELECT ln((sum(label) + {a}) / (count(*) + 2 * {a})) - ln((sum(1 - label) + {a}) / (count(*) + 2 * {a})) AS odds FROM docs WHERE {within}),
    m AS (SELECT doc_id, sum(tf * g) AS m FROM tf JOIN gain USING (term) WHERE {asked} GROUP BY doc_id)
    SELECT doc_id AS row_id, label, round(odds + coalesce(m, 0), 6) AS score FROM docs LEFT JOIN m USING (doc_id), prior WHERE {asked})"""


_NB_TEST = " UNION ALL ".join(_nb(n, a, "split = 'train'", "split = 'test'") for n, a in NB_SMOOTHING.items())
ORACLE["nb_confusion"] = _rounded_metrics(_NB_TEST, "model")
ORACLE["nb_roc_curve"] = _roc(_NB_TEST)
ORACLE["nb_mcnemar"] = _mcnemar_test(_mcnemar_pairs(_NB_TEST, [tuple(NB_SMOOTHING)]))
ORACLE["nb_bootstrap"] = _bootstrap(1000, _NB_TEST)


def _nb_fold(k: int) -> str:
    held_out = f"split = 'train' AND fold = {k}"
    others = f"split = 'train' AND fold <> {k}"
    return " UNION ALL ".join(f"SELECT *, {k} AS fold FROM ({_nb(n, a, others, held_out)})" for n, a in NB_SMOOTHING.items())


ORACLE["nb_cv_grid"] = f"""
  WITH g AS (SELECT model, round(avg(auc), 6) AS avg_auc, round(stddev_pop(auc), 6) AS std_auc
             FROM ({_auc(" UNION ALL ".join(_nb_fold(k) for k in range(5)), 'model, fold')}) GROUP BY model)
  SELECT *, model = (SELECT model FROM g ORDER BY avg_auc DESC, list_position({list(NB_SMOOTHING)}, model) LIMIT 1) AS best FROM g"""


# --- 32-bit Murmur3 over UTF-8 bytes, in integer arithmetic ---

# The constants of the hash.
_C1, _C2, _ADD, _F1, _F2 = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35
_LOW = "& 4294967295::UBIGINT"


def _rotated(x: str, bits: int) -> str:
    return f"((({x} << {bits}) | ({x} >> {32 - bits})) {_LOW})"


def murmur3(text: str, seed: int = 42) -> str:
    """A query ``(word, h)``: the unsigned hash of every distinct ``word`` of
    the query ``text``."""
    scrambled = _rotated(f"((k * {_C1}::UBIGINT) {_LOW})", 15)
    return f"""
  WITH b AS (SELECT word, list_transform(range(0, len(hex(encode(word))) // 2), lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::BIGINT, 2))::UBIGINT) AS b
             FROM (SELECT DISTINCT word FROM ({text}))),
  g AS (SELECT word, len(b)::UBIGINT AS n, list_transform(range(0, (len(b) + 3) // 4), lambda i:
          coalesce(b[4 * i + 1], 0::UBIGINT) + (coalesce(b[4 * i + 2], 0::UBIGINT) << 8) + (coalesce(b[4 * i + 3], 0::UBIGINT) << 16) + (coalesce(b[4 * i + 4], 0::UBIGINT) << 24)) AS g FROM b),
  k AS (SELECT word, n, list_transform(g, lambda k: ({scrambled} * {_C2}::UBIGINT) {_LOW}) AS k FROM g),
  h AS (SELECT word, n, k, list_reduce(list_prepend({seed}::UBIGINT, k[1:(n // 4)::BIGINT]), lambda x, y:
          (({_rotated('xor(x, y)', 13)} * 5::UBIGINT) + {_ADD}::UBIGINT) {_LOW}) AS h FROM k),
  t AS (SELECT word, xor(CASE WHEN n % 4 > 0 THEN xor(h, k[len(k)]) ELSE h END, n) AS h FROM h),
  u AS (SELECT word, (xor(h, h >> 16) * {_F1}::UBIGINT) {_LOW} AS h FROM t),
  v AS (SELECT word, (xor(h, h >> 13) * {_F2}::UBIGINT) {_LOW} AS h FROM u)
  SELECT word, xor(h, h >> 16) AS h FROM v"""


# The vector length divides 2 ** 32, so the unsigned remainder is the index.
_BUCKETS = f"SELECT word AS term, (h % 16384)::INT AS bucket FROM ({murmur3(f'SELECT unnest(words) AS word FROM ({TOKENS})')})"
_BUCKET_TF = f"SELECT doc_id, bucket, sum(tf)::DOUBLE AS tf FROM ({TF}) JOIN ({_BUCKETS}) USING (term) GROUP BY 1, 2"
ORACLE["word_buckets"] = f"SELECT word, (h % 16384)::INT AS bucket FROM ({murmur3(VOCABULARY)})"
ORACLE["hashing_tf_buckets"] = _BUCKET_TF
ORACLE["tfidf_features"] = f"""
  WITH tf AS ({_BUCKET_TF}),
  w AS (SELECT bucket, CASE WHEN count(*) >= 5 THEN ln(({N_DOCS} + 1) / (count(*) + 1)) ELSE 0.0 END AS idf FROM tf GROUP BY bucket)
  SELECT d.doc_id, 16384 AS vector_size, count(tf.bucket)::INT AS stored, round(coalesce(sum(tf.tf * w.idf), 0.0), 6) AS total
  FROM (SELECT doc_id FROM ({CLEAN_DOCS})) d LEFT JOIN tf USING (doc_id) LEFT JOIN w USING (bucket) GROUP BY d.doc_id"""

# Counted by a write, the same rows.
ORACLE["funnel_while_writing"] = ORACLE["quality_funnel"]
ORACLE["splits_while_writing"] = ORACLE["split_summary"]

# What must hold of results that SQL cannot compute: rows, labels, bounds.
_FEATURE_ROWS = f"SELECT doc_id, source, subject, label, {split_of('doc_id')} AS split FROM ({CLEAN_ARTICLES}) WHERE length({CLEAN}) >= 100"
ORACLE["repartition_balance"] = "SELECT count(*)::BIGINT AS rows, 8::BIGINT AS partitions, true AS balanced FROM documents"
ORACLE["feature_model_transform"] = f"SELECT doc_id, 0 AS differs FROM ({CLEAN_DOCS})"
ORACLE["prediction_scores"] = f"""
  SELECT doc_id AS row_id, model, label, true AS score_in_bounds, true AS is_class
  FROM ({_FEATURE_ROWS}), (SELECT unnest(['NaiveBayes', 'LinearSVC']) AS model) WHERE split = 'validation'"""
ORACLE["score_batch"] = f"""
  SELECT doc_id AS row_id, source, subject, 'NaiveBayes' AS model, label, true AS score_in_bounds, true AS is_class
  FROM ({_FEATURE_ROWS}) WHERE split = 'test'"""
ORACLE["model_roundtrip"] = f"""
  SELECT model, count(*) AS rows_compared, 0::BIGINT AS mismatches
  FROM ({_FEATURE_ROWS}), (SELECT unnest(['LogisticRegression', 'LinearSVC', 'RandomForest', 'NaiveBayes']) AS model)
  WHERE split = 'validation' GROUP BY model"""


def oracle_queries() -> dict[str, str]:
    return dict(ORACLE)
