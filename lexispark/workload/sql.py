"""SQL building blocks for DuckDB.  They restate the rules in long form and share no logic with the operators."""

from __future__ import annotations

from lexispark.functions.text import ENGLISH_STOP_WORDS

WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
MATH = r"(?s)\$.*?\$|\\\[.*?\\\]|\\\(.*?\\\)"
COMMAND = r"\\(?:begin|end)\{[^{}]*\}|\\[a-zA-Z]+\*?(?:\[[^\]]*\])?(?:\{[^{}]*\})*"
URL = rf"https?://[^{WS}]+|www\.[^{WS}]+"
CITATION = rf"\[[0-9,{WS}]+\]"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(expr: str, pattern: str, replacement: str = " ") -> str:
    return f"regexp_replace({expr}, {quote(pattern)}, {quote(replacement)}, 'g')"


def lowered(expr: str) -> str:
    return f"lower(coalesce({expr}, ''))"


def collapsed(expr: str) -> str:
    return f"trim({sub(expr, f'[{WS}]+')})"


def cleaned(expr: str) -> str:
    out = lowered(expr)
    for pattern in (MATH, COMMAND, URL, CITATION):
        out = sub(out, pattern)
    return collapsed(sub(out, r"[^a-z0-9\-_ ]"))


def cleaned_keeping_braces(expr: str) -> str:
    out = lowered(expr)
    for pattern, replacement in (
        (r"\$.*?\$", ""), (r"(?s)\\\[.*?\\\]", ""), (r"\\[a-zA-Z]+\{(.*?)\}", r"\1"), (r"\\[a-zA-Z]+", ""),
        (rf"http[^{WS}]+|www[^{WS}]+", ""), (r"\[[0-9, ]+\]", ""),
    ):
        out = sub(out, pattern, replacement)
    return collapsed(sub(out, r"[^a-z0-9\-_ ]"))


def words(cleaned_expr: str) -> str:
    stripped = f"list_transform(string_split({cleaned_expr}, ' '), lambda t: trim(t, '-_'))"
    return f"list_filter({stripped}, lambda t: t <> '')"


def without_stop_words(tokens: str) -> str:
    listed = "[" + ", ".join(quote(w) for w in ENGLISH_STOP_WORDS) + "]"
    return f"list_filter({tokens}, lambda t: NOT list_contains({listed}, t))"


def full_tokens(expr: str) -> str:
    return f"list_filter({without_stop_words(words(cleaned(expr)))}, lambda t: length(t) > 1)"


def full(expr: str) -> str:
    return f"array_to_string({full_tokens(expr)}, ' ')"


def vectorizer_tokens(expr: str) -> str:
    return rf"regexp_extract_all(lower({expr}), '\b\w\w+\b')"


def with_bigrams(tokens: str) -> str:
    return (f"list_concat({tokens}, list_transform(range(1, greatest(len({tokens}), 1)), "
            f"lambda i: {tokens}[i] || ' ' || {tokens}[i + 1]))")


def r6(expr: str) -> str:
    return f"(CASE WHEN round({expr}, 6) = 0 THEN 0::DOUBLE ELSE round(({expr})::DOUBLE, 6) END)"


CORPUS = """corpus AS (
  SELECT d.doc_id, d.lang, d.text, l.doc_id IS NOT NULL AS is_train
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

PREP = f"prep AS MATERIALIZED (SELECT doc_id, lang, is_train, {full('text')} AS cleaned FROM corpus)"

COUNTS = f"""counts AS MATERIALIZED (
  SELECT doc_id, lang, is_train, term, count(*) AS tf
  FROM (SELECT doc_id, lang, is_train, unnest({vectorizer_tokens('cleaned')}) AS term FROM prep)
  GROUP BY ALL)"""


def vocabulary(max_features: int = 2000, min_df: int = 2, name: str = "vocab") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT term, df, cf, row_number() OVER (ORDER BY cf DESC, term) AS rank,
         ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf
  FROM (SELECT term, count(*) AS df, sum(tf) AS cf FROM counts WHERE is_train GROUP BY term),
       (SELECT count(*)::DOUBLE AS n FROM prep WHERE is_train)
  WHERE df >= {min_df}
  QUALIFY row_number() OVER (ORDER BY cf DESC, term) <= {max_features})"""


WEIGHTS = """weights AS MATERIALIZED (
  SELECT doc_id, lang, is_train, term, rank, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS w
  FROM (SELECT c.doc_id, c.lang, c.is_train, v.term, v.rank, (1 + ln(c.tf::DOUBLE)) * v.idf AS raw
        FROM counts c JOIN vocab v USING (term)))"""


def tfidf(max_features: int = 2000) -> str:
    """CTEs from the documents to unit-length rows."""
    return ",\n".join([CORPUS, PREP, COUNTS, vocabulary(max_features), WEIGHTS])


def complement_nb(alpha: float, norm: bool) -> str:
    """CTEs ``theta(term, lang, theta)`` and ``guessed(doc_id, lang, predicted)`` for the test documents."""
    theta = "logged / sum(logged) OVER (PARTITION BY lang)" if norm else "-logged"
    return f"""classes AS (SELECT DISTINCT lang FROM prep WHERE is_train),
class_sum AS (SELECT term, lang, sum(w) AS nc FROM weights WHERE is_train GROUP BY ALL),
term_sum AS (SELECT term, sum(w) AS total FROM weights WHERE is_train GROUP BY ALL),
rest AS (
  SELECT t.term, c.lang, t.total + {alpha}::DOUBLE - coalesce(s.nc, 0) AS rest
  FROM term_sum t CROSS JOIN classes c LEFT JOIN class_sum s ON s.term = t.term AND s.lang = c.lang),
logs AS (SELECT term, lang, ln(rest / sum(rest) OVER (PARTITION BY lang)) AS logged FROM rest),
theta AS MATERIALIZED (SELECT term, lang, {theta} AS theta FROM logs),
guessed AS MATERIALIZED (
  SELECT p.doc_id, p.lang, c.lang AS predicted
  FROM prep p CROSS JOIN classes c
  LEFT JOIN (SELECT w.doc_id, t.lang, sum(w.w * t.theta) AS score
             FROM weights w JOIN theta t USING (term) WHERE NOT is_train GROUP BY ALL) s
    ON s.doc_id = p.doc_id AND s.lang = c.lang
  WHERE NOT p.is_train
  QUALIFY row_number() OVER (PARTITION BY p.doc_id ORDER BY round(coalesce(s.score, 0), 9) DESC, c.lang) = 1)"""


def metrics(source: str, by: str = "", out: str = "metrics") -> str:
    """CTEs from ``source(by..., truth, guess)`` to ``out(by..., n, accuracy, macro_f1)``."""
    keys = f"{by}, " if by else ""
    on = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in by.split(",") if k.strip())
    on = f" AND {on}" if on else ""
    return f"""{out}_labels AS (
  SELECT {keys}truth AS label FROM {source} UNION SELECT {keys}guess AS label FROM {source}),
{out}_f1 AS (
  SELECT {', '.join('a.' + k.strip() for k in by.split(',') if k.strip()) + ', ' if by else ''}a.label,
         count(*) FILTER (b.truth = a.label AND b.guess = a.label) AS tp,
         count(*) FILTER (b.truth = a.label) AS actual,
         count(*) FILTER (b.guess = a.label) AS guessed
  FROM {out}_labels a JOIN {source} b ON (b.truth = a.label OR b.guess = a.label){on}
  GROUP BY ALL),
{out} AS (
  SELECT {keys}sum(actual)::BIGINT AS n, sum(tp)::DOUBLE / sum(actual)::DOUBLE AS accuracy,
         avg(CASE WHEN tp = 0 THEN 0::DOUBLE ELSE 2.0::DOUBLE * tp / (actual + guessed) END) AS macro_f1
  FROM {out}_f1 {'GROUP BY ' + by if by else ''})"""


def seeded_rank(seed: str, key: str, by: str = "") -> str:
    partition = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({partition}ORDER BY md5({quote(seed)} || '|' || {key}::VARCHAR), {key})"


def folds(source: str, key: str, label: str, k: int, seed: int = 42, keep: str = "", out: str = "folded") -> str:
    keep = f", {keep}" if keep else ""
    return f"""{out}_offset AS (
  SELECT {label}, coalesce(sum(n) OVER (ORDER BY {label} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM (SELECT {label}, count(*) AS n FROM {source} GROUP BY 1)),
{out} AS MATERIALIZED (
  SELECT {key}, {label}{keep}, ((off + {seeded_rank(str(seed), key, label)} - 1) % {k})::INTEGER AS fold
  FROM {source} JOIN {out}_offset USING ({label}))"""


def cnb_cv(docs: str, candidates: str, k: int, out: str = "cv", parts: str = "test") -> str:
    """CTEs from ``docs(doc_id, lang, fold, cleaned)`` and ``candidates`` to the fold scores ``out``."""
    p = out
    role = "CASE WHEN d.fold = f.f THEN 'test' ELSE 'train' END"
    which = "WHERE d.fold = f.f" if parts == "test" else ""
    return f"""{p}_folds AS (SELECT unnest(range({k}))::INTEGER AS f),
{p}_tok AS MATERIALIZED (SELECT doc_id, lang, fold, {vectorizer_tokens('cleaned')} AS t FROM {docs}),
{p}_counts AS MATERIALIZED (
  SELECT doc_id, lang, fold, term, len(string_split(term, ' ')) AS nw, count(*) AS tf
  FROM (SELECT doc_id, lang, fold, unnest({with_bigrams('t')}) AS term FROM {p}_tok) GROUP BY ALL),
{p}_cfg AS (SELECT DISTINCT ngram_max, min_df, max_features, sublinear_tf FROM {candidates}),
{p}_n AS (SELECT f, count(*)::DOUBLE AS n FROM {docs} d JOIN {p}_folds ON fold <> f GROUP BY f),
{p}_stats AS (
  SELECT f, ngram_max, min_df, term, count(*) AS df, sum(tf) AS cf
  FROM {p}_counts JOIN {p}_folds ON fold <> f
  JOIN (SELECT DISTINCT ngram_max, min_df FROM {p}_cfg) ON nw <= ngram_max
  GROUP BY ALL HAVING count(*) >= min_df),
{p}_voc AS MATERIALIZED (
  SELECT s.f, ngram_max, min_df, term, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf,
         row_number() OVER (PARTITION BY s.f, ngram_max, min_df ORDER BY cf DESC, term) AS rank
  FROM {p}_stats s JOIN {p}_n n ON n.f = s.f),
{p}_raw AS (
  SELECT doc_id, lang, fold, v.f, g.*, term,
         (CASE WHEN sublinear_tf THEN 1 + ln(tf::DOUBLE) ELSE tf::DOUBLE END) * idf AS raw
  FROM {p}_counts c JOIN {p}_voc v USING (term)
  JOIN {p}_cfg g ON g.ngram_max = v.ngram_max AND g.min_df = v.min_df AND rank <= max_features),
{p}_w AS MATERIALIZED (
  SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id, f, ngram_max, min_df, max_features, sublinear_tf)) AS w
  FROM {p}_raw),
{p}_classes AS (SELECT DISTINCT lang AS cls FROM {docs}),
{p}_nc AS (
  SELECT f, ngram_max, min_df, max_features, sublinear_tf, term, lang AS cls, sum(w) AS nc
  FROM {p}_w WHERE fold <> f GROUP BY ALL),
{p}_total AS (
  SELECT f, ngram_max, min_df, max_features, sublinear_tf, term, sum(w) AS total
  FROM {p}_w WHERE fold <> f GROUP BY ALL),
{p}_rest AS (
  SELECT c.candidate, c.norm, t.f, t.term, k.cls, t.total + c.alpha - coalesce(n.nc, 0) AS rest
  FROM {candidates} c
  JOIN {p}_total t ON t.ngram_max = c.ngram_max AND t.min_df = c.min_df AND t.max_features = c.max_features
    AND t.sublinear_tf = c.sublinear_tf
  CROSS JOIN {p}_classes k
  LEFT JOIN {p}_nc n ON n.f = t.f AND n.ngram_max = t.ngram_max AND n.min_df = t.min_df
    AND n.max_features = t.max_features AND n.sublinear_tf = t.sublinear_tf AND n.term = t.term AND n.cls = k.cls),
{p}_logs AS (SELECT *, ln(rest / sum(rest) OVER (PARTITION BY candidate, f, cls)) AS logged FROM {p}_rest),
{p}_theta AS MATERIALIZED (
  SELECT candidate, f, term, cls,
         CASE WHEN norm THEN logged / sum(logged) OVER (PARTITION BY candidate, f, cls) ELSE -logged END AS theta
  FROM {p}_logs),
{p}_score AS (
  SELECT w.doc_id, c.candidate, w.f, t.cls, sum(w.w * t.theta) AS score
  FROM {p}_w w
  JOIN {candidates} c ON c.ngram_max = w.ngram_max AND c.min_df = w.min_df AND c.max_features = w.max_features
    AND c.sublinear_tf = w.sublinear_tf
  JOIN {p}_theta t ON t.candidate = c.candidate AND t.f = w.f AND t.term = w.term
  {'WHERE w.fold = w.f' if parts == 'test' else ''}
  GROUP BY ALL),
{p}_guess AS MATERIALIZED (
  SELECT c.candidate, {role} AS part, f.f AS fold, d.lang AS truth, k.cls AS guess
  FROM {docs} d CROSS JOIN {p}_folds f CROSS JOIN {candidates} c CROSS JOIN {p}_classes k
  LEFT JOIN {p}_score s ON s.doc_id = d.doc_id AND s.candidate = c.candidate AND s.f = f.f AND s.cls = k.cls
  {which}
  QUALIFY row_number() OVER (
    PARTITION BY d.doc_id, c.candidate, f.f ORDER BY round(coalesce(s.score, 0), 9) DESC, k.cls) = 1),
{metrics(f'{p}_guess', 'candidate, part, fold', p)}"""
