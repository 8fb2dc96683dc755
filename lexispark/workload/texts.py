"""Cleaning steps.  The single steps run on documents with LaTeX, URLs and citations added."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark.functions import text as T
from lexispark.operators.cleaning import (
    CleaningConfig, clean_text, normalize_tokens, preprocess, token_counts, tokenize,
)
from lexispark.operators.stemming import (
    DOUBLE, HAS_VOWEL, IRREGULAR, MEASURE_1, MEASURE_1_UP, MEASURE_2_UP, SHORT_END, STEP_2, STEP_3, STEP_4, stem_mapping,
)
from lexispark.session import materialize
from lexispark.workload import sql as S
from lexispark.workload.inputs import (
    CLEANING, KEY, LABEL, LATEX_PARTS, latex_documents, table, test_documents, texts, train_documents,
)

NO_DROPS = CleaningConfig(use_lemmatization=False, remove_stopwords=False, remove_single_char_tokens=False)
STOPS_ONLY = CleaningConfig(use_lemmatization=False, remove_single_char_tokens=False)


def _step(column):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return latex_documents(spark, sf_dir).select(KEY, column(F.col("text")).alias("text"))

    return run


def _missing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir).select(KEY, F.when(F.col(LABEL) != "es", F.col("text")).alias("text"))
    return clean_text(docs, "text", CLEANING).select(KEY, "cleaned")


def _tokens(cfg: CleaningConfig):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # hyphens at token ends come from the added text
        return tokenize(latex_documents(spark, sf_dir), "text", cfg).select(KEY, F.array_join("tokens", " ").alias("tokens"))

    return run


def _preset(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = CleaningConfig(preset=name, use_lemmatization=False)
        return clean_text(latex_documents(spark, sf_dir), "text", cfg).select(KEY, "cleaned")

    return run


def stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = token_counts(tokenize(texts(spark, sf_dir), "text", CLEANING))
    return stem_mapping(words)


def stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = CleaningConfig(use_stemming=True, use_lemmatization=False)
    return preprocess(texts(spark, sf_dir).select(KEY, "text"), KEY, "text", cfg).select(KEY, "cleaned")


def plural_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the noun dictionary: plurals whose singular is a token of the corpus too."""
    words = materialize(token_counts(tokenize(texts(spark, sf_dir), "text", CLEANING)).select("token"), "words")
    plurals = words.where(F.col("token").endswith("s") & (F.length("token") > 3)).select(
        "token", F.expr("substring(token, 1, length(token) - 1)").alias("norm"))
    return materialize(
        plurals.join(words.withColumnRenamed("token", "norm"), "norm", "left_semi").select("token", "norm"), "plurals")


def lemmatized(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir).select(KEY, "text")
    return preprocess(docs, KEY, "text", CleaningConfig(), plural_dictionary(spark, sf_dir)).select(KEY, "cleaned")


def lemma_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same normalisation with the dictionary joined by shuffle, as for a large one."""
    docs = tokenize(texts(spark, sf_dir).select(KEY, "text"), "text", CLEANING)
    done = normalize_tokens(docs, KEY, "tokens", plural_dictionary(spark, sf_dir), mapping_is_small=False)
    return done.select(KEY, F.array_join("tokens", " ").alias("cleaned"))


def both_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        preprocess(part(spark, sf_dir).select(KEY, "text"), KEY, "text", CLEANING).select(KEY, F.lit(name).alias("part"), "cleaned")
        for name, part in (("train", train_documents), ("test", test_documents))
    ]
    return parts[0].unionByName(parts[1])


def other_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages, benchmark items and conversations through the cleaner."""
    sources = (
        ("pages", table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id"), F.col("html").alias("text"))),
        ("benchmark", table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("id"), "text")),
        ("conversations", table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), "text")),
    )
    parts = [preprocess(df, "id", "text", CLEANING).select(F.lit(n).alias("source"), "id", "cleaned") for n, df in sources]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUERIES = {
    "c1_missing_text": _missing_text,
    "c2_lowercase": _step(T.lowered),
    "c3_remove_math": _step(lambda c: T.without_math(T.lowered(c))),
    "c4_remove_commands": _step(lambda c: T.without_commands(T.lowered(c))),
    "c5_remove_urls": _step(lambda c: T.without_urls(T.lowered(c))),
    "c6_remove_citations": _step(lambda c: T.without_citations(T.lowered(c))),
    "c7_keep_charset": _step(lambda c: T.only_charset(T.lowered(c))),
    "c7_keep_letters_digits": _step(lambda c: T.only_charset(T.lowered(c), False)),
    "c8_collapse_whitespace": _step(T.collapsed),
    "c9_tokens": _tokens(NO_DROPS),
    "c10_without_stop_words": _tokens(STOPS_ONLY),
    "c11_without_single_chars": _tokens(CLEANING),
    "c12_stem_mapping": stems,
    "c12_stemmed_text": stemmed,
    "c13_lemmatized_text": lemmatized,
    "c13_lemmatized_large_dictionary": lemma_tokens,
    "c14_rejoined_tokens": both_splits,
    "c15_preset_regex_only": _preset("regex_only"),
    "c16_preset_keep_latex_text": _preset("keep_latex_text"),
    "c17_clean_other_tables": other_texts,
}

_P = [S.quote(p) for p in LATEX_PARTS]
LATEX = (f"latex AS (SELECT doc_id, text || {_P[0]} || upper(lang) || {_P[1]} || doc_id || {_P[2]} || doc_id || {_P[3]} "
         f"|| n_chars || {_P[4]} || doc_id || {_P[5]} || {_P[6]} AS text FROM documents)")


def _on_latex(expr: str, name: str = "text") -> str:
    return f"WITH {LATEX} SELECT doc_id, {expr} AS {name} FROM latex"


def _cut(word: str, n: int) -> str:
    return f"substr({word}, 1, length({word}) - {n})"


def _has(word: str, pattern: str) -> str:
    return f"regexp_matches({word}, {S.quote(pattern)})"


def _cases(rules, condition: str, replaced: bool) -> str:
    out = []
    for rule in rules:
        suffix, new = rule if replaced else (rule, "")
        stem = _cut("w", len(suffix))
        test = _has(stem, condition) + (f" AND {_has(stem, '[st]$')}" if suffix == "ion" else "")
        out.append(f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {test} THEN {stem} || '{new}' ELSE w END")
    return "CASE " + "\n  ".join(out) + " ELSE w END"


def stem_sql(source: str) -> str:
    """CTEs from ``source(token)`` to ``stems(token, norm)``."""
    bare = f"CASE WHEN ends_with(w, 'ed') THEN {_cut('w', 2)} WHEN ends_with(w, 'ing') THEN {_cut('w', 3)} END"
    odd = "(ends_with(w, 'ied') OR ends_with(w, 'eed'))"
    logi = f"CASE WHEN {_has(_cut('w', 3), MEASURE_1_UP)} THEN {_cut('w', 1)} ELSE w END"
    final_e = (f"ends_with(w, 'e') AND ({_has(_cut('w', 1), MEASURE_2_UP)} OR ({_has(_cut('w', 1), MEASURE_1)} "
               f"AND NOT {_has(_cut('w', 1), SHORT_END)}))")
    special = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in IRREGULAR.items())
    steps = [
        f"""SELECT token, CASE WHEN ends_with(w, 'ies') AND length(w) = 4 THEN {_cut('w', 3)} || 'ie'
  WHEN ends_with(w, 'sses') THEN {_cut('w', 2)} WHEN ends_with(w, 'ies') THEN {_cut('w', 2)}
  WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN {_cut('w', 1)} ELSE w END AS w FROM s0""",
        f"""SELECT token, w, CASE WHEN NOT {odd} AND {_has(f'({bare})', HAS_VOWEL)} THEN {bare} END AS b FROM s1""",
        f"""SELECT token, CASE
  WHEN ends_with(w, 'ied') THEN {_cut('w', 3)} || CASE WHEN length(w) = 4 THEN 'ie' ELSE 'i' END
  WHEN ends_with(w, 'eed') THEN CASE WHEN {_has(_cut('w', 3), MEASURE_1_UP)} THEN {_cut('w', 1)} ELSE w END
  WHEN b IS NULL THEN w
  WHEN {_has('b', '(at|bl|iz)$')} THEN b || 'e'
  WHEN {_has('b', DOUBLE)} THEN {_cut('b', 1)}
  WHEN {_has('b', '(ll|ss|zz)$')} THEN b
  WHEN {_has('b', MEASURE_1)} AND {_has('b', SHORT_END)} THEN b || 'e'
  ELSE b END AS w FROM s2""",
        f"""SELECT token, CASE WHEN {_has('w', '^.+[^aeiou]y$')} AND NOT {_has('w', '[^aeiou]yy$')}
  THEN {_cut('w', 1)} || 'i' ELSE w END AS w FROM s3""",
        f"""SELECT token, CASE WHEN ends_with(w, 'alli') AND {_has(_cut('w', 4), MEASURE_1_UP)} THEN {_cut('w', 2)}
  ELSE w END AS w FROM s4""",
        f"SELECT token, CASE WHEN ends_with(w, 'logi') THEN {logi} ELSE {_cases(STEP_2, MEASURE_1_UP, True)} END AS w FROM s5",
        f"SELECT token, {_cases(STEP_3, MEASURE_1_UP, True)} AS w FROM s6",
        f"SELECT token, {_cases(STEP_4, MEASURE_2_UP, False)} AS w FROM s7",
        f"SELECT token, CASE WHEN {final_e} THEN {_cut('w', 1)} ELSE w END AS w FROM s8",
        f"""SELECT token, CASE WHEN ends_with(w, 'll') AND {_has(_cut('w', 1), MEASURE_2_UP)} THEN {_cut('w', 1)}
  ELSE w END AS w FROM s9""",
    ]
    ctes = [f"s0 AS (SELECT token, lower(token) AS w FROM {source})"]
    ctes += [f"s{i} AS ({step})" for i, step in enumerate(steps, 1)]
    ctes.append(f"""stems AS MATERIALIZED (SELECT token, CASE lower(token) {special}
  ELSE CASE WHEN length(token) <= 2 THEN lower(token) ELSE w END END AS norm FROM s10)""")
    return ",\n".join(ctes)


TOKENS = f"toks AS MATERIALIZED (SELECT doc_id, {S.full_tokens('text')} AS t FROM documents)"
WORDS = "vocab_words AS (SELECT DISTINCT unnest(t) AS token FROM toks)"
PLURALS = """plurals AS (SELECT token, substr(token, 1, length(token) - 1) AS norm FROM vocab_words
  WHERE ends_with(token, 's') AND length(token) > 3
    AND substr(token, 1, length(token) - 1) IN (SELECT token FROM vocab_words))"""


def _normalized(mapping: str) -> str:
    return f"""pos AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS p FROM toks),
done AS (SELECT doc_id, string_agg(coalesce(norm, token), ' ' ORDER BY p) AS cleaned
         FROM pos LEFT JOIN {mapping} USING (token) GROUP BY doc_id)
SELECT doc_id, coalesce(cleaned, '') AS cleaned FROM toks LEFT JOIN done USING (doc_id)"""


SQL = {
    "c1_missing_text": f"""SELECT doc_id, CASE WHEN lang = 'es' THEN '' ELSE {S.cleaned('text')} END AS cleaned FROM documents""",
    "c2_lowercase": _on_latex("lower(text)"),
    "c3_remove_math": _on_latex(S.sub(S.lowered("text"), S.MATH)),
    "c4_remove_commands": _on_latex(S.sub(S.lowered("text"), S.COMMAND)),
    "c5_remove_urls": _on_latex(S.sub(S.lowered("text"), S.URL)),
    "c6_remove_citations": _on_latex(S.sub(S.lowered("text"), S.CITATION)),
    "c7_keep_charset": _on_latex(S.sub(S.lowered("text"), r"[^a-z0-9\-_ ]")),
    "c7_keep_letters_digits": _on_latex(S.sub(S.lowered("text"), "[^a-z0-9 ]")),
    "c8_collapse_whitespace": _on_latex(S.collapsed("text")),
    "c9_tokens": _on_latex(f"array_to_string({S.words(S.cleaned('text'))}, ' ')", "tokens"),
    "c10_without_stop_words": _on_latex(
        f"array_to_string({S.without_stop_words(S.words(S.cleaned('text')))}, ' ')", "tokens"),
    "c11_without_single_chars": _on_latex(S.full("text"), "tokens"),
    "c12_stem_mapping": f"WITH {TOKENS}, {WORDS}, {stem_sql('vocab_words')} SELECT token, norm FROM stems",
    "c12_stemmed_text": f"WITH {TOKENS}, {WORDS}, {stem_sql('vocab_words')}, {_normalized('stems')}",
    "c13_lemmatized_text": f"WITH {TOKENS}, {WORDS}, {PLURALS}, {_normalized('plurals')}",
    "c13_lemmatized_large_dictionary": f"WITH {TOKENS}, {WORDS}, {PLURALS}, {_normalized('plurals')}",
    "c14_rejoined_tokens": f"""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'test' ELSE 'train' END AS part,
  {S.full('text')} AS cleaned FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "c15_preset_regex_only": _on_latex(S.cleaned("text"), "cleaned"),
    "c16_preset_keep_latex_text": _on_latex(S.cleaned_keeping_braces("text"), "cleaned"),
    "c17_clean_other_tables": f"""SELECT 'pages' AS source, page_id::VARCHAR AS id, {S.full('html')} AS cleaned FROM pages
UNION ALL SELECT 'benchmark', item_id::VARCHAR, {S.full('text')} FROM benchmark
UNION ALL SELECT 'conversations', conv_id || '-' || turn, {S.full('text')} FROM conversations""",
}
