"""Metrics, cross-validation, searches and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lexispark.functions.arithmetic import rounded
from lexispark.operators import knn, metrics as M
from lexispark.operators.linear import SgdConfig
from lexispark.operators.split import nested_subsample, stratified_folds
from lexispark.plans import predict, report, search
from lexispark.plans.evaluate import cross_validate, timed_cross_validate
from lexispark.plans.features import text_features
from lexispark.operators.vocabulary import TfidfConfig
from lexispark.session import class_values, materialize, new_path
from lexispark.sources.sinks import write_results
from lexispark.sources.tables import read_delimited, require_columns
from lexispark.workload import sql as S
from lexispark.workload.inputs import KEY, LABEL, SEED, cleaned_train, documents, features, table
from lexispark.workload.models import UNIT, knn_sql, TEXT_PAIRS

DEFAULTS = {"ngram_max": [1], "min_df": [2], "max_features": [2000], "sublinear_tf": [True], "alpha": [1.0], "norm": [False]}
GRID = {"ngram_max": [1, 2], "min_df": [2], "max_features": [500, 2000], "sublinear_tf": [True], "alpha": [0.1, 1.0],
        "norm": [False, True]}
HALVING = {"ngram_max": [1], "min_df": [2, 5], "max_features": [100, 500], "sublinear_tf": [True, False],
           "alpha": [0.1, 1.0], "norm": [False]}
TUNING_FOLDS, FINAL_FOLDS, FINALISTS, FACTOR = 3, 5, 3, 3
SPACE = {
    "ngram_max": ("choice", [1]), "min_df": ("int", 2, 6), "max_features": ("choice", [200, 500, 1000]),
    "sublinear_tf": ("choice", [True, False]), "alpha": ("log", 0.01, 1.0), "norm": ("choice", [False, True]),
}
N_TRIALS = 6
PARAMS = list(search.CNB_PARAMS)
SCORES = ["mean_macro_f1", "std_macro_f1", "mean_accuracy", "std_accuracy"]


# ---- metrics of one model ----


def _guessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict.complement_nb(features(spark, sf_dir))


def accuracies(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = M.accuracy(_guessed(spark, sf_dir), LABEL, "predicted")
    return scored.select(rounded(F.col("accuracy")).alias("accuracy"))


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.macro_f1(_guessed(spark, sf_dir), LABEL, "predicted").select(rounded(F.col("macro_f1")).alias("macro_f1"))


def confusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.confusion(_guessed(spark, sf_dir), LABEL, "predicted")


def per_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = M.label_scores(M.confusion(_guessed(spark, sf_dir), LABEL, "predicted"))
    return scores.select("label", "tp", "actual", "guessed", rounded(F.col("f1")).alias("f1"))


# ---- cross-validation ----


def _folded(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """Cleaned labelled documents with a fold; only keys and labels are ranked."""
    docs = materialize(cleaned_train(spark, sf_dir), "cleaned")
    return docs.join(stratified_folds(docs.select(KEY, LABEL), KEY, LABEL, k, SEED).drop(LABEL), KEY)


def _cnb(docs: DataFrame, candidates: DataFrame, k: int, train_scores: bool = False) -> DataFrame:
    return search.cnb_cross_validation(docs, KEY, LABEL, "fold", "cleaned", candidates, k, train_scores=train_scores)


def _rounded(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[rounded(F.col(c)).alias(c) if c in names else c for c in df.columns])


def cnb_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _cnb(_folded(spark, sf_dir, 5), search.grid(spark, **DEFAULTS), 5)
    return _rounded(scores.drop("candidate", "part"), ["accuracy", "macro_f1"])


def vector_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-NN on vectors, fitted anew in each fold."""
    rows = knn.dense_rows(table(spark, sf_dir, "embeddings"), "embedding").select("vec_id", "label", "idx", "w")
    folded = rows.join(stratified_folds(rows.select("vec_id", "label"), "vec_id", "label", 3, SEED).drop("label"), "vec_id")
    scores = cross_validate(
        materialize(folded, "folds"), "fold", range(3),
        lambda train, val: knn.knn_predict(train, val, "vec_id", "label", 64, 2, keep=("label",)), "label")
    return _rounded(scores, ["accuracy", "macro_f1"])


def _by_size(spark: SparkSession, sf_dir: str, fit, sizes: tuple[int, ...]) -> DataFrame:
    """Fold scores for several vocabulary sizes; the features are fitted inside each fold."""
    docs = materialize(_folded(spark, sf_dir, 3), "folds")
    inside = [text_features(docs.where(F.col("fold") != fold), docs.where(F.col("fold") == fold), KEY, "cleaned", LABEL,
                            TfidfConfig(max_features=max(sizes))) for fold in range(3)]
    parts = [found.withColumn("fold", F.lit(fold)) for fold, found in enumerate(fit(inside, sizes))]
    scores = M.evaluate(reduce(DataFrame.unionByName, parts), LABEL, "predicted", ["size", "fold"])
    return _rounded(M.summarize_folds(scores, ["size"]), SCORES).withColumn("size", F.col("size").cast("long"))


def knn_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_size(spark, sf_dir, lambda fs, sizes: [predict.nearest_neighbours_by_size(f, sizes) for f in fs], (500, 100))


def logistic_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_size(spark, sf_dir, lambda fs, sizes: predict.logistic_sgd_by_size(fs, sizes, SgdConfig(batch_size=128, epochs=2)), (500, 100))


def fold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _cnb(_folded(spark, sf_dir, 5), search.grid(spark, **DEFAULTS), 5)
    return _rounded(M.summarize_folds(scores), SCORES)


def fold_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = knn.dense_rows(table(spark, sf_dir, "embeddings"), "embedding").select("vec_id", "label", "idx", "w")
    folded = rows.join(stratified_folds(rows.select("vec_id", "label"), "vec_id", "label", 3, SEED).drop("label"), "vec_id")
    return timed_cross_validate(
        materialize(folded, "folds"), "fold", range(3),
        lambda train, val: knn.knn_predict(train, val, "vec_id", "label", 64, 2, keep=("label",)), "label")


# ---- searches ----


def _grid_results(spark: SparkSession, sf_dir: str, axes: dict | None = None) -> DataFrame:
    candidates = search.grid(spark, **(axes or GRID))
    scores = _cnb(_folded(spark, sf_dir, TUNING_FOLDS), candidates, TUNING_FOLDS, train_scores=True)
    return search.grid_search(candidates, materialize(scores, "scores"))


def grid_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid, fold means and ranks."""
    return _rounded(_grid_results(spark, sf_dir), [*SCORES, "mean_train_macro_f1"])


def _halving_results(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    docs = materialize(_folded(spark, sf_dir, TUNING_FOLDS) if docs is None else docs, "folds")
    classes = class_values(docs, LABEL)

    def one_round(candidates: DataFrame, share: float) -> DataFrame:
        part = docs
        if share < 1:
            keys = nested_subsample(docs.select(KEY, LABEL, "fold"), KEY, LABEL, "fold", share, SEED).select(KEY)
            part = docs.join(keys, KEY, "left_semi")
        return M.summarize_folds(_cnb(part, candidates, TUNING_FOLDS), ["candidate"])

    return search.halving_search(
        search.grid(spark, **HALVING), one_round, docs.count(), TUNING_FOLDS, len(classes), FACTOR)


def halving_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _halving_results(spark, sf_dir)
    return _rounded(results, SCORES).select("round", "candidate", *PARAMS, *SCORES, "rank_test_score")


def _final_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = materialize(search.finalists(_halving_results(spark, sf_dir), FINALISTS), "finalists")
    fresh = chosen.select("candidate", "candidate_rank_tuning", *PARAMS)
    scores = M.summarize_folds(_cnb(_folded(spark, sf_dir, FINAL_FOLDS), fresh, FINAL_FOLDS), ["candidate"])
    return search.ordered_results(fresh.join(scores, "candidate"))


def final_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_final_results(spark, sf_dir), SCORES)


def best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation decides; the grid results stand in for the tuning table behind it."""
    validation = materialize(_final_results(spark, sf_dir), "validation")
    tuning = materialize(_grid_results(spark, sf_dir, DEFAULTS), "tuning")
    return search.select_best(validation, tuning, PARAMS)


def typed_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters stored as text and read back with their types."""
    path = new_path(spark, "params")
    counts = documents(spark, sf_dir).groupBy(LABEL).agg(F.count("*").alias("n"))
    text = counts.select(
        LABEL,
        F.concat(F.col("n").cast("string"), F.lit(".0")).alias("max_features"),
        F.when(F.col(LABEL) == "es", "None").otherwise(F.col("n").cast("string")).alias("max_depth"),
        F.when(F.col(LABEL) == "fr", "many").otherwise(F.concat(F.lit("0."), F.col("n").cast("string"))).alias("alpha"),
        F.when(F.col("n") > 200, "True").otherwise("False").alias("norm"))
    write_results(text, path, text=True)
    read = read_delimited(spark, path, "lang string, max_features string, max_depth string, alpha string, norm string", ",")
    return search.typed_params(read, {"max_features": "long", "max_depth": "long", "alpha": "double", "norm": "boolean"})


def random_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = search.trials(spark, N_TRIALS, SEED, SPACE)
    scores = _cnb(_folded(spark, sf_dir, TUNING_FOLDS), candidates, TUNING_FOLDS)
    return _rounded(candidates.join(M.summarize_folds(scores, ["candidate"]), "candidate"), [*SCORES, "alpha"])


# ---- reports ----


def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    scores = {
        "complement_nb": predict.complement_nb(f),
        "complement_nb_norm": predict.complement_nb(f, 0.1, True),
        "knn": predict.nearest_neighbours(f),
    }
    table_ = report.model_comparison({n: M.evaluate(p, LABEL, "predicted") for n, p in scores.items()})
    return _rounded(table_, ["macro_f1", "accuracy"])


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sweeps over the vocabulary size under one column."""
    results = materialize(_grid_results(spark, sf_dir).where("ngram_max = 1 and alpha = 1.0"), "sweeps")
    sweeps = {
        name: (results.where(F.col("norm") == norm).select("max_features", "mean_macro_f1", "mean_accuracy"), "max_features")
        for name, norm in (("complement_nb", False), ("complement_nb_norm", True))
    }
    return _rounded(report.combined_report(sweeps), ["mean_macro_f1", "mean_accuracy"])


def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = materialize(_grid_results(spark, sf_dir), "results")
    keys = [F.round("mean_macro_f1", 9).desc(), F.round("mean_accuracy", 9).desc(), F.asc("candidate")]
    placed = search.ordered_results(results).withColumn("place", F.row_number().over(Window.orderBy(*keys)).cast("long"))
    return _rounded(placed.select("place", "candidate", "mean_macro_f1", "mean_accuracy"), SCORES)


def checked_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = ("candidate", "mean_macro_f1", "std_macro_f1", "rank_test_score")
    return _rounded(require_columns(_grid_results(spark, sf_dir, DEFAULTS), required).select(*required), SCORES)


def top_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"max_features": "features", "alpha": "alpha", "norm": "norm", "mean_macro_f1": "val_macro_f1_mean",
             "std_macro_f1": "val_macro_f1_std", "mean_train_macro_f1": "train_macro_f1_mean", "rank_test_score": "rank",
             "candidate": "candidate"}
    top = report.grid_report(_grid_results(spark, sf_dir), names, "rank", 5, ("candidate",))
    return _rounded(top, ["val_macro_f1_mean", "val_macro_f1_std", "train_macro_f1_mean"])


QUERIES = {
    "g1_accuracy": accuracies,
    "g2_macro_f1": macro,
    "g2_label_scores": per_label,
    "g3_confusion": confusions,
    "g4_cross_validate_complement_nb": cnb_folds,
    "g4_cross_validate_knn": vector_folds,
    "g4_knn_feature_sizes": knn_sizes,
    "g4_logistic_feature_sizes": logistic_sizes,
    "g5_fold_summary": fold_summary,
    "g6_fold_times": fold_times,
    "g7_g8_grid_search": grid_results,
    "g9_successive_halving": halving_results,
    "g10_finalists": final_results,
    "g11_best_params": best_params,
    "g12_typed_params": typed_params,
    "g13_random_trials": random_trials,
    "g14_model_comparison": comparison,
    "g15_combined_report": combined,
    "g16_ordered_results": ordered,
    "g17_result_contract": checked_results,
    "g18_grid_report": top_report,
}

GUESSED = f"{S.tfidf()}, {S.complement_nb(1.0, False)}, pairs AS (SELECT lang AS truth, predicted AS guess FROM guessed)"
CV_DOCS = f"{S.CORPUS}, {S.PREP}, train AS (SELECT * FROM prep WHERE is_train)"


def _literal(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    return f"{value}::DOUBLE" if isinstance(value, float) else f"{value}::INTEGER"


def _grid_sql(axes: dict, name: str = "cand") -> str:
    crossed = " CROSS JOIN ".join(f"(SELECT unnest([{', '.join(map(_literal, v))}]) AS {n})" for n, v in axes.items())
    return (f"{name} AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {', '.join(axes)})::INTEGER AS candidate "
            f"FROM {crossed})")


def _summary_sql(scores: str, out: str, where: str = "true") -> str:
    return f"""{out} AS MATERIALIZED (SELECT candidate, avg(macro_f1) AS mean_macro_f1, stddev_pop(macro_f1) AS std_macro_f1,
  avg(accuracy) AS mean_accuracy, stddev_pop(accuracy) AS std_accuracy FROM {scores} WHERE {where} GROUP BY candidate)"""


R = {c: f"{S.r6(c)} AS {c}" for c in [*SCORES, "mean_train_macro_f1"]}
SCORE_COLS = ", ".join(R[c] for c in SCORES)


def _grid_search_sql(axes: dict) -> str:
    return f"""WITH {CV_DOCS}, {S.folds('train', 'doc_id', 'lang', TUNING_FOLDS, keep='cleaned')}, {_grid_sql(axes)},
{S.cnb_cv('folded', 'cand', TUNING_FOLDS, 'cv', 'both')},
{_summary_sql('cv', 'summary', "part = 'test'")},
fitted AS (SELECT candidate, avg(macro_f1) AS mean_train_macro_f1 FROM cv WHERE part = 'train' GROUP BY candidate),
results AS MATERIALIZED (SELECT cand.*, summary.* EXCLUDE (candidate), mean_train_macro_f1,
  rank() OVER (ORDER BY round(mean_macro_f1, 9) DESC)::INTEGER AS rank_test_score
  FROM cand JOIN summary USING (candidate) JOIN fitted USING (candidate))"""


def _halving_sql() -> str:
    """Three rounds, as the schedule has for 16 candidates with three folds and four classes."""
    n = "(SELECT count(*) FROM train)"
    first = f"greatest({TUNING_FOLDS * 2} * (SELECT count(DISTINCT lang) FROM train), {n} // {FACTOR ** 2})"
    out = [CV_DOCS, S.folds("train", "doc_id", "lang", TUNING_FOLDS, keep="cleaned"), _grid_sql(HALVING),
           f"""ordered AS MATERIALIZED (SELECT *, {S.seeded_rank(str(SEED), 'doc_id', 'fold, lang')} AS r,
  count(*) OVER (PARTITION BY fold, lang) AS m FROM folded)""",
           "k0 AS (SELECT * FROM cand)"]
    for i in range(3):
        share = f"(least({n}, {first} * {FACTOR ** i})::DOUBLE / {n})"
        out += [
            f"""d{i} AS MATERIALIZED (SELECT doc_id, lang, fold, cleaned FROM ordered
  WHERE {share} >= 1 OR r <= ceil(round(m * {share}, 9)))""",
            S.cnb_cv(f"d{i}", f"k{i}", TUNING_FOLDS, f"cv{i}"),
            _summary_sql(f"cv{i}", f"sum{i}"),
            f"""k{i + 1} AS MATERIALIZED (SELECT k.* FROM k{i} k JOIN sum{i} s USING (candidate)
  ORDER BY round(mean_macro_f1, 9) DESC, candidate LIMIT (SELECT ceil(count(*) / {FACTOR}.0)::BIGINT FROM k{i}))""",
        ]
    rounds = " UNION ALL ".join(f"SELECT {i}::INTEGER AS round, * FROM sum{i}" for i in range(3))
    out.append(f"""halved AS MATERIALIZED (SELECT round, cand.*, r.* EXCLUDE (round, candidate),
  rank() OVER (ORDER BY round(mean_macro_f1, 9) DESC)::INTEGER AS rank_test_score
  FROM ({rounds}) r JOIN cand USING (candidate))""")
    return ",\n".join(out)


FINAL_SQL = f"""WITH {_halving_sql()},
last_round AS (SELECT * FROM halved QUALIFY row_number() OVER (PARTITION BY candidate ORDER BY round DESC) = 1),
chosen AS MATERIALIZED (SELECT candidate, {', '.join(PARAMS)},
  row_number() OVER (ORDER BY round DESC, round(mean_macro_f1, 9) DESC, candidate)::INTEGER AS candidate_rank_tuning
  FROM last_round QUALIFY candidate_rank_tuning <= {FINALISTS}),
{S.folds('train', 'doc_id', 'lang', FINAL_FOLDS, keep='cleaned', out='refolded')},
{S.cnb_cv('refolded', 'chosen', FINAL_FOLDS, 'final')},
{_summary_sql('final', 'final_summary')},
finals AS (SELECT * FROM chosen JOIN final_summary USING (candidate))"""


def _trial_sql() -> str:
    def u(name: str) -> str:
        return f"(('0x' || substr(md5('{SEED}|{name}|' || i), 1, 13))::BIGINT::DOUBLE / {16 ** 13}::DOUBLE)"

    cols = []
    for name, spec in SPACE.items():
        if spec[0] == "int":
            cols.append(f"(floor({u(name)} * {spec[2] - spec[1] + 1}) + {spec[1]})::INTEGER AS {name}")
        elif spec[0] == "log":
            cols.append(f"exp(ln({spec[1]}::DOUBLE) + {u(name)} * (ln({spec[2]}::DOUBLE) - ln({spec[1]}::DOUBLE))) AS {name}")
        else:
            values = ", ".join(map(_literal, spec[1]))
            cols.append(f"([{values}])[floor({u(name)} * {len(spec[1])})::INTEGER + 1] AS {name}")
    return f"cand AS MATERIALIZED (SELECT i::INTEGER AS candidate, {', '.join(cols)} FROM range(1, {N_TRIALS + 1}) t(i))"


VECTOR_CV = f"""vecs AS (SELECT vec_id, label FROM embeddings), {S.folds('vecs', 'vec_id', 'label', 3)}, {UNIT},
{knn_sql('''pairs AS (SELECT a.vec_id, b.vec_id AS neighbour, b.label, round(sum(a.x * b.x), 9) AS sim
  FROM unit a JOIN folded fa ON fa.vec_id = a.vec_id JOIN unit b USING (pos) JOIN folded fb ON fb.vec_id = b.vec_id
  WHERE fa.fold <> fb.fold GROUP BY ALL)''', 'vec_id', 2)},
scored AS (SELECT fold, label AS truth, predicted AS guess FROM folded JOIN voted USING (vec_id)),
{S.metrics('scored', 'fold')}"""


def _knn_size_cv_sql() -> str:
    return f"""WITH {CV_DOCS}, {S.folds('train', 'doc_id', 'lang', 3, keep='cleaned')},
fs AS (SELECT unnest(range(3))::INTEGER AS f), sizes AS (SELECT unnest([500, 100])::BIGINT AS size),
c AS MATERIALIZED (SELECT doc_id, fold, term, count(*) AS tf
  FROM (SELECT doc_id, fold, unnest({S.vectorizer_tokens('cleaned')}) AS term FROM folded) GROUP BY ALL),
n AS (SELECT f, count(*)::DOUBLE AS n FROM folded JOIN fs ON fold <> f GROUP BY f),
v AS MATERIALIZED (SELECT f, term, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf,
  row_number() OVER (PARTITION BY f ORDER BY cf DESC, term) AS rank
  FROM (SELECT f, term, count(*) AS df, sum(tf) AS cf FROM c JOIN fs ON fold <> f GROUP BY ALL HAVING count(*) >= 2) JOIN n USING (f)),
raw AS (SELECT size, f, doc_id, fold, term, (1 + ln(tf::DOUBLE)) * idf AS raw FROM c JOIN v USING (term) JOIN sizes ON rank <= size),
w AS MATERIALIZED (SELECT size, f, doc_id, fold, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY size, f, doc_id)) AS w FROM raw),
s AS (SELECT x.size, x.doc_id AS a, y.doc_id AS b, sum(x.w * y.w) AS s
  FROM w x JOIN w y ON x.size = y.size AND x.f = y.f AND x.term = y.term AND x.fold = x.f AND y.fold <> y.f GROUP BY ALL),
{knn_sql('''pairs AS (SELECT z.size, a.doc_id, b.doc_id AS neighbour, b.lang AS label, round(coalesce(s.s, 0), 9) AS sim
  FROM sizes z CROSS JOIN folded a JOIN folded b ON a.fold <> b.fold
  LEFT JOIN s ON s.size = z.size AND s.a = a.doc_id AND s.b = b.doc_id)''', 'doc_id', 2, group='size')},
scored AS (SELECT size, fold, lang AS truth, predicted AS guess FROM folded JOIN voted USING (doc_id)),
{S.metrics('scored', 'size, fold')}
SELECT size, {', '.join(S.r6(e) + ' AS ' + c for c, e in zip(SCORES, ('avg(macro_f1)', 'stddev_pop(macro_f1)', 'avg(accuracy)', 'stddev_pop(accuracy)')))}
FROM metrics GROUP BY size"""


CV_DEFAULT = f"""WITH {CV_DOCS}, {S.folds('train', 'doc_id', 'lang', 5, keep='cleaned')}, {_grid_sql(DEFAULTS)},
{S.cnb_cv('folded', 'cand', 5)}"""

SQL = {
    "g1_accuracy": f"WITH {GUESSED}, {S.metrics('pairs')} SELECT {S.r6('accuracy')} AS accuracy FROM metrics",
    "g2_macro_f1": f"WITH {GUESSED}, {S.metrics('pairs')} SELECT {S.r6('macro_f1')} AS macro_f1 FROM metrics",
    "g2_label_scores": f"""WITH {GUESSED}, {S.metrics('pairs')}
SELECT label, tp, actual, guessed, {S.r6('CASE WHEN tp = 0 THEN 0::DOUBLE ELSE 2.0::DOUBLE * tp / (actual + guessed) END')} AS f1 FROM metrics_f1""",
    "g3_confusion": f"WITH {GUESSED} SELECT truth, guess, count(*) AS n FROM pairs GROUP BY ALL",
    "g4_cross_validate_complement_nb": f"""{CV_DEFAULT}
SELECT fold, n, {S.r6('accuracy')} AS accuracy, {S.r6('macro_f1')} AS macro_f1 FROM cv""",
    "g4_cross_validate_knn": f"""WITH {VECTOR_CV}
SELECT fold, n, {S.r6('accuracy')} AS accuracy, {S.r6('macro_f1')} AS macro_f1 FROM metrics""",
    "g4_knn_feature_sizes": _knn_size_cv_sql(),
    "g5_fold_summary": f"{CV_DEFAULT}, {_summary_sql('cv', 'summary')} SELECT {SCORE_COLS} FROM summary",
    "g7_g8_grid_search": f"""{_grid_search_sql(GRID)}
SELECT candidate, {', '.join(PARAMS)}, {SCORE_COLS}, {R['mean_train_macro_f1']}, rank_test_score FROM results""",
    "g9_successive_halving": f"""WITH {_halving_sql()}
SELECT round, candidate, {', '.join(PARAMS)}, {SCORE_COLS}, rank_test_score FROM halved""",
    "g10_finalists": f"{FINAL_SQL} SELECT candidate, candidate_rank_tuning, {', '.join(PARAMS)}, {SCORE_COLS} FROM finals",
    "g11_best_params": f"""{FINAL_SQL} SELECT {', '.join(PARAMS)} FROM finals
ORDER BY round(mean_macro_f1, 9) DESC, round(mean_accuracy, 9) DESC, candidate LIMIT 1""",
    "g12_typed_params": """SELECT lang, n AS max_features, CASE WHEN lang <> 'es' THEN n END AS max_depth,
  CASE WHEN lang <> 'fr' THEN ('0.' || n)::DOUBLE END AS alpha, n > 200 AS norm
FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1)""",
    "g13_random_trials": f"""WITH {CV_DOCS}, {S.folds('train', 'doc_id', 'lang', TUNING_FOLDS, keep='cleaned')}, {_trial_sql()},
{S.cnb_cv('folded', 'cand', TUNING_FOLDS)}, {_summary_sql('cv', 'summary')}
SELECT candidate, ngram_max, min_df, max_features, sublinear_tf, {S.r6('alpha')} AS alpha, norm, {SCORE_COLS}
FROM cand JOIN summary USING (candidate)""",
    "g14_model_comparison": f"""WITH {S.tfidf()}, {S.complement_nb(1.0, False)},
{S.complement_nb(0.1, True).replace('classes', 'classes2').replace('class_sum', 'class_sum2').replace('term_sum', 'term_sum2').replace('rest AS', 'rest2 AS').replace('FROM rest)', 'FROM rest2)').replace('logs', 'logs2').replace('theta AS MAT', 'theta2 AS MAT').replace('JOIN theta t', 'JOIN theta2 t').replace('guessed', 'guessed2')},
{knn_sql(TEXT_PAIRS, 'doc_id', 2)},
p1 AS (SELECT lang AS truth, predicted AS guess FROM guessed), p2 AS (SELECT lang AS truth, predicted AS guess FROM guessed2),
p3 AS (SELECT lang AS truth, predicted AS guess FROM voted JOIN prep USING (doc_id)),
{S.metrics('p1', '', 'm1')}, {S.metrics('p2', '', 'm2')}, {S.metrics('p3', '', 'm3')}
SELECT model, {S.r6('macro_f1')} AS macro_f1, {S.r6('accuracy')} AS accuracy FROM (
  SELECT 'complement_nb' AS model, * FROM m1 UNION ALL SELECT 'complement_nb_norm', * FROM m2 UNION ALL SELECT 'knn', * FROM m3)""",
    "g15_combined_report": f"""{_grid_search_sql(GRID)}
SELECT max_features AS size, {R['mean_macro_f1']}, {R['mean_accuracy']},
  CASE WHEN norm THEN 'complement_nb_norm' ELSE 'complement_nb' END AS method
FROM results WHERE ngram_max = 1 AND alpha = 1""",
    "g16_ordered_results": f"""{_grid_search_sql(GRID)}
SELECT row_number() OVER (ORDER BY round(mean_macro_f1, 9) DESC, round(mean_accuracy, 9) DESC, candidate) AS place,
  candidate, {R['mean_macro_f1']}, {R['mean_accuracy']} FROM results""",
    "g17_result_contract": f"""{_grid_search_sql(DEFAULTS)}
SELECT candidate, {R['mean_macro_f1']}, {R['std_macro_f1']}, rank_test_score FROM results""",
    "g18_grid_report": f"""{_grid_search_sql(GRID)}
SELECT max_features AS features, alpha, norm, {S.r6('mean_macro_f1')} AS val_macro_f1_mean,
  {S.r6('std_macro_f1')} AS val_macro_f1_std, {S.r6('mean_train_macro_f1')} AS train_macro_f1_mean,
  rank_test_score AS rank, candidate
FROM results ORDER BY rank_test_score, candidate LIMIT 5""",
}
