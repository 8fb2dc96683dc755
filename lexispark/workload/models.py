"""Classifiers: fitted parameters and predictions."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark.functions.arithmetic import binary_log_loss, literal_array, rounded, sigmoid
from lexispark.operators import bayes, knn, linear, trees
from lexispark.operators.reduce import truncated_svd
from lexispark.operators.scoring import linear_scores
from lexispark.plans import predict
from lexispark.plans.features import TextFeatures, text_features
from lexispark.session import class_values
from lexispark.workload import sql as S
from lexispark.workload.inputs import (
    CLEANING, KEY, LABEL, SEED, TFIDF, features, quality_documents, table, test_documents, train_documents,
    vectors,
)

EPOCHS, BATCHES, RATE, REG = 2, 2, 2.0, 1e-4
HINGE_EPOCHS, HINGE_RATE, HINGE_C = 3, 0.2, 0.5


# ---- logistic regression ----


def sigmoids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "z")).select(
        "vec_id", F.col("pos").cast("long").alias("pos"), rounded(sigmoid(F.col("z").cast("double") * 10.0)).alias("p"))


def log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss per class when the first coordinate scores the class; extreme scores reach the clip."""
    e = table(spark, sf_dir, "embeddings").withColumn("p", sigmoid(F.col("embedding")[0].cast("double") * 400.0))
    classes = class_values(e, "label")
    one = e.withColumn("cls", F.explode(literal_array(classes)))
    y = (F.col("label") == F.col("cls")).cast("double")
    return one.groupBy("cls").agg(rounded(F.avg(binary_log_loss(y, F.col("p")))).alias("loss"))


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_documents(spark, sf_dir).select(F.col("quality") == 1)
    return linear.binary_class_weights(rows.toDF("good"), "good").select(
        rounded(F.col("pos_weight")).alias("pos_weight"), rounded(F.col("neg_weight")).alias("neg_weight"))


def _binary_features(spark: SparkSession, sf_dir: str) -> TextFeatures:
    return text_features(quality_documents(spark, sf_dir), test_documents(spark, sf_dir), KEY, "text", "quality", TFIDF,
                         CLEANING)


def first_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted one-vs-rest gradient at zero weights, divided by the weight sum."""
    f = features(spark, sf_dir)
    counts = {r[LABEL]: r["count"] for r in f.train_docs.groupBy(LABEL).count().collect()}
    classes, n = sorted(counts), sum(counts.values())
    is_class = [F.col(LABEL) == F.lit(c) for c in classes]
    weight = [F.when(i, n / (2.0 * counts[c])).otherwise(n / (2.0 * (n - counts[c]))) for c, i in zip(classes, is_class)]
    errors = f.train_docs.select(
        KEY, F.array(*[(F.lit(0.5) - i.cast("double")) * w for i, w in zip(is_class, weight)]).alias("err"))
    # each class's weights add up to n, half on either side
    summed = linear.gradient_terms(
        f.train_weights.join(f.vocab.select("rank", "term"), "rank"), errors, KEY, len(classes))
    return summed.select("term", F.posexplode("gradient").alias("c", "g")).select(
        "term", literal_array(classes)[F.col("c")].alias(LABEL), rounded(F.col("g") / n).alias("gradient"))


def _sgd(f: TextFeatures) -> linear.LinearModel:
    n = f.train_docs.count()
    return linear.fit_ovr(f.train_rows(), KEY, f.label, f.n_features,
                          linear.SgdConfig(ceil(n / BATCHES), EPOCHS, RATE, REG, seed=SEED))


def _model_table(model: linear.LinearModel, f: TextFeatures) -> DataFrame:
    names = f.vocab.select((F.col("rank") - 1).alias("feature"), "term")
    rows = model.as_table(f.docs.sparkSession).join(names, "feature", "left")
    return rows.where("feature = -1 or term is not null").select(
        "label", F.coalesce("term", F.lit("")).alias("term"), rounded(F.col("weight")).alias("weight"))


def binary_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _binary_features(spark, sf_dir)
    return _model_table(_sgd(f), f).where("label = 1").select("term", "weight")


def binary_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 if the probability of the positive class is at least one half."""
    f = _binary_features(spark, sf_dir)
    model = _sgd(f)
    positive = linear.LinearModel([1], model.weights[1:], model.bias[1:])
    scored = linear_scores(f.test_docs, f.test_weights, positive.theta(spark), KEY, 1, positive.bias, (), f.n_features,
                           "rank")
    p = F.round(sigmoid(F.col("scores")[0]), 9)
    return scored.select(KEY, (p >= 0.5).cast("long").alias("predicted"))


def ovr_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    return _model_table(_sgd(f), f)


def ovr_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    return linear.predict_rows(_sgd(f), f.test_rows(), KEY)


def squared_hinge(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    model = linear.fit_squared_hinge_svm(f.train_rows(), KEY, LABEL, f.n_features, HINGE_C, HINGE_EPOCHS, HINGE_RATE)
    return _model_table(model, f)


def _guess(fit):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fit(features(spark, sf_dir)).select(KEY, "predicted")

    return run


# ---- nearest neighbours ----


def text_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    near = knn.knn_neighbours(f.train_rows(), f.test_rows(), KEY, LABEL, f.n_features, 2)
    return near.select(KEY, "neighbour", LABEL, rounded(F.col("distance")).alias("distance"),
                       F.col("rank").cast("long").alias("rank"))


def vector_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = knn.knn_neighbours(*vectors(spark, sf_dir), "vec_id", "label", 64, 5, block_rows=64)
    return near.select("vec_id", "neighbour", "label", rounded(F.col("distance")).alias("distance"),
                       F.col("rank").cast("long").alias("rank"))


def vector_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.knn_predict(*vectors(spark, sf_dir), "vec_id", "label", 64, 2)


def vector_knn_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.knn_predict(*vectors(spark, sf_dir), "vec_id", "label", 64, 5, "uniform")


def rotated_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours after an SVD with all components, which keeps all angles."""
    train, test = vectors(spark, sf_dir)
    model = truncated_svd(train, 64, 64)
    rows = [
        knn.dense_rows(model.project(part, "vec_id", ("label",)), "vector") for part in (train, test)
    ]
    return knn.knn_predict(*rows, "vec_id", "label", 64, 2)


def size_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict.nearest_neighbours_by_size(features(spark, sf_dir), (2000, 1000, 500, 100)).select(
        F.col("size").cast("long").alias("size"), KEY, "predicted")


# ---- complement naive Bayes ----


def _theta(alpha: float, norm: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        f = features(spark, sf_dir)
        classes = class_values(f.train_docs, LABEL)
        theta = bayes.fit_complement_nb(f.train_weights, classes, LABEL, alpha, norm, "rank")
        named = theta.join(f.vocab.select("rank", "term"), "rank").select("term", F.posexplode("theta").alias("c", "t"))
        return named.select("term", literal_array(classes)[F.col("c")].alias(LABEL), rounded(F.col("t")).alias("theta"))

    return run


def _nb(alpha: float, norm: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return predict.complement_nb(features(spark, sf_dir), alpha, norm).select(KEY, "predicted")

    return run


# ---- models on embeddings ----


def _vector_model(fit):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, test = vectors(spark, sf_dir)
        return fit(linear.ml_vectors(train, 64), linear.ml_vectors(test, 64))

    return run


def _forest(train: DataFrame, test: DataFrame) -> DataFrame:
    cfg = trees.ForestConfig(n_trees=50, max_depth=15, min_samples_split=3)
    return trees.fit_random_forest(train, "label", cfg).predict(test, "vec_id")


def _boosted(train: DataFrame, test: DataFrame) -> DataFrame:
    cfg = trees.BoostingConfig(n_rounds=3, max_depth=3, learning_rate=0.1)
    return trees.fit_boosted_trees(train, "label", cfg).predict(test, "vec_id")


def _multinomial(train: DataFrame, test: DataFrame) -> DataFrame:
    return linear.predict_rows(linear.fit_multinomial(train, "label", 1.0, True, 100), test, "vec_id")


def class_weight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linear.with_class_weights(train_documents(spark, sf_dir).select(KEY, LABEL), LABEL)
    return rows.select(KEY, LABEL, rounded(F.col("class_weight")).alias("class_weight"))


QUERIES = {
    "f1_sigmoid": sigmoids,
    "f2_log_loss": log_loss,
    "f3_binary_class_weights": quality_weights,
    "f4_weighted_gradient": first_gradient,
    "f5_binary_sgd_weights": binary_sgd,
    "f6_binary_predictions": binary_predictions,
    "f7_ovr_sgd_weights": ovr_sgd,
    "f8_ovr_predictions": ovr_predictions,
    "f9_logistic_mllib": _guess(lambda f: predict.logistic_mllib(f, 1.0, 30)),
    "f10_knn_neighbours": text_neighbours,
    "f10_knn_predict": _guess(predict.nearest_neighbours),
    "f10_knn_predict_by_size": size_predictions,
    "f10a_vector_neighbours": vector_neighbours,
    "f10b_knn_vectors": vector_knn,
    "f10b_knn_vectors_uniform": vector_knn_uniform,
    "f10b_knn_after_svd": rotated_knn,
    "f10b_knn_text_svd": _guess(lambda f: predict.nearest_neighbours_svd(f, 100)),
    "f11_linear_svm": _guess(lambda f: predict.linear_svm(f, 0.5, 30)),
    "f11_squared_hinge_weights": squared_hinge,
    "f12_complement_nb_weights": _theta(1.0, False),
    "f12_complement_nb_weights_norm": _theta(0.1, True),
    "f12_complement_nb_predict": _nb(1.0, False),
    "f12_complement_nb_predict_norm": _nb(0.1, True),
    "f13_random_forest_text": _guess(
        lambda f: predict.random_forest(f, trees.ForestConfig(n_trees=20, max_depth=15, min_samples_split=3))),
    "f13_random_forest_vectors": _vector_model(_forest),
    "f14_boosted_trees": _vector_model(_boosted),
    "f15_multinomial_vectors": _vector_model(_multinomial),
    "f15_svd_logistic": _guess(lambda f: predict.svd_logistic(f, 100)),
    "f16_class_weights": class_weight_rows,
}


def _sgd_sql(labels: str, n_batches: int, epochs: int, rate: float, reg: str, loss: str = "log") -> str:
    """CTEs from ``weights`` and ``labels(doc_id, label)`` to the weights ``wN`` and biases ``bN`` after all updates."""
    if loss == "log":
        pos, neg = "n / (2.0::DOUBLE * nc)", "n / (2.0::DOUBLE * (n - nc))"
        error = "(1 / (1 + exp(-z)) - y) * sw"
    else:
        pos, neg = "n / (k * nc)", "1::DOUBLE"
        error = "-2 * (2 * y - 1) * greatest(0, 1 - (2 * y - 1) * z) * sw"
    out = [f"""lab AS MATERIALIZED ({labels})""",
           """cls AS MATERIALIZED (SELECT label, count(*)::DOUBLE AS nc, (SELECT count(*)::DOUBLE FROM lab) AS n,
  (SELECT count(DISTINCT label)::DOUBLE FROM lab) AS k FROM lab GROUP BY label)""",
           f"""yy AS MATERIALIZED (SELECT l.doc_id, c.label, (l.label = c.label)::INTEGER::DOUBLE AS y,
  CASE WHEN l.label = c.label THEN {pos} ELSE {neg} END AS sw FROM lab l CROSS JOIN cls c)""",
           "x AS MATERIALIZED (SELECT w.doc_id, w.term, w.w FROM weights w JOIN lab USING (doc_id) WHERE is_train)",
           "w0 AS (SELECT DISTINCT term, label, 0::DOUBLE AS v FROM vocab CROSS JOIN cls)",
           "b0 AS (SELECT label, 0::DOUBLE AS v FROM cls)"]
    u = 0
    for epoch in range(epochs):
        size = f"ceil((SELECT count(*) FROM lab) / {n_batches}::DOUBLE)::BIGINT"
        out.append(f"""o{epoch} AS (SELECT doc_id, (row_number() OVER (ORDER BY md5('{SEED}|{epoch}|' || doc_id), doc_id) - 1)
  // {size} AS batch FROM lab)""")
        for batch in range(n_batches):
            out += [
                f"""e{u} AS MATERIALIZED (SELECT doc_id, label, sw, {error} AS err FROM (
  SELECT y.doc_id, y.label, y.y, y.sw, b.v + coalesce(s.s, 0) AS z
  FROM yy y JOIN o{epoch} o USING (doc_id) JOIN b{u} b USING (label)
  LEFT JOIN (SELECT x.doc_id, w.label, sum(x.w * w.v) AS s FROM x JOIN w{u} w USING (term) GROUP BY ALL) s
    ON s.doc_id = y.doc_id AND s.label = y.label
  WHERE o.batch = {batch}))""",
                f"t{u} AS MATERIALIZED (SELECT label, sum(err) AS e, sum(sw) AS s FROM e{u} GROUP BY label)",
                f"""g{u} AS (SELECT x.term, e.label, sum(x.w * e.err) AS g FROM x JOIN e{u} e USING (doc_id) GROUP BY ALL)""",
                f"""w{u + 1} AS MATERIALIZED (SELECT w.term, w.label, w.v - {rate}::DOUBLE * (coalesce(g.g, 0) / t.s + ({reg}) * w.v) AS v
  FROM w{u} w JOIN t{u} t USING (label) JOIN cls c USING (label)
  LEFT JOIN g{u} g ON g.term = w.term AND g.label = w.label)""",
                f"""b{u + 1} AS MATERIALIZED (SELECT label, b.v - {rate}::DOUBLE * t.e / t.s AS v FROM b{u} b JOIN t{u} t USING (label))""",
            ]
            u += 1
    out += [f"wn AS (SELECT * FROM w{u})", f"bn AS (SELECT * FROM b{u})"]
    return ",\n".join(out)


QUALITY = "SELECT doc_id, quality AS label FROM labels JOIN documents USING (doc_id)"
LANG = "SELECT doc_id, lang AS label FROM prep WHERE is_train"
BINARY_SQL = f"WITH {S.tfidf()}, {_sgd_sql(QUALITY, BATCHES, EPOCHS, RATE, f'{REG}::DOUBLE')}"
OVR_SQL = f"WITH {S.tfidf()}, {_sgd_sql(LANG, BATCHES, EPOCHS, RATE, f'{REG}::DOUBLE')}"
HINGE_SQL = f"""WITH {S.tfidf()}, {_sgd_sql(
    LANG, 1, HINGE_EPOCHS, HINGE_RATE, f'1 / ({HINGE_C}::DOUBLE * (c.n / c.k + c.n - c.nc))', 'hinge')}"""
MODEL_ROWS = f"""SELECT label, term, {S.r6('v')} AS weight FROM wn
UNION ALL SELECT label, '' AS term, {S.r6('v')} AS weight FROM bn"""
TEST_SCORES = """scores AS (SELECT p.doc_id, b.label, b.v + coalesce(s.s, 0) AS z
  FROM prep p CROSS JOIN bn b
  LEFT JOIN (SELECT w.doc_id, m.label, sum(w.w * m.v) AS s FROM weights w JOIN wn m USING (term) WHERE NOT is_train GROUP BY ALL) s
    ON s.doc_id = p.doc_id AND s.label = b.label
  WHERE NOT p.is_train)"""


def knn_sql(pairs: str, key: str, k: int, weighting: str = "distance", group: str = "") -> str:
    """CTEs from ``pairs(key, neighbour, label, sim)`` to ``near`` and ``voted(key, predicted)``."""
    g = f"{group}, " if group else ""
    vote = "1::DOUBLE" if weighting == "uniform" else (
        f"CASE WHEN min(d) OVER (PARTITION BY {g}{key}) < 1e-9 THEN (d < 1e-9)::INTEGER::DOUBLE ELSE 1 / d END")
    return f"""{pairs},
near AS MATERIALIZED (
  SELECT {g}{key}, neighbour, label, 1 - sim AS d, row_number() OVER (PARTITION BY {g}{key} ORDER BY sim DESC, label, neighbour) AS rank
  FROM pairs QUALIFY rank <= {k}),
votes AS (SELECT {g}{key}, label, {vote} AS v FROM near),
voted AS (SELECT {g}{key}, label AS predicted FROM (SELECT {g}{key}, label, round(sum(v), 9) AS v FROM votes GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY {g}{key} ORDER BY v DESC, label) = 1)"""


TEXT_PAIRS = """pairs AS (
  SELECT a.doc_id, b.doc_id AS neighbour, b.lang AS label, round(coalesce(s.s, 0), 9) AS sim
  FROM prep a CROSS JOIN prep b
  LEFT JOIN (SELECT x.doc_id AS a, y.doc_id AS b, sum(x.w * y.w) AS s FROM weights x JOIN weights y USING (rank)
             WHERE NOT x.is_train AND y.is_train GROUP BY ALL) s ON s.a = a.doc_id AND s.b = b.doc_id
  WHERE NOT a.is_train AND b.is_train)"""
UNIT = """flat AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
unit AS MATERIALIZED (SELECT vec_id, label, pos, x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS x FROM flat)"""
VECTOR_PAIRS = f"""{UNIT},
pairs AS (SELECT a.vec_id, b.vec_id AS neighbour, b.label, round(sum(a.x * b.x), 9) AS sim
  FROM unit a JOIN unit b USING (pos)
  WHERE a.vec_id NOT IN (SELECT doc_id FROM labels) AND b.vec_id IN (SELECT doc_id FROM labels) GROUP BY ALL)"""
SIZE_PAIRS = """sizes AS (SELECT unnest([2000, 1000, 500, 100])::BIGINT AS size),
sraw AS (SELECT s.size, c.doc_id, c.is_train, v.rank, (1 + ln(tf::DOUBLE)) * idf AS raw
        FROM counts c JOIN vocab v USING (term) JOIN sizes s ON v.rank <= s.size),
sw AS MATERIALIZED (SELECT size, doc_id, is_train, rank, raw / sqrt(sum(raw * raw) OVER (PARTITION BY size, doc_id)) AS w FROM sraw),
pairs AS (
  SELECT z.size, a.doc_id, b.doc_id AS neighbour, b.lang AS label, round(coalesce(s.s, 0), 9) AS sim
  FROM sizes z CROSS JOIN prep a CROSS JOIN prep b
  LEFT JOIN (SELECT x.size, x.doc_id AS a, y.doc_id AS b, sum(x.w * y.w) AS s FROM sw x JOIN sw y USING (size, rank)
             WHERE NOT x.is_train AND y.is_train GROUP BY ALL) s ON s.size = z.size AND s.a = a.doc_id AND s.b = b.doc_id
  WHERE NOT a.is_train AND b.is_train)"""
SQL = {
    "f1_sigmoid": f"""SELECT vec_id, (pos - 1)::BIGINT AS pos, {S.r6('1 / (1 + exp(-(z::DOUBLE * 10)))')} AS p
FROM (SELECT vec_id, unnest(embedding) AS z, generate_subscripts(embedding, 1) AS pos FROM embeddings)""",
    "f2_log_loss": f"""WITH e AS (SELECT label, least(greatest(1 / (1 + exp(-(embedding[1]::DOUBLE * 400))), 1e-15::DOUBLE), 1 - 1e-15::DOUBLE) AS p
  FROM embeddings)
SELECT cls, {S.r6('avg(-((label = cls)::INTEGER * ln(p) + (1 - (label = cls)::INTEGER) * ln(1 - p)))')} AS loss
FROM e CROSS JOIN (SELECT DISTINCT label AS cls FROM embeddings) GROUP BY cls""",
    "f3_binary_class_weights": f"""SELECT {S.r6('count(*) / (2.0::DOUBLE * count(*) FILTER (quality = 1))')} AS pos_weight,
  {S.r6('count(*) / (2.0::DOUBLE * count(*) FILTER (quality <> 1))')} AS neg_weight
FROM labels JOIN documents USING (doc_id)""",
    "f4_weighted_gradient": f"""WITH {S.tfidf()},
c AS (SELECT lang AS cls, count(*)::DOUBLE AS nc, (SELECT count(*)::DOUBLE FROM prep WHERE is_train) AS n
      FROM prep WHERE is_train GROUP BY 1),
e AS (SELECT doc_id, cls, n, CASE WHEN lang = cls THEN -0.5::DOUBLE * n / (2 * nc) ELSE 0.5::DOUBLE * n / (2 * (n - nc)) END AS err
      FROM prep CROSS JOIN c WHERE is_train)
SELECT term, cls AS lang, {S.r6('sum(w * err) / any_value(n)')} AS gradient
FROM weights JOIN e USING (doc_id) WHERE is_train GROUP BY term, cls""",
    "f5_binary_sgd_weights": f"{BINARY_SQL} SELECT term, weight FROM ({MODEL_ROWS}) WHERE label = 1",
    "f6_binary_predictions": f"""{BINARY_SQL}, {TEST_SCORES}
SELECT doc_id, (round(1 / (1 + exp(-z)), 9) >= 0.5)::BIGINT AS predicted FROM scores WHERE label = 1""",
    "f7_ovr_sgd_weights": f"{OVR_SQL} {MODEL_ROWS}",
    "f8_ovr_predictions": f"""{OVR_SQL}, {TEST_SCORES}
SELECT doc_id, label AS predicted FROM scores
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(z, 9) DESC, label) = 1""",
    "f10_knn_neighbours": f"""WITH {S.tfidf()}, {knn_sql(TEXT_PAIRS, 'doc_id', 2)}
SELECT doc_id, neighbour, label AS lang, {S.r6('d')} AS distance, rank FROM near""",
    "f10_knn_predict": f"WITH {S.tfidf()}, {knn_sql(TEXT_PAIRS, 'doc_id', 2)} SELECT * FROM voted",
    "f10_knn_predict_by_size": f"WITH {S.tfidf()}, {knn_sql(SIZE_PAIRS, 'doc_id', 2, group='size')} SELECT * FROM voted",
    "f10a_vector_neighbours": f"""WITH {knn_sql(VECTOR_PAIRS, 'vec_id', 5)}
SELECT vec_id, neighbour, label, {S.r6('d')} AS distance, rank FROM near""",
    "f10b_knn_vectors": f"WITH {knn_sql(VECTOR_PAIRS, 'vec_id', 2)} SELECT * FROM voted",
    "f10b_knn_vectors_uniform": f"WITH {knn_sql(VECTOR_PAIRS, 'vec_id', 5, 'uniform')} SELECT * FROM voted",
    "f10b_knn_after_svd": f"WITH {knn_sql(VECTOR_PAIRS, 'vec_id', 2)} SELECT * FROM voted",
    "f11_squared_hinge_weights": f"{HINGE_SQL} {MODEL_ROWS}",
    "f12_complement_nb_weights": f"""WITH {S.tfidf()}, {S.complement_nb(1.0, False)}
SELECT term, lang, {S.r6('theta')} AS theta FROM theta""",
    "f12_complement_nb_weights_norm": f"""WITH {S.tfidf()}, {S.complement_nb(0.1, True)}
SELECT term, lang, {S.r6('theta')} AS theta FROM theta""",
    "f12_complement_nb_predict": f"WITH {S.tfidf()}, {S.complement_nb(1.0, False)} SELECT doc_id, predicted FROM guessed",
    "f12_complement_nb_predict_norm": f"WITH {S.tfidf()}, {S.complement_nb(0.1, True)} SELECT doc_id, predicted FROM guessed",
    "f16_class_weights": f"""WITH t AS (SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
c AS (SELECT lang, count(*) AS nc FROM t GROUP BY 1)
SELECT doc_id, lang, {S.r6('(SELECT count(*) FROM t)::DOUBLE / ((SELECT count(*) FROM c) * nc)')} AS class_weight
FROM t JOIN c USING (lang)""",
}
