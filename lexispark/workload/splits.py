"""Hold-out, folds, samples, batches and nested sub-samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark.operators import split as P
from lexispark.workload import sql as S
from lexispark.workload.inputs import KEY, LABEL, SEED, documents, train_documents

BATCH = 64


def _keys(df: DataFrame) -> DataFrame:
    return df.select(KEY, LABEL)


def holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.stratified_holdout(_keys(documents(spark, sf_dir)), KEY, LABEL, 0.2, SEED)


def _folds(k: int):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return P.stratified_folds(_keys(train_documents(spark, sf_dir)), KEY, LABEL, k, SEED)

    return run


def half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.sample_fraction(_keys(train_documents(spark, sf_dir)), KEY, 0.5, SEED)


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _keys(train_documents(spark, sf_dir))
    parts = [P.epoch_batches(keys, KEY, BATCH, SEED, e).withColumn("epoch", F.lit(e)) for e in (0, 1)]
    return parts[0].unionByName(parts[1])


def halving_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = _folds(3)(spark, sf_dir)
    parts = [
        P.nested_subsample(folded, KEY, LABEL, "fold", share, SEED).withColumn("round", F.lit(i))
        for i, share in enumerate((1 / 9, 1 / 3, 1.0))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUERIES = {
    "e1_stratified_holdout": holdout,
    "e2_stratified_folds_3": _folds(3),
    "e2_stratified_folds_5": _folds(5),
    "e3_sample_fraction": half,
    "e4_epoch_batches": batches,
    "e5_nested_subsamples": halving_rows,
}

TRAIN = "train AS (SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))"


def _batch_sql(epoch: int) -> str:
    return f"""SELECT doc_id, lang, ((row_number() OVER (ORDER BY md5('{SEED}|{epoch}|' || doc_id), doc_id) - 1) // {BATCH})::BIGINT AS batch,
  {epoch}::INTEGER AS epoch FROM train"""


SQL = {
    "e1_stratified_holdout": f"""WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1),
t AS (SELECT count(*) AS total, ceil(count(*) * 0.2::DOUBLE)::BIGINT AS want FROM documents),
q AS (SELECT lang, floor(n * want::DOUBLE / total)::BIGINT AS whole, want,
             round(n * want::DOUBLE / total - floor(n * want::DOUBLE / total), 9) AS frac FROM c, t),
quota AS (SELECT lang, whole + CASE WHEN row_number() OVER (ORDER BY frac DESC, lang) <= want - sum(whole) OVER ()
                                   THEN 1 ELSE 0 END AS quota FROM q)
SELECT doc_id, lang, {S.seeded_rank(str(SEED), 'doc_id', 'lang')} <= quota AS is_holdout
FROM documents JOIN quota USING (lang)""",
    "e2_stratified_folds_3": f"WITH {TRAIN}, {S.folds('train', 'doc_id', 'lang', 3)} SELECT * FROM folded",
    "e2_stratified_folds_5": f"WITH {TRAIN}, {S.folds('train', 'doc_id', 'lang', 5)} SELECT * FROM folded",
    "e3_sample_fraction": f"""WITH {TRAIN}
SELECT doc_id, lang FROM train
QUALIFY {S.seeded_rank(str(SEED), 'doc_id')} <= round(0.5::DOUBLE * (SELECT count(*) FROM train))""",
    "e4_epoch_batches": f"WITH {TRAIN} {_batch_sql(0)} UNION ALL {_batch_sql(1)}",
    "e5_nested_subsamples": f"""WITH {TRAIN}, {S.folds('train', 'doc_id', 'lang', 3)},
r AS (SELECT doc_id, lang, fold, {S.seeded_rank(str(SEED), 'doc_id', 'fold, lang')} AS rank,
             count(*) OVER (PARTITION BY fold, lang) AS n FROM folded)
SELECT doc_id, lang, fold, round FROM r
JOIN (VALUES (0, 1::DOUBLE / 9), (1, 1::DOUBLE / 3), (2, 1::DOUBLE)) s(round, share)
  ON rank <= ceil(round(n * share, 9))""",
}
