"""Features of a training and a test table in one pass over both."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lexispark.operators.cleaning import CleaningConfig, preprocess
from lexispark.operators import rows as R
from lexispark.operators.vocabulary import TfidfConfig, fit_vocabulary, sparse_rows, tfidf
from lexispark.session import materialize

IS_TRAIN = "is_train"


@dataclass
class TextFeatures:
    """Tables shared by fitting and scoring, stored once in the shared folder.

    ``docs(key, label, is_train)``, ``counted(key, label, is_train, terms, tf)``,
    ``vocab(term, df, cf, rank, idf)`` and ``rows(key, label, is_train, idx, w)``, one row per document each.
    """

    key: str
    label: str
    cfg: TfidfConfig
    docs: DataFrame
    counted: DataFrame
    vocab: DataFrame
    rows: DataFrame

    @property
    def columns(self) -> tuple[str, str, str]:
        return self.key, self.label, IS_TRAIN

    @property
    def counts(self) -> DataFrame:
        """``(key, label, is_train, term, tf)``."""
        return R.long_counts(self.counted, self.columns)

    @property
    def weights(self) -> DataFrame:
        """``(key, label, is_train, rank, w)``."""
        return R.long_weights(self.rows, self.columns)

    @property
    def n_features(self) -> int:
        if self.cfg.max_features is None:
            raise ValueError("this model needs max_features")
        return self.cfg.max_features

    @property
    def train_weights(self) -> DataFrame:
        return self.weights.where(IS_TRAIN)

    @property
    def test_weights(self) -> DataFrame:
        return self.weights.where(f"not {IS_TRAIN}")

    @property
    def train_docs(self) -> DataFrame:
        return self.docs.where(IS_TRAIN)

    @property
    def test_docs(self) -> DataFrame:
        return self.docs.where(f"not {IS_TRAIN}")

    def train_rows(self) -> DataFrame:
        return self.rows.where(IS_TRAIN).select(self.key, self.label, "idx", "w")

    def test_rows(self) -> DataFrame:
        return self.rows.where(f"not {IS_TRAIN}").select(self.key, self.label, "idx", "w")


def text_features(train: DataFrame, test: DataFrame, key: str, text: str, label: str,
                  cfg: TfidfConfig = TfidfConfig(), cleaning: CleaningConfig | None = None) -> TextFeatures:
    """Fit on ``train``, transform both.  ``test`` may carry the label, for evaluation only.

    With ``cleaning`` the text is cleaned in the stage that counts the terms.  Documents are not shuffled: a vocabulary
    within the broadcast limit is applied inside the row, a larger or unbounded one by joins on the term.
    """
    kind = train.schema[label].dataType
    truth = F.col(label) if label in test.columns else F.lit(None)
    both = train.select(key, text, label, F.lit(True).alias(IS_TRAIN)).unionByName(
        test.select(key, text, truth.cast(kind).alias(label), F.lit(False).alias(IS_TRAIN)))
    return split_features(both, key, text, label, cfg, cleaning)


def split_features(both: DataFrame, key: str, text: str, label: str, cfg: TfidfConfig = TfidfConfig(),
                   cleaning: CleaningConfig | None = None) -> TextFeatures:
    """The same for one table, whose column ``is_train`` says what is fitted on."""
    if cleaning is not None:
        both = preprocess(both, key, text, cleaning, out=text)
    columns = (key, label, IS_TRAIN)
    counted = materialize(R.counted_rows(both, text, cfg, columns), "counted")
    docs = counted.select(*columns)
    train_counts = R.long_counts(counted.where(IS_TRAIN), columns)
    vocab = materialize(fit_vocabulary(docs.where(IS_TRAIN), train_counts, cfg), "vocabulary")
    return TextFeatures(key, label, cfg, docs, counted, vocab, materialize(_rows(counted, docs, vocab, cfg, key, columns), "rows"))


def _rows(counted: DataFrame, docs: DataFrame, vocab: DataFrame, cfg: TfidfConfig, key: str, columns: tuple[str, ...]) -> DataFrame:
    if R.fits_row(cfg):
        return R.weighted_rows(counted, vocab, cfg, columns)
    weights = tfidf(R.long_counts(counted, columns), vocab, key, cfg, (IS_TRAIN,))
    return sparse_rows(weights.select(key, "rank", "w"), docs, key, columns[1:])
