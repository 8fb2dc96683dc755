"""Cleaning as a table operator, and token normalisation through mapping tables."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lexispark.functions import text as T
from lexispark.operators.ranking import spread_join
from lexispark.session import fits_broadcast, materialize

PRESETS = ("full", "regex_only", "keep_latex_text")


@dataclass(frozen=True)
class CleaningConfig:
    """What the cleaner does.

    ``full`` tokenises and drops tokens after the regular expressions;
    ``regex_only`` and ``keep_latex_text`` stop after them.
    """

    preset: str = "full"
    remove_stopwords: bool = True
    remove_single_char_tokens: bool = True
    use_stemming: bool = False
    use_lemmatization: bool = True
    preserve_hyphen_underscore: bool = True
    extra_stopwords: frozenset[str] = frozenset()
    stop_words: tuple[str, ...] = T.ENGLISH_STOP_WORDS

    def __post_init__(self) -> None:
        if self.preset not in PRESETS:
            raise ValueError(f"preset must be one of {PRESETS}")
        if self.use_stemming and self.use_lemmatization:
            raise ValueError("stemming and lemmatisation exclude each other")

    def dropped_words(self) -> tuple[str, ...]:
        return tuple(sorted({*self.stop_words, *self.extra_stopwords})) if self.remove_stopwords else ()

    def fingerprint(self) -> str:
        fields = {k: sorted(v) if isinstance(v, (frozenset, tuple)) else v for k, v in asdict(self).items()}
        return json.dumps({"cleaning_config": fields}, sort_keys=True)


def cleaned_column(col: Column, cfg: CleaningConfig) -> Column:
    if cfg.preset == "keep_latex_text":
        return T.cleaned_keeping_braces(col)
    return T.cleaned(col, cfg.preserve_hyphen_underscore)


def clean_text(df: DataFrame, col: str, cfg: CleaningConfig = CleaningConfig(), out: str = "cleaned") -> DataFrame:
    """Regular-expression cleaning only."""
    return df.withColumn(out, cleaned_column(F.col(col), cfg))


def tokens_column(col: Column, cfg: CleaningConfig) -> Column:
    words = T.word_tokens(T.plain(col), cfg.preserve_hyphen_underscore)
    tokens = T.without(words, cfg.dropped_words())
    return T.longer_than_one(tokens) if cfg.remove_single_char_tokens else tokens


def tokenize(df: DataFrame, col: str, cfg: CleaningConfig = CleaningConfig(), out: str = "tokens") -> DataFrame:
    return df.withColumn(out, tokens_column(F.col(col), cfg))


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Distinct tokens; partial aggregation leaves one row per token and task before the shuffle."""
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def normalize_tokens(df: DataFrame, key: str, tokens: str, mapping: DataFrame, mapping_is_small: bool | None = None
                     ) -> DataFrame:
    """Replace tokens by ``mapping(token, norm)``; others, order and repeats stay.

    A frequent token may make up a large part of all positions.  A dictionary of
    checked size is broadcast; a larger one is joined with the positions of each
    token spread over several tasks.  Documents without a token keep an empty list.
    Give ``key`` and ``tokens`` only where possible: other columns are joined back.
    """
    if mapping_is_small is None:
        mapping_is_small = fits_broadcast(mapping)
    positions = df.select(key, F.posexplode_outer(tokens).alias("_pos", "token"))
    mapping = mapping.select("token", "norm")
    if mapping_is_small:
        mapped = positions.join(F.broadcast(mapping), "token", "left")
    else:
        mapped = spread_join(positions, mapping, ["token"], (key, "_pos"))
    placed = F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.coalesce("norm", "token").alias("t")))
    rebuilt = (
        mapped.groupBy(key).agg(F.sort_array(F.collect_list(placed)).alias("_seq"))
        .select(key, F.col("_seq.t").alias(tokens))
    )
    return rebuilt if set(df.columns) == {key, tokens} else df.drop(tokens).join(rebuilt, key)


def preprocess(df: DataFrame, key: str, col: str, cfg: CleaningConfig = CleaningConfig(use_lemmatization=False),
               lemmas: DataFrame | None = None, out: str = "cleaned") -> DataFrame:
    """The whole cleaner.  ``lemmas(token, norm)`` is the noun dictionary; it is needed when
    lemmatisation is on."""
    if cfg.preset != "full":
        return clean_text(df, col, cfg, out)
    if not cfg.use_stemming and not cfg.use_lemmatization:
        return df.withColumn(out, T.joined(tokens_column(F.col(col), cfg)))
    # cleaned once: the distinct tokens and the positions are both taken from the stored lists
    tokenized = materialize(df.select(key, tokens_column(F.col(col), cfg).alias("_tokens")), "tokens")
    if cfg.use_stemming:
        from lexispark.operators.stemming import stem_mapping

        changed = stem_mapping(token_counts(tokenized, "_tokens")).where("norm <> token")
        normal = normalize_tokens(tokenized, key, "_tokens", changed, mapping_is_small=False)
    else:
        if lemmas is None:
            raise ValueError("lemmatisation needs a dictionary table (token, norm)")
        normal = normalize_tokens(tokenized, key, "_tokens", lemmas)
    return df.drop(out).join(normal.select(key, T.joined(F.col("_tokens")).alias(out)), key)
