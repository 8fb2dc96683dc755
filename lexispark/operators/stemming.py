"""Suffix stripping (Porter 1980, with the common later extensions) on a vocabulary.

The rules run once per distinct token, as regular expressions on a column.
``measure`` of a stem is the number of vowel-consonant sequences in it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lexispark.session import materialize

# Letter classes.  ``y`` is a vowel after a consonant.
C = "[^aeiou][^aeiouy]*"
V = "[aeiouy][aeiou]*"
MEASURE_1_UP = f"^({C})?{V}{C}"
MEASURE_1 = f"^({C})?{V}{C}({V})?$"
MEASURE_2_UP = f"^({C})?{V}{C}{V}{C}"
HAS_VOWEL = f"^({C})?[aeiouy]"
DOUBLE = r"(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$"
SHORT_END = f"^{C}[aeiouy][^aeiouwxy]$|^[aeiou][^aeiou]$"

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Suffixes and replacements, first match wins, if the measure of the stem is over 0.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
# Suffixes dropped if the measure of the stem is over 1.
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
    "iti", "ous", "ive", "ize",
)


def _cut(word: Column, suffix: str) -> Column:
    return F.expr(f"substring(w, 1, length(w) - {len(suffix)})") if suffix else word


def _first_match(word: Column, cases: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda acc, case: F.when(case[0], case[1]) if acc is None else acc.when(*case), cases, None
                  ).otherwise(word)


def _suffix_rules(word: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    cases = []
    for suffix, replacement in rules:
        stem = _cut(word, suffix)
        cases.append((word.endswith(suffix),
                      F.when(stem.rlike(MEASURE_1_UP), F.concat(stem, F.lit(replacement))).otherwise(word)))
    return _first_match(word, cases)


def stem_mapping(vocabulary: DataFrame, token: str = "token") -> DataFrame:
    """``(token, norm)`` for a table of distinct tokens.

    The result is stored: a filter on ``norm`` would otherwise be pushed down through the
    chained rules and repeat each of them many times over.
    """
    w = F.col("w")
    df = vocabulary.select(F.col(token).alias("token"), F.lower(token).alias("w"))

    # plurals
    df = df.withColumn("w", _first_match(w, [
        (w.endswith("ies") & (F.length(w) == 4), F.concat(_cut(w, "ies"), F.lit("ie"))),
        (w.endswith("sses"), F.concat(_cut(w, "sses"), F.lit("ss"))),
        (w.endswith("ies"), F.concat(_cut(w, "ies"), F.lit("i"))),
        (w.endswith("ss"), w),
        (w.endswith("s"), _cut(w, "s")),
    ]))

    # past and progressive forms; "_cut" says that the stem still needs its ending repaired
    bare = F.when(w.endswith("ed"), _cut(w, "ed")).when(w.endswith("ing"), _cut(w, "ing"))
    special = w.endswith("ied") | w.endswith("eed")
    df = df.withColumn("_bare", F.when(~special & bare.rlike(HAS_VOWEL), bare)).withColumn("w", _first_match(w, [
        (w.endswith("ied"), F.concat(_cut(w, "ied"), F.when(F.length(w) == 4, "ie").otherwise("i"))),
        (w.endswith("eed"), F.when(_cut(w, "eed").rlike(MEASURE_1_UP), F.concat(_cut(w, "eed"), F.lit("ee")))
         .otherwise(w)),
    ]))
    s = F.col("_bare")
    df = df.withColumn("w", _first_match(w, [
        (s.isNull(), w),
        (s.rlike("(at|bl|iz)$"), F.concat(s, F.lit("e"))),
        (s.rlike(DOUBLE), F.expr("substring(_bare, 1, length(_bare) - 1)")),
        (s.rlike("(ll|ss|zz)$"), s),
        (s.rlike(MEASURE_1) & s.rlike(SHORT_END), F.concat(s, F.lit("e"))),
        (s.isNotNull(), s),
    ])).drop("_bare")

    # final y after a consonant
    df = df.withColumn("w", F.when(w.rlike("^.+[^aeiou]y$") & ~w.rlike("[^aeiou]yy$"),
                                   F.concat(_cut(w, "y"), F.lit("i"))).otherwise(w))

    # double suffixes; "alli" is reduced first so that the rules see "al"
    df = df.withColumn("w", F.when(w.endswith("alli") & _cut(w, "alli").rlike(MEASURE_1_UP), _cut(w, "li"))
                       .otherwise(w))
    step2 = _suffix_rules(w, STEP_2)
    df = df.withColumn("w", F.when(
        w.endswith("logi"),
        F.when(_cut(w, "ogi").rlike(MEASURE_1_UP), _cut(w, "i")).otherwise(w)).otherwise(step2))
    df = df.withColumn("w", _suffix_rules(w, STEP_3))

    cases = []
    for suffix in STEP_4:
        stem = _cut(w, suffix)
        long_enough = stem.rlike(MEASURE_2_UP)
        if suffix == "ion":
            long_enough = long_enough & stem.rlike("[st]$")
        cases.append((w.endswith(suffix), F.when(long_enough, stem).otherwise(w)))
    df = df.withColumn("w", _first_match(w, cases))

    # final e and double l
    stem = _cut(w, "e")
    df = df.withColumn("w", F.when(
        w.endswith("e") & (stem.rlike(MEASURE_2_UP) | (stem.rlike(MEASURE_1) & ~stem.rlike(SHORT_END))), stem
    ).otherwise(w))
    df = df.withColumn("w", F.when(w.endswith("ll") & _cut(w, "l").rlike(MEASURE_2_UP), _cut(w, "l")).otherwise(w))

    irregular = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])
    lowered = F.lower("token")
    mapping = df.select(
        "token",
        F.when(irregular[lowered].isNotNull(), irregular[lowered])
        .when(F.length("token") <= 2, lowered).otherwise(w).alias("norm"),
    )
    return materialize(mapping, "stems")
