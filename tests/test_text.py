"""Cleaning, tokens and stems on hand-made rows."""

import re

import pytest
from pyspark.sql import functions as F

from lexispark.functions import text as T
from lexispark.operators.cleaning import (
    CleaningConfig, clean_text, normalize_tokens, preprocess, token_counts, tokenize,
)
from lexispark.operators.stemming import stem_mapping

PLAIN = CleaningConfig(use_lemmatization=False)
LATEX = CleaningConfig(preset="keep_latex_text", use_lemmatization=False)

CASES = [
    (None, ""),
    ("a $x$ b", "a b"),
    ("a $x\ny$ b", "a b"),
    (r"\cite[p. 3]{a}{b} end", "end"),
    ("HTTP://A.B c", "c"),
    ("[1,\n2] k", "k"),
    ("cost $5 and $6 left", "cost 6 left"),
    (r"a \[x\] b \(y\) c", "a b c"),
    (r"see \textbf{bold} now", "see now"),
    (r"\begin{eq} q \end{eq}", "q"),
    ("go https://a.b/c?d now", "go now"),
    ("www.x.y z", "z"),
    ("go https://a.b c", "go c"),
    ("as in [1, 2] said", "as in said"),
    ("as in [1, 2] said", "as in said"),
    ("real-world snake_case", "real-world snake_case"),
    ("Café déjà-vu", "caf d j -vu"),
    ("a\r\n\tb c", "a b c"),
    ("!!!", ""),
    ("", ""),
]
LATEX_CASES = [
    ("a $x\ny$ b", "a x y b"),
    ("[1,\n2] k", "1 2 k"),
    (r"a \[x\] b \(y\) c", "a b y c"),
    (r"see \textbf{bold} now", "see bold now"),
    (r"\begin{eq} q \end{eq}", "eq q eq"),
    ("see http://a.b/c and www.d e", "see and e"),
    ("a\ry", "a y"),
]


def _apply(spark, texts, cfg):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    return [r.cleaned for r in clean_text(df, "t", cfg).orderBy("id").collect()]


def test_cleaning_cases(spark):
    assert _apply(spark, [c[0] for c in CASES], PLAIN) == [c[1] for c in CASES]


def test_cleaning_keeping_braces(spark):
    assert _apply(spark, [c[0] for c in LATEX_CASES], LATEX) == [c[1] for c in LATEX_CASES]


def test_patterns_agree_with_python_on_documents(spark, small):
    """The same rules applied one after the other by another regular-expression engine."""
    rows = spark.read.parquet(f"{small}/documents.parquet").select(
        "text", T.cleaned(F.col("text")).alias("c"), T.cleaned(F.col("text"), False).alias("d")).collect()
    for row in rows:
        text = row["text"].lower()
        for pattern in (r"(?s)\$.*?\$|\\\[.*?\\\]|\\\(.*?\\\)", r"https?://\S+|www\.\S+", r"\[[0-9,\s]+\]"):
            text = re.sub(pattern, " ", text)
        assert re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\-_ ]", " ", text)).strip() == row["c"]
        assert re.sub(r"\s+", " ", re.sub(r"[^a-z0-9 ]", " ", text)).strip() == row["d"]


def test_many_arguments_do_not_overflow(spark):
    text = "\\cmd" + "{a}" * 50_000 + " end"
    assert _apply(spark, [text], PLAIN) == ["end"]


def test_tokens(spark):
    df = spark.createDataFrame([(0, "-_ab-c_- -- _ the a b cd"), (1, None)], "id long, t string")

    def tokens(**kw):
        cfg = CleaningConfig(use_lemmatization=False, **kw)
        return [r.tokens for r in tokenize(df, "t", cfg).orderBy("id").collect()]

    assert tokens() == [["ab-c", "cd"], []]
    assert tokens(remove_single_char_tokens=False) == [["ab-c", "b", "cd"], []]
    assert tokens(remove_stopwords=False) == [["ab-c", "the", "cd"], []]
    assert tokens(extra_stopwords=frozenset({"cd"})) == [["ab-c"], []]
    assert tokens(remove_stopwords=False, extra_stopwords=frozenset({"cd"})) == [["ab-c", "the", "cd"], []]
    assert tokens(preserve_hyphen_underscore=False, remove_single_char_tokens=False) == [["ab", "c", "b", "cd"], []]


def test_vectorizer_tokens_and_ngrams(spark):
    df = spark.createDataFrame([(0, "real-world snake_case a bc"), (1, "one"), (2, "")], "id long, t string")
    rows = df.select(
        T.vectorizer_tokens(F.col("t")).alias("t"), T.ngrams(T.vectorizer_tokens(F.col("t")), 2).alias("g"),
        T.ngrams(T.vectorizer_tokens(F.col("t")), 3).alias("h")).collect()
    assert rows[0].t == ["real", "world", "snake_case", "bc"]
    assert rows[0].g == rows[0].t + ["real world", "world snake_case", "snake_case bc"]
    assert rows[0].h == rows[0].g + ["real world snake_case", "world snake_case bc"]
    assert rows[1].g == ["one"] and rows[2].g == []


def test_stop_words_go_before_ngrams(spark):
    df = spark.createDataFrame([("state of the art",)], "t string")
    assert df.select(T.ngrams(T.vectorizer_tokens(F.col("t"), ["of", "the"]), 2)).first()[0] == ["state", "art", "state art"]


def test_config_rejects_both_normalisations():
    with pytest.raises(ValueError):
        CleaningConfig(use_stemming=True, use_lemmatization=True)
    with pytest.raises(ValueError):
        CleaningConfig(preset="other")


# Examples of the published algorithm and of its later extensions.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc",
    "hesitanci": "hesit", "digitizer": "digit", "conformabli": "conform", "radicalli": "radic",
    "differentli": "differ", "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam",
    "predication": "predic", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis",
    "hopefulness": "hope", "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit",
    "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal",
    "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv",
    "allowance": "allow", "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop",
    "adjustable": "adjust", "defensible": "defens", "irritant": "irrit", "replacement": "replac",
    "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "homologou": "homolog",
    "communism": "commun", "activate": "activ", "angulariti": "angular", "homologous": "homolog",
    "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "dying": "die", "news": "news", "died": "die", "studied": "studi",
    "enjoy": "enjoy", "is": "is",
}


def test_stems(spark):
    words = spark.createDataFrame([(w,) for w in STEMS], "token string")
    got = {r.token: r.norm for r in stem_mapping(words).collect()}
    assert {w: (got[w], s) for w, s in STEMS.items() if got[w] != s} == {}


def test_normalisation_keeps_order_and_repeats(spark):
    df = spark.createDataFrame([(1, ["cats", "x", "cats", "y"]), (2, [])], "id long, tokens array<string>")
    mapping = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "token string, norm string")
    for small in (True, False, None):
        got = {r.id: r.tokens for r in normalize_tokens(df, "id", "tokens", mapping, small).collect()}
        assert got == {1: ["cat", "x", "cat", "y"], 2: []}


def test_preprocess_variants(spark):
    df = spark.createDataFrame([(1, "The cats were running"), (2, "!!!")], "id long, t string")
    lemmas = spark.createDataFrame([("cats", "cat")], "token string, norm string")

    def run(cfg, lemmas=None):
        return [r.cleaned for r in preprocess(df, "id", "t", cfg, lemmas).orderBy("id").collect()]

    assert run(PLAIN) == ["cats running", ""]
    assert run(CleaningConfig(), lemmas) == ["cat running", ""]
    assert run(CleaningConfig(use_stemming=True, use_lemmatization=False)) == ["cat run", ""]
    assert run(CleaningConfig(preset="regex_only", use_lemmatization=False)) == ["the cats were running", ""]
    with pytest.raises(ValueError):
        run(CleaningConfig())


def test_token_counts(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), ([],)], "tokens array<string>")
    assert {(r.token, r.n) for r in token_counts(df).collect()} == {("a", 2), ("b", 1)}
