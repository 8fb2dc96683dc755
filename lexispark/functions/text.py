"""Text cleaning and tokenising as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# The patterns below define the cleaning result.  ``WS`` spells out
# Unicode white space, which Java's ``\s`` alone does not cover.
WS = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
MATH = r"(?s)\$.*?\$|\\\[.*?\\\]|\\\(.*?\\\)"
COMMAND = r"\\(?:begin|end)\{[^{}]*\}|\\[a-zA-Z]+\*?(?:\[[^\]]*\])?(?:\{[^{}]*\})*+"
URL = rf"https?://[^{WS}]+|www\.[^{WS}]+"
CITATION = rf"\[[0-9,{WS}]+\]"
KEEP_HYPHEN = r"[^a-z0-9\-_ ]"
KEEP_ALNUM = r"[^a-z0-9 ]"
KEPT_RUN = r"[a-z0-9_-]+"
ALNUM_RUN = r"[a-z0-9]+"
# A kept run without hyphens and underscores at its ends.
WORD = r"[a-z0-9](?:[a-z0-9_-]*[a-z0-9])?"

# Patterns of the preset that keeps the text inside braces.
# ``(?d)`` makes ``.`` stop at a newline only.
INLINE_MATH = r"(?d)\$.*?\$"
DISPLAY_MATH = r"(?s)\\\[.*?\\\]"
BRACED_COMMAND = r"(?d)\\[a-zA-Z]+\{(.*?)\}"
BARE_COMMAND = r"\\[a-zA-Z]+"
LOOSE_URL = rf"http[^{WS}]+|www[^{WS}]+"
LOOSE_CITATION = r"\[[0-9, ]+\]"

# Words of two or more word characters.
TOKEN_PATTERN = r"\b\w\w+\b"

# English stop words.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
    he him his himself she she's her hers herself it it's its itself they them their theirs themselves
    what which who whom this that that'll these those am is are was were be been being have has had having
    do does did doing a an the and but if or because as until while of at by for with about against between
    into through during before after above below to from up down in out on off over under again further
    then once here there when where why how all any both each few more most other some such no nor not only
    own same so than too very s t can will just don don't should should've now d ll m o re ve y
    ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't
    isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't
    wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)


def lowered(text: Column) -> Column:
    """Missing text counts as empty."""
    return F.lower(F.coalesce(text, F.lit("")))


def only_charset(text: Column, preserve_hyphen_underscore: bool = True) -> Column:
    return F.regexp_replace(text, KEEP_HYPHEN if preserve_hyphen_underscore else KEEP_ALNUM, " ")


def _runs(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _words(text: Column) -> Column:
    """Runs without white space.  The rarer spaces are translated first, since ``\\S`` alone is much faster
    than a negated class of all of them."""
    return _runs(F.translate(text, SPACES, " " * len(SPACES)), r"\S+")


def collapsed(text: Column) -> Column:
    """White space trimmed at the ends and otherwise one space."""
    return F.array_join(_words(text), " ")


def keep_charset(text: Column, preserve_hyphen_underscore: bool = True) -> Column:
    """:func:`only_charset` with spaces collapsed: the runs of kept characters, joined by a space.

    Picking the runs is several times faster than replacing everything between them.
    """
    return F.array_join(_runs(text, KEPT_RUN if preserve_hyphen_underscore else ALNUM_RUN), " ")


def without_math(text: Column) -> Column:
    return F.regexp_replace(text, MATH, " ")


def without_commands(text: Column) -> Column:
    return F.regexp_replace(text, COMMAND, " ")


def without_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, " ")


def without_citations(text: Column) -> Column:
    return F.regexp_replace(text, CITATION, " ")


def plain(text: Column) -> Column:
    """Lowercase text without math, LaTeX commands, URLs and numeric citations."""
    return without_citations(without_urls(without_commands(without_math(lowered(text)))))


def cleaned(text: Column, preserve_hyphen_underscore: bool = True) -> Column:
    """:func:`plain` text without symbols."""
    return keep_charset(plain(text), preserve_hyphen_underscore)


def cleaned_keeping_braces(text: Column) -> Column:
    """Like :func:`cleaned`, but ``\\textbf{x}`` leaves ``x`` and removals leave no space."""
    out = lowered(text)
    for pattern, replacement in (
        (INLINE_MATH, ""),
        (DISPLAY_MATH, ""),
        (BRACED_COMMAND, "$1"),
        (BARE_COMMAND, ""),
        (LOOSE_URL, ""),
        (LOOSE_CITATION, ""),
    ):
        out = F.regexp_replace(out, pattern, replacement)
    return keep_charset(out)


def word_tokens(plain_text: Column, preserve_hyphen_underscore: bool = True) -> Column:
    """White-space tokens of the cleaned text without hyphens and underscores at their ends.

    The other symbols separate tokens just as spaces do, so the tokens are taken from the plain text
    (or the cleaned one) in one step.
    """
    return _runs(plain_text, WORD if preserve_hyphen_underscore else ALNUM_RUN)


def without(tokens: Column, words: Iterable[str]) -> Column:
    """Drop the listed tokens (a hash lookup per token), keep order and repeats."""
    words = sorted(set(words))
    return F.filter(tokens, lambda t: ~t.isin(words)) if words else tokens


def longer_than_one(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: F.length(t) > 1)


def joined(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def vectorizer_tokens(text: Column, stop_words: Iterable[str] = (), pattern: str = TOKEN_PATTERN) -> Column:
    """Tokens as the vectoriser sees them: pattern matches of the lowercase text."""
    return without(_runs(lowered(text), pattern), stop_words)


def ngrams(tokens: Column, n_max: int) -> Column:
    """All runs of one up to ``n_max`` tokens, joined by a space."""
    size = F.size(tokens)
    out = grams = tokens
    for n in range(2, n_max + 1):
        runs = F.greatest(size - (n - 1), F.lit(0))
        grams = F.zip_with(
            F.slice(grams, F.lit(1), runs),
            F.slice(tokens, F.lit(n), runs),
            lambda head, tail: F.concat(head, F.lit(" "), tail),
        )
        out = F.concat(out, grams)
    return out


def word_count(text: Column) -> Column:
    """Number of white-space separated words; empty text has none."""
    return F.size(_words(F.coalesce(text, F.lit("")))).cast("long")
