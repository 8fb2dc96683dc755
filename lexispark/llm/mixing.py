"""Mixing to target weights with soft memberships, in DataFrame functions alone.

A naive Bayes classifier over hashed words, counted from a labelled table, gives each document a posterior over
domains; it is a literal of bounded size, so a document is classified inside its row and nothing is shuffled by word or
document.  Each document then gets a rate, the number of times it is to be read.  Projected gradient steps fit rates
that are never negative and whose expected tokens by domain match the targets in the least squares sense:

    T = sum over documents of rate * tokens * posterior      rate <- max(0, rate - step * posterior . G^-1 (T - target))

G is the Gram matrix of the posteriors of the documents whose rate is above 0, weighted by tokens, so a step that meets no
bound lands on the target, and one that meets some is scaled for the rest.  Where that does not bring the totals nearer, a
plain gradient step is taken, of a size that grows while it helps.  Each trial is one aggregate over the stored posteriors.  Rates are not stored: they follow from the few
vectors of the steps so far, which any task can apply again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lexispark.session import materialize

BUCKETS = 1 << 13
#: Distinct labelled texts that the classifier is counted from, those of the smallest hashes.
LABELLED_ROWS = 20_000
SMOOTHING = 0.1
#: Steps at most; the gap to the targets is returned, so a fit that stops here can be told.
STEPS = 60
#: Distance of the totals to the targets, relative to all tokens, that is near enough.
ENOUGH = 1e-7
RIDGE = 1e-9
#: The classifier is sent with the plan: 8 MB at most.
MAX_DOMAINS = 128


def _words(text: Column) -> Column:
    """Words between blanks and line breaks, lower-cased."""
    plain = F.replace(F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def classifier(labelled: DataFrame, domains: list[str], text_col: str, domain_col: str) -> tuple[np.ndarray, list[float]]:
    """Log likelihoods (domain, bucket) and log priors, from at most ``LABELLED_ROWS`` distinct texts of the domains."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(domain_col).alias("domain")).where(F.col("domain").isin(domains) & F.col("text").isNotNull())
    rows = rows.withColumn("key", F.xxhash64("domain", "text"))
    # the bound holds however often a text is repeated: keys are distinct, and one text of each is read
    last = rows.select("key").distinct().orderBy("key").limit(LABELLED_ROWS).agg(F.max("key")).first()[0]
    logs, sizes = np.full((len(domains), BUCKETS), SMOOTHING), np.ones(len(domains))
    if last is not None:
        rows = rows.where(F.col("key") <= last).groupBy("key").agg(F.first("text").alias("text"), F.first("domain").alias("domain"))
        words = rows.select("domain", F.explode(_words(F.col("text"))).alias("w"))
        place = F.array_position(F.array(*map(F.lit, domains)), F.col("domain"))
        counts = words.groupBy((place - 1).cast("int").alias("domain"), _bucket(F.col("w")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        counts = materialize(counts, "domain-words")
        # no more rows than domains times buckets
        for r in counts.collect():
            logs[r["domain"], r["bucket"]] += r["n"]
        for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect():
            sizes[domains.index(r["domain"])] += r["n"]
    return np.log(logs / logs.sum(1, keepdims=True)), np.log(sizes / sizes.sum()).tolist()


def _literal(values: np.ndarray) -> Column:
    """An array of doubles; as one string, which is parsed once, when the plan is made."""
    return F.split(F.lit(",".join(f"{v:.5f}" for v in values)), ",").cast("array<double>")


def posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], text_col: str, labelled_text: str, domain_col: str) -> DataFrame:
    """``docs(row, text)`` as ``row``, ``tokens`` (words) and ``p`` (posterior of each domain).

    The mean log likelihood of a word counts as often as the root of the number of words, so that long texts don't
    become certain of one domain by their length.
    """
    weights, prior = classifier(labelled, domains, labelled_text, domain_col)
    rows = docs.select("row", F.transform(_words(F.col(text_col)), _bucket).alias("buckets"))

    def total(w: Column) -> Column:
        return F.aggregate("buckets", F.lit(0.0), lambda s, b: s + F.get(w, b))

    sums = [total(_literal(w)).alias(f"s{k}") for k, w in enumerate(weights)]
    rows = rows.select("row", F.size("buckets").cast("double").alias("tokens"), *sums)
    logits = [F.col(f"s{k}") / F.greatest(F.sqrt("tokens"), F.lit(1.0)) + p for k, p in enumerate(prior)]
    rows = rows.select("row", "tokens", F.array(*logits).alias("logits")).withColumn("most", F.array_max("logits"))
    rows = rows.select("row", "tokens", F.transform("logits", lambda x: F.exp(x - F.col("most"))).alias("e"))
    rows = rows.withColumn("total", F.aggregate("e", F.lit(0.0), lambda s, x: s + x))
    return rows.select("row", "tokens", F.transform("e", lambda x: x / F.col("total")).alias("p"))


def _rate(steps: list[list[float]]) -> Column:
    """The rate after these steps, from 1."""
    rate = F.lit(1.0)
    if steps:
        history = F.array(*(F.array(*map(F.lit, s)) for s in steps))
        rate = F.aggregate(history, rate, lambda r, s: F.greatest(F.lit(0.0), r - F.aggregate(F.zip_with("p", s, lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)))
    return rate


def fit_rates(stored: DataFrame, targets: list[float] | None, shares: list[float], steps: int = STEPS) -> tuple[list[list[float]], float]:
    """Vectors of the steps over ``stored(tokens, p)``, and how far the totals stay from the targets, relative to the
    sum of the targets.

    ``targets`` are tokens by domain.  Without them the total is what makes the domain that has most tokens for its share
    keep them all, so that the others are repeated and none is thinned.
    """
    k = len(shares)
    pairs = [(a, b) for a in range(k) for b in range(a, k)]

    def totals(history: list[list[float]]) -> tuple[np.ndarray, np.ndarray, float]:
        """Tokens by domain at the rates, the Gram matrix of the rows above 0, and all tokens at a rate of 1."""
        rated = stored.withColumn("rate", _rate(history))
        mass = F.col("tokens") * F.when(F.col("rate") > 0, 1.0).otherwise(0.0)
        sums = [F.sum(F.col("tokens") * F.col("rate") * F.col("p")[a]).alias(f"t{a}") for a in range(k)]
        sums += [F.sum(mass * F.col("p")[a] * F.col("p")[b]).alias(f"g{a}_{b}") for a, b in pairs]
        row = rated.agg(F.sum("tokens").alias("all"), *sums).first()
        gram = np.array([[row[f"g{min(a, b)}_{max(a, b)}"] or 0.0 for b in range(k)] for a in range(k)])
        return np.array([row[f"t{a}"] or 0.0 for a in range(k)]), gram, row["all"] or 0.0

    total, gram, everything = totals([])
    if not everything:
        return [], 0.0
    if targets is None:
        budget = max(t / s for t, s in zip(total, shares) if s > 0)
        aim = budget * np.array(shares)
    else:
        aim = np.array(targets, dtype=float)
    history: list[list[float]] = []
    every = gram / everything
    off = (total - aim) / everything
    size = 1.0
    for _ in range(steps):
        if np.abs(off).sum() <= ENOUGH:
            break
        scaled = np.linalg.pinv(gram / everything + RIDGE * np.eye(k), hermitian=True) @ off
        plain = size * off / np.linalg.eigvalsh(every).max()
        # the scaled step is far better or, where bounds are met, no descent at all; the plain one of size 1 is always one
        for move, enough in ((scaled, 0.9), (plain, 1 - 1e-7), (plain / size, 1 - 1e-7)):
            trial = [*history, [float(x) for x in move]]
            total, after, _ = totals(trial)
            now = (total - aim) / everything
            if np.linalg.norm(now) <= np.linalg.norm(off) * enough:
                size = size * 2 if move is plain else 1.0 if move is not scaled else size
                history, gram, off = trial, after, now
                break
        else:
            break
    return history, float(np.abs(off).sum() * everything / max(aim.sum(), 1.0))


def soft_mix(
    docs: DataFrame, labelled: DataFrame, shares: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
    labelled_text: str = "text", domain_col: str = "domain", tokens: float | None = None, keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``domain`` (the likeliest), ``posterior`` (by domain), ``n_tokens`` (words), ``rate``, ``copies``
    and ``target_gap``.

    ``shares`` are the target shares of the domains, in any positive scale; ``tokens`` the expected total (None: see
    ``fit_rates``); ``keep`` the columns of ``docs`` that are returned (None: all).  ``copies`` is the rate rounded to one of
    its neighbours by a hash of the row, so that its mean is the rate.  ``target_gap`` is the same in all rows: the sum
    of the distances of the expected totals to their targets, by the sum of the targets; above 0 the targets can't be met
    with rates from 0 up, or not within ``STEPS``.  The rate is the decision: no row is left out, it may be 0.

    Null and empty texts have no tokens and the prior as posterior; equal posteriors go to the domain that sorts first;
    repeated rows get equal rates; without labelled rows all posteriors are equal.  Columns of ``docs`` with the names
    above are replaced; an empty table gives no rows.
    """
    if not shares or len(shares) > MAX_DOMAINS or min(shares.values()) < 0 or not sum(shares.values()):
        raise ValueError(f"1 to {MAX_DOMAINS} shares are needed, none below 0 and not all 0")
    domains = sorted(shares)
    part = [shares[d] / sum(shares.values()) for d in domains]
    new = ("domain", "posterior", "n_tokens", "rate", "copies", "target_gap")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    chance = F.pmod(F.xxhash64(F.lit(3), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = docs.select(F.struct(chance.alias("chance"), F.struct(*(F.col(f"`{c}`") for c in kept)).alias("old")).alias("row"), F.col(f"`{text_col}`").alias("text"))
    stored = materialize(posteriors(rows, labelled, domains, "text", labelled_text, domain_col), "posteriors")
    history, gap = fit_rates(stored, None if tokens is None else [tokens * s for s in part], part)
    rated = stored.withColumn("rate", _rate(history))
    names = F.array(*map(F.lit, domains))
    likeliest = F.element_at(names, F.array_position("p", F.array_max("p")).cast("int"))
    spare = F.col("rate") - F.floor("rate")
    copies = (F.floor("rate") + F.when(F.col("row.chance") < spare, 1).otherwise(0)).cast("long")
    found = rated.select(
        *(F.col(f"row.old.`{c}`").alias(c) for c in kept), likeliest.alias("domain"), F.map_from_arrays(names, "p").alias("posterior"),
        F.col("tokens").cast("long").alias("n_tokens"), "rate", copies.alias("copies"), F.lit(gap).alias("target_gap"),
    )
    return found
