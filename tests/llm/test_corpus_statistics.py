"""Filter audit, spelling variants and language-model scores against brute force, SQL and odd rows."""

import re
import zlib
from collections import Counter
from itertools import permutations
from math import inf, log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.llm import filters, lm, queries, spelling
from lexispark.llm.sql import oracle_sql
from tools.check import compare, connect

LONG = "Word " * 40_000 + "x" * 3_000 + " end"
ODD = [
    (1, None, "s"), (2, "", "s"), (3, "Aa aa é　b #", None), (3, "Aa aa é　b #", None), (2, "Aa aa é　b #", "t"), (None, "Aa aa é　b #", "t"),
    (4, LONG, "s"), (5, LONG, "u"), (6, " ".join(f"w{k}" for k in range(300)), "u"), (7, "x" * 99 + " " + "x" * 99 + " " + "x" * 98 + "y", "u"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, very long and repeated rows, a null id and part, and extra columns with the operators' own names."""
    docs = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    for name in ("id", "part", "failed", "n", "word", "key", "digest", "c0", "score", "lang"):
        docs = docs.withColumn(name, F.lit("extra"))
    return docs


def sql_equal(spark, sf_dir, name):
    df = queries.queries()[name](spark, sf_dir)
    cur = connect(sf_dir).execute(oracle_sql()[name])
    return compare([tuple(r) for r in df.collect()], df.columns, cur.fetchall(), [d[0] for d in cur.description]) == "ok"


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    count = lambda p: len(re.findall(p, text or ""))
    return len(words), len(set(words)), count("[A-Z]"), len(text or ""), count(r"[#$%&*|]")


def audited(rows, labels):
    """All orders, document by document."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1 and i}, {i for i, _, t in labels if t == 1 and i}
    docs = []
    for i, t, part in rows:
        w, d, c, p, s = measured(t)
        fails = {x for x, f in zip("ABCDE", (w < 200, 100 * d < 50 * w, 100 * c > 2 * p, s > 0, i is not None and i > least[t or ""])) if f}
        docs.append((part or "", fails, i in good, i in toxic))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        gone = set()
        for step, x in enumerate(order, 1):
            for part in {d[0] for d in docs}:
                mine = [(k, *d[1:]) for k, d in enumerate(docs) if d[0] == part]
                here = [m for m in mine if x in m[1] and m[0] not in gone]
                left = [m for m in mine if m[0] not in gone and x not in m[1]]
                again = [m for m in mine if x in m[1] and m[0] in gone]
                out[part, order, step] = (len(left), len(here), len(again), sum(m[1] == {x} for m in mine), sum(m[2] for m in here), sum(m[3] for m in here))
                shapley[part, x] += len(here)
            gone |= {k for k, d in enumerate(docs) if x in d[1]}
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_filter_audit_by_brute_force(spark, odd):
    labels = [(3, 1, 0), (3, 0, 1), (4, 1, None), (6, 0, 1), (None, 1, 1), (99, 1, 1)]
    found = filters.interaction_audit(odd, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found}
    assert len(found) == len(got) == 4 * 600 and got == audited(ODD, labels)


def test_filter_audit_equals_sql(spark, small):
    assert sql_equal(spark, small, "op11_filter_audit")


def test_measures_of_any_bytes(spark):
    rng = np.random.default_rng(4)
    alphabet = ["a", "B", "é", "中", "😀", " ", "\n", "\x1c", "　", "#", "|", "\x00"]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 60))) for _ in range(400)] + ["", " ", "ab " * 5000, "a" * 70 + " " + "a" * 70 + " b"]
    assert filters.measure_texts([t.encode() for t in texts]).tolist() == [list(measured(t)) for t in texts]


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(filters, "_hashes", lambda data, windows, start, size: np.zeros(len(start), dtype=np.uint64))
    texts = ["one two one three", "two two", "a b c d e f g h a"]
    assert filters.measure_texts([t.encode() for t in texts])[:, 1].tolist() == [3, 1, 8]


def test_audit_of_other_filters(spark):
    rows = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 0, 1)], "part string, failed int, n long, n_good long, n_toxic long")
    found = {(r.filter_order, r.step): r for r in filters.audit(rows, "XY").collect()}
    assert len(found) == 4 and found["YX", 1].removed == 2 and found["YX", 2].redundant == 2 and found["XY", 1].shapley == 2
    with pytest.raises(ValueError):
        filters.audit(rows, "ABCDEFG")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filters.interaction_audit(empty(spark), labels).count() == 0
    assert spelling.spelling_variants(empty(spark)).count() == 0


def variants(rows):
    """Spelling variants, pair by pair."""
    n = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
        return a != b and len(b) - len(a) < 2 and a[k + (len(a) == len(b)) :] == b[k + 1 :]

    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    form, n_near = {}, {}
    for w in n:
        close = [v for k in (-1, 0, 1) for v in by_size.get(len(w) + k, []) if near(w, v)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        n_near[w], form[w] = len(close), best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, n[w], n_near[w], form[w], n.get(form[w]), root(w)) for w in n}


def made_up(rng, size=1500):
    stems = ["".join(rng.choice(list("abcdeéü"), rng.integers(4, 13))) for _ in range(60)]
    rows = []
    for k in range(size):
        w = stems[int(rng.zipf(1.5)) % 60]
        at = int(rng.integers(0, len(w)))
        w = (w, w, w[:at] + w[at + 1 :], w[:at] + "x" + w[at:], w[:at] + "y" + w[at + 1 :])[int(rng.integers(0, 5))]
        rows.append((k % 300, " ".join([w.upper() if k % 7 == 0 and w.isascii() else w] * int(rng.integers(1, 4)))))
    return rows


@pytest.mark.parametrize("block", [spelling.BLOCK, 8])
def test_spelling_variants_by_brute_force(spark, block):
    rows = made_up(np.random.default_rng(5)) + [(r[0], r[1]) for r in ODD] + [(1, "×÷ABCD Ābcdefg ßßßßß"), (2, "z" * 5000), (3, "z" * 5000), (4, ("z" * 4999 + " ") * 9)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2))
    found = [tuple(r) for r in spelling.spelling_variants(docs, block=block).collect()]
    exact = variants(rows)
    assert len(found) == len(set(found)) == len(exact) > 200 and set(found) == exact
    assert sum(r[3] is not None for r in exact) > 50 and any(r[3] != r[5] for r in exact if r[3])


def test_spelling_variants_equal_sql(spark, small):
    assert sql_equal(spark, small, "op12_spelling_variants")


def test_sliced_index_finds_single_errors():
    words = [w.encode("latin-1") for w in sorted({"abcde", "abcd", "abcdef", "xbcde", "abxde", "abcdx", "bcde", "aabcde", "abcdee", "abdce", "zzzzz", "é" * 5, "é" * 6})]
    found = {(words[q].decode("latin-1"), words[w].decode("latin-1")) for q, w in zip(*spelling.SlicedIndex(words).near())}
    assert {b for a, b in found if a == "abcde"} == {"abcd", "abcdef", "xbcde", "abxde", "abcdx", "bcde", "aabcde", "abcdee"}
    assert all((b, a) in found for a, b in found) and ("é" * 5, "é" * 6) in found and not any("zzzzz" in p for p in found)


@pytest.fixture(scope="module")
def vocabulary():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return lm.Vocabulary.load(public_tokenizers.path(queries.LM_VOCABULARY))


def brute(word, vocabulary, logs):
    """Sum over all segmentations, and the expected pieces, by listing them."""
    text, usable = lm.MARK + word, vocabulary.usable()

    def paths(at):
        if at == len(text):
            yield []
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in usable:
                yield from ([usable[text[at:end]], *p] for p in paths(end))
            elif end == at + 1:
                yield from ([*vocabulary.byte_ids[list(text[at].encode())], *p] for p in paths(end))

    weights = [(np.exp(logs[p].sum()), p) for p in paths(0)]
    total, expected = sum(w for w, _ in weights), np.zeros(len(logs))
    for w, p in weights:
        np.add.at(expected, p, w / total)
    return np.log(total), expected


def test_lattice_by_brute_force(vocabulary):
    words = ["the", "running", "x", "naïve", "中文字", "q\U0001f600z", "zzzzzz", "▁a"]
    counts = np.arange(1.0, len(words) + 1)
    total, expected = lm.Lattice(vocabulary, vocabulary.logs).run(words, counts)
    exact = [brute(w, vocabulary, vocabulary.logs) for w in words]
    assert np.allclose(total, [t for t, _ in exact], rtol=1e-12) and np.isclose(np.exp(vocabulary.logs).sum(), 1)
    assert np.allclose(expected, sum(c * e for c, (_, e) in zip(counts, exact)), atol=1e-9)


def test_scores_by_brute_force(spark, small, vocabulary):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    c = Counter(w for i in docs if not held[i] for w in [*words[i], None])
    n, v = sum(c.values()), len(c)
    model = lm.train(spark.createDataFrame([(t,) for i, t in docs.items() if not held[i]], "text string"), vocabulary)
    assert (model.tokens, model.distinct, model.documents) == (n, v, c[None]) and np.isclose(np.exp(model.logs).sum(), 1)
    lattice, gains = lm.Lattice(vocabulary, model.logs), []
    for r in queries.op13_lm_scoring(spark, small).collect():
        mine = [*words[r.doc_id], None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(mine), sum(c[w] > 0 for w in mine), n)
        assert abs(r.base_score - sum(log10((c[w] + 1) / (n + v + 1)) for w in mine)) < 1e-6 * len(mine)
        score = sum(lattice.run(mine[:-1])[0]) if mine[:-1] else 0.0
        assert abs(r.score - (score + model.logs[vocabulary.end]) / np.log(10)) < 1e-6 * len(mine)
        plain = sum(lm.Lattice(vocabulary, vocabulary.logs).run(mine[:-1])[0]) / np.log(10) if held[r.doc_id] and mine[:-1] else inf
        gains += [r.score - plain] if plain < inf else []
    # training helps on documents that were not learnt from
    assert len(gains) > 10 and np.mean(gains) > 0


def test_scores_of_odd_rows(spark, odd, vocabulary):
    for train in (odd, odd.limit(0)):
        model = lm.train(train, vocabulary, hot_part=0.2)
        found = lm.scores(odd, model, {"doc_id": F.col("doc_id"), "score_of": F.col("score")}).collect()
        assert len(found) == len(ODD) and {r.score_of for r in found} == {"extra"} and all(np.isfinite([r.score, r.base_score]).all() for r in found)
        assert sorted(r.n_tokens for r in found) == sorted(measured(t)[0] + 1 for _, t, _ in ODD)
        same = [r[1:] for r in found if r.doc_id == 3]
        assert len(same) == 2 and same[0] == same[1]
    assert all(r.base_score == 0 and r.n_known == 0 for r in found)
    assert lm.scores(odd.limit(0), model, {"doc_id": F.col("doc_id")}).count() == 0
