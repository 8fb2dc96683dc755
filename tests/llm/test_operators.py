"""The operators against brute force, public libraries and held-out labels, on small tables and odd rows."""

import hashlib
import os
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lexispark.llm import decontaminate, extraction, language, mixing, pii, quality, queries, simhash, stages, tokens, toxicity, vectors

LONG = "word " * 40_000


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, very long and repeated rows, a null id, and extra columns with the operators' own names."""
    rows = [(1, None, "a"), (2, "", "b"), (3, "one two three four", "c"), (3, "one two three four", "c"), (4, LONG, "d"), (5, "!!! 123", "e"), (None, "one two three four", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string")
    for name in ("score", "bits", "spans", "domain", "key", "row"):
        docs = docs.withColumn(name, F.lit("extra"))
    return docs


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def bits_of(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_components(spark, small):
    found = {r.doc_id: r for r in queries.op2_simhash(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    bits = {d.doc_id: bits_of(d.text) for d in docs}
    assert {i: f"{b:016x}" for i, b in bits.items()} == {i: r.fingerprint for i, r in found.items()}
    links = [(a, b) for a in bits for b in bits if a < b and (bits[a] ^ bits[b]).bit_count() <= 3]
    assert components(bits, links) == {i: r.component_id for i, r in found.items()}


def test_ring_links_lose_none_in_a_hot_bucket(spark):
    rng = np.random.default_rng(1)
    near = [0x1234_5678_9ABC_DEF0 ^ int(sum(1 << int(b) for b in rng.choice(20, 2, replace=False))) for _ in range(150)]
    values = {v - (1 << 64) if v >> 63 else v for v in [*near, *map(int, rng.integers(0, 1 << 62, 200))]}
    nodes = spark.createDataFrame([(v,) for v in values], "bits long")
    found = components(values, [(r.a, r.b) for r in simhash.ring_links(nodes, block=16).collect()])
    exact = components(values, [(a, b) for a in values for b in values if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3])
    assert found == exact


def test_similar_documents(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 300)) for _ in range(40)]
    near = [t.replace(t.split()[150], "changed") for t in texts[:20]]
    docs = spark.createDataFrame(list(enumerate(texts + near)), "doc_id long, text string")
    found = {r.id: r.component for r in simhash.similar_documents(docs).collect()}
    assert found == {i: i if i < 40 else i - 40 for i in range(60)}


def test_vectors_by_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 16))
    x = np.concatenate([centres, *(centres + rng.standard_normal((30, 16)) * 0.25 for _ in range(12)), centres[:3]])
    label = np.concatenate([np.arange(30) % 3] * 13 + [np.arange(3)])
    rows = [(int(k), v.tolist(), int(c)) for k, (v, c) in enumerate(zip(x, label))]
    odd_rows = [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [1.0] * 16, None), (1004, [None] * 16, 1), (1005, [], 1)]
    table = spark.createDataFrame(rows + odd_rows, "vec_id long, embedding array<double>, label int")
    found = {r.id: r for r in vectors.near_duplicate_vectors(table, block=8).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    close = (unit @ unit.T >= 0.93) & (label[:, None] == label)
    degree = close.sum(1) - 1
    got = np.array([found[k].n_links for k in range(len(x))])
    assert (got <= degree).all() and got.sum() >= 0.95 * degree.sum() > 500
    exact = components(range(len(x)), [(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(close))) if a < b])
    assert np.mean([found[k].component == exact[k] for k in range(len(x))]) > 0.95
    assert all(found[k].n_links == 0 and found[k].kept and found[k].component == k for k in range(1000, 1006))


def test_token_counts_equal_the_library(spark, small):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    more = ["", None, "a" * 3000, " " * 300, "x<|endoftext|> y", "it's\n\n  we'll \t x", "\x1c\x85é中😀²½ \n z ", "a  \n", "aaab" * 50]
    docs = docs.unionByName(spark.createDataFrame([(-k - 1, t) for k, t in enumerate(more)], "doc_id long, text string"))
    found = {r.id: r for r in tokens.token_counts(docs).collect()}
    for r in docs.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (found[r.doc_id].n_tokens, found[r.doc_id].n_bytes, found[r.doc_id].over_limit) == (n, len((r.text or "").encode()), n > 1024)


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def test_pii_base_spans(spark, small):
    texts = ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8 999.1.1.1 é😀 4111 1111 1111 1111 +1 (314) 555-4198 +12", "1" * 3000, "+" + "1 " * 2000, "x@" + "a." * 500, None, ""]
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-k - 1, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    found = {r.doc_id: r.s for r in pii.find_spans(docs).select("doc_id", pii.joined("spans").alias("s")).collect()}
    for r in docs.collect():
        want = [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in BASE.items() for m in re.finditer(p, r.text or "") if ok(m.group())]
        assert [s for s in found[r.doc_id].split(",") if s.split(":")[0] in BASE] == want


def test_pii_added_spans_and_redaction(spark):
    docs = spark.createDataFrame([(1, "iban DE89 3704 0044 0532 0130 00, or DE88 3704 0044 0532 0130 00"), (2, "call (212) 555-1234 or 4111 1111 1111 1111"), (3, "set (212) 555-1234"), (4, None)], "doc_id long, text string")
    spans = {r.doc_id: [(s.kind, s.text) for s in r.spans] for r in pii.find_spans(docs).collect()}
    assert spans == {1: [("iban", "DE89 3704 0044 0532 0130 00")], 2: [("card", "4111 1111 1111 1111"), ("localphone", "(212) 555-1234")], 3: [], 4: []}
    texts = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert texts[2] == "call [LOCALPHONE] or [CARD]" and texts[4] is None and texts[1].startswith("iban [IBAN], or DE88")


def test_pii_query_digest(spark, small):
    for r in queries.op7_pii(spark, small).collect():
        base = [s for s in r.spans.split(",") if s.split(":")[0] in BASE]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(s.startswith(k + ":") for s in base) for k in BASE]


def test_bm25_pruning_loses_nothing():
    rng = np.random.default_rng(4)
    items = [([f"t{x}" for x in rng.zipf(1.3, 20) % 400], [f"t{x}" for x in rng.zipf(1.3, 8) % 400]) for _ in range(90)]
    index = decontaminate.Index(list(range(90)), items)
    for _ in range(60):
        n = int(rng.integers(1, 5))
        term = rng.integers(0, len(index.term), int(rng.integers(5, 200)))
        half = np.sort(rng.integers(0, n, len(term)))
        last = np.arange(n) == n - 1
        got = {(int(p), int(i)): s for p, i, s in zip(*index.retrieve(term, half, n, last, 0.15))}
        want = {}
        for p in range(n):
            score = np.zeros(90)
            for t in set(term[(half == p) | (half == p + 1)].tolist()):
                score[index.item[index.first[t] : index.first[t + 1]]] += index.impact[index.first[t] : index.first[t + 1]]
            want |= {(p, int(i)): score[i] for i in np.flatnonzero(score >= 0.15 - 1e-9)}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_decontamination_finds_whole_items(spark, small):
    found = {(r.doc_id, r.item_id) for r in queries.op8_decontamination(spark, small).collect()}
    whole = lambda t: " " + " ".join(decontaminate.words_of(t or "")) + " "
    items = [(r.item_id, whole(r.text)) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    docs = [(r.doc_id, whole(r.text)) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert {(d, i) for d, t in docs for i, w in items if w in t} <= found


def test_shards_of_the_benchmark_give_the_same(spark):
    docs = spark.createDataFrame([(1, "x " * 100 + "what is the tallest hill of all these. it is hill nine there now"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "What is the tallest hill of all these? It is hill nine there now."), (8, None), (9, "")], "item_id long, text string")
    for size in (1, 1000):
        assert [(r.id, r.item) for r in decontaminate.contaminated(docs, items, shard_chars=size).collect()] == [(1, 7)]


def test_blocks_of_a_page():
    page = (
        "<html><head><title>T</title><script>var t='</p>';</script></head><body><header><h1>Site</h1></header><nav><ul><li>A</ul></nav>"
        "<div class='ad'>Buy</div><article><h1>Head &amp; tail</h1><p><b>One<br>two&nbsp;x<p>Three &lt;4&gt;<!-- c --><aside>no</aside></article>"
        "<div class='comments'><p>c</div><footer>f</footer>"
    )
    assert [t for role, t in extraction.blocks(page) if role == extraction.MAIN] == ["Head & tail", "One two x", "Three <4>"]


def test_repeated_runs_of_a_host_go(spark):
    frame = "this long line of words stands on every page of the site"
    rows = [(k, f"http://h{k // 3}.example/x{k}", f"<body><div>{frame}</div><div>own words number {k} of this page and nothing else here at all {k}</div>") for k in range(5)]
    rows += [(5, None, None), (6, "http://[bad", "<p>only here"), (5, None, None), (7, "http://h0.example/", "<article><p>" + frame + "</article>")]
    found = extraction.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()
    text = {r.id: r.text for r in found}
    assert len(found) == 9 and text[5] == "" and text[6] == "only here" and text[7] == frame
    assert all(frame not in text[k] and str(k) in text[k] for k in range(5))
    assert all(r.n_chars == len(r.text) for r in found)


def test_language_on_held_out_texts(spark, small):
    found = {r.doc_id: r for r in queries.op1_language(spark, small).collect()}
    docs = [r for r in spark.read.parquet(f"{small}/documents.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(found[r.doc_id].held_out for r in docs)
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in docs]) > 0.95


def test_mixture_of_two_languages():
    logs = np.log(np.full((language.BUCKETS, 3), 1e-6))
    texts = ["aaa bbb ccc", "xxx yyy zzz", "mmm nnn ooo"]
    for k, t in enumerate(texts):
        for grams, _, _ in language.words_of(t):
            logs[grams, k] = np.log(0.1)
    like, text = language.word_likelihoods([(texts[0] + " ") * 30 + texts[1] * 10, "123", texts[2]], logs.astype(np.float32))
    present, share = language.proportions(like, text, 1.0)
    assert present.tolist() == [0, 2] and share[0][2] == 0 and 0.6 < share[0][0] < 0.85 and share[1].tolist() == [0, 0, 1]


def test_quality_prior_and_risk():
    rng = np.random.default_rng(5)
    good, bad = rng.random((3000, quality.FEATURES)) * 0.5, rng.random((3000, quality.FEATURES)) * 0.5 + 0.3
    unlabelled = np.concatenate([good[1500:], bad[:500]])
    scorer = quality.fit(good[:1500], unlabelled)
    assert abs(scorer.prior - 0.75) < 0.06
    assert (scorer.score(good[1500:]) >= 0.5).mean() > 0.95 and (scorer.score(bad[500:]) >= 0.5).mean() < 0.1


def test_network_gradients():
    rng = np.random.default_rng(6)
    network = toxicity.Network.new(1)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    features = toxicity.word_features(["alpha", "beta", "x"])
    index, there = rng.integers(0, 3, (3, toxicity.WINDOW)), np.ones((3, toxicity.WINDOW), dtype=bool)
    there[1, 9:] = False
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([0.3, 0.5, 0.2])
    _, g = network.gradients(features, index, there, y, weight)
    for k, v in network.p.items():
        at = np.unravel_index(np.abs(g[k]).argmax(), v.shape)
        old, losses = v[at], []
        for d in (1e-5, -1e-5):
            v[at] = old + d
            losses.append(network.gradients(features, index, there, y, weight)[0])
        v[at] = old
        assert abs((losses[0] - losses[1]) / 2e-5 - g[k][at]) < 1e-6 + 1e-4 * abs(g[k][at])


def test_toxicity_learns_a_word():
    rng = np.random.default_rng(7)
    clean = [" ".join(f"w{x}" for x in rng.integers(0, 60, 80)) for _ in range(200)]
    toxic = [t.replace(t.split()[40], "vileword", 1) for t in clean[:80]]
    network = toxicity.train(clean[80:180] + toxic[:60], [0] * 100 + [1] * 60)
    score = toxicity.text_scores(clean[180:] + toxic[60:] + [""], toxicity.Words(network))
    assert (score[:20] < 0.5).all() and (score[20:40] >= 0.5).mean() >= 0.9 and score[40] == 0


def test_windows_cover_every_word():
    for n in (1, 31, 32, 33, 100, 1000):
        at, there, _ = toxicity.windows(np.array([n]))
        assert set(at[there].tolist()) == set(range(n))


def test_mixing_meets_its_targets(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labelled = stages.labelled_domains(spark, docs, small)
    rows = mixing.soft_mix(docs, labelled, stages.SHARES).collect()
    total = {d: sum(r.rate * r.n_tokens * r.posterior[d] for r in rows) for d in stages.SHARES}
    assert len(rows) == docs.count() and all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)
    for d, share in stages.SHARES.items():
        assert abs(total[d] / sum(total.values()) - share) < 0.01
    assert np.mean([r.domain == r.lang for r in rows]) > 0.9


def test_odd_rows(spark, odd):
    ids = [1, 2, 3, 3, 4, 5, None]
    sort = lambda found: sorted(found, key=lambda i: (i is None, i))
    assert sort(r.id for r in tokens.token_counts(odd).collect()) == ids
    near = simhash.near_duplicates(odd).collect()
    assert sort(r.id for r in near) == ids and {r.component for r in near if r.id in (3, None)} == {3}
    assert {r.component for r in near if r.id in (1, 2)} == {1}
    wide = {r.id: r.component for r in simhash.similar_documents(odd).collect()}
    assert wide == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, None: None}
    assert sort(r.doc_id for r in pii.find_spans(odd).collect()) == ids
    langs, logs = language.fit(odd.withColumn("lang", F.lit("xx")))
    named = {r.id: r.lang_pred for r in language.identify(odd, langs, logs).collect()}
    assert named == {1: "und", 2: "und", 3: "xx", 4: "xx", 5: "und", None: "xx"}
    scored = toxicity.scores(odd, toxicity.train([], []), carried={"row": F.struct(*odd.columns)}).collect()
    assert sort(r.id for r in scored) == ids and scored[0].row.score == "extra"
    assert sort(r.id for r in quality.scores(odd, quality.fit(np.zeros((0, quality.FEATURES)), np.zeros((0, quality.FEATURES)))).collect()) == ids
    mixed = mixing.soft_mix(odd, odd.select("text", F.lit("a").alias("domain")).limit(0), {"a": 1, "b": 1}).collect()
    assert sort(r.doc_id for r in mixed) == ids and {r.domain for r in mixed} == {"a"}


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    assert not simhash.near_duplicates(none).take(1) and not simhash.similar_documents(none).take(1)
    assert not tokens.token_counts(none).take(1) and not pii.find_spans(none).take(1)
    assert language.fit(none.withColumn("lang", F.lit("x")))[0] == []
    assert not mixing.soft_mix(none, none.select("text", "domain"), {"a": 1}).take(1)
    assert not decontaminate.contaminated(odd, spark.createDataFrame([], "item_id long, text string")).take(1)
    assert not vectors.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).take(1)
    assert not extraction.main_text(spark.createDataFrame([], "page_id long, url string, html string")).take(1)


def test_similar_pairs_in_a_hot_template(spark):
    rng = np.random.default_rng(8)
    passage = [f"s{k}" for k in range(400)]
    own = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    texts = [" ".join(passage + own(72)) for _ in range(900)]
    texts += [" ".join(t.split()[:430] + own(42)) for t in texts[:60]]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    near = [(k, 900 + k) for k in range(60) if len(sets[k] & sets[900 + k]) >= 0.8 * len(sets[k] | sets[900 + k])]
    assert len(near) == 60 and len(sets[0] & sets[1]) < 0.75 * len(sets[0] | sets[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.id: r.component for r in simhash.similar_documents(docs).collect()}
    assert all(found[k] == k for k in range(900)) and all(found[k] in (k, k - 900) for k in range(900, 960))
    assert sum(found[b] == a for a, b in near) >= 57


def test_the_network_is_trained_in_a_task(spark, monkeypatch, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i % 7} kind bad{i % 5}" if i % 3 else f"word{i % 7} kind nice{i % 5}") for i in range(90)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 3 > 0 as int) as toxic")
    right = toxicity.train(*toxicity.training_sample(docs, labels, 0, 5))
    untrained, inner, at = toxicity.train([], []), toxicity.train, tmp_path / "process"
    monkeypatch.setattr(toxicity, "train", lambda *a: at.write_text(str(os.getpid())) and inner(*a))
    found = toxicity.trained(docs, labels, 0, 5)
    assert at.read_text() != str(os.getpid())
    assert found.p.keys() == right.p.keys() and all(np.allclose(found.p[k], right.p[k], atol=1e-4) for k in right.p)
    nothing = toxicity.trained(docs, labels.limit(0), 0, 5)
    assert all((nothing.p[k] == untrained.p[k]).all() for k in right.p)


def test_repeated_lines_count_once(spark):
    rng = np.random.default_rng(9)
    words = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**9, n))
    line, body = words(9) + " ", words(300)
    texts = [line * 30 + words(100), line * 30 + words(100), body, body + (" " + words(5)) * 1, body + " " + "a b c d e " * 60]
    texts += [line * 200 + "one", line * 200 + "two", body.upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.lower().split() for t in texts)]
    exact = components(range(8), [(a, b) for a in range(8) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    assert exact[1] == 1 and exact[4] == 2 and exact[7] == 2
    assert {r.id: r.component for r in simhash.similar_documents(docs).collect()} == exact


def test_a_benchmark_of_repeated_rows(spark):
    rng = np.random.default_rng(10)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 20)) + ". " + " ".join(f"w{x}" for x in rng.integers(0, 10**6, 8)) for _ in range(20)]
    docs = spark.createDataFrame([(k, "and so on " * 20 + t + " and so on") for k, t in enumerate(texts)] + [(99, "and so on " * 50)], "doc_id long, text string").coalesce(1)
    twice = spark.createDataFrame([(100 * c + k, t) for c in (1, 2) for k, t in enumerate(texts)] + [(101, texts[1])], "item_id long, text string")
    found = sorted((r.id, r.item) for r in decontaminate.contaminated(docs, twice).collect())
    assert found == sorted([(k, 100 * c + k) for c in (1, 2) for k in range(20)] + [(1, 101)])


def test_items_of_common_words_only():
    words = [f"c{k}" for k in range(12)]
    items = [([words[(s + k) % 12] for k in range(6)], [words[(s + 6) % 12]]) for s in range(12)]
    index = decontaminate.Index(list(range(12)), items)
    assert index.rare == 0
    assert (0, 3) in {(t, i) for t, i, *_ in decontaminate.matches([" ".join(items[3][0] + items[3][1])], index, 0.5, 0.8)}


def projected_least_squares(mass, p, aim, steps):
    """The totals after plain projected gradient steps."""
    x = p * mass[:, None] ** 0.5 / mass.sum() ** 0.5
    rate, size = np.ones(len(mass)), 1 / np.linalg.norm(x, 2) ** 2
    for _ in range(steps):
        rate = np.maximum(0, rate - size * p @ (((p * mass[:, None]).T @ rate - aim) / mass.sum()))
    return (p * mass[:, None]).T @ rate


@pytest.mark.parametrize("aim, reached", [([0.3, 2.0, 0.4], True), ([1.0, 1.0, 1.0], True), ([0.0, 3.0, 0.0], False)])
def test_rates_that_meet_their_bound(spark, aim, reached):
    rng = np.random.default_rng(6)
    mass = rng.integers(0, 50, 200).astype(float)
    p = rng.dirichlet([0.3, 0.3, 0.3], 200) * 0.9 + 0.1 / 3
    aim = np.array(aim) * mass.sum() / 3
    stored = spark.createDataFrame([(float(m), [float(v) for v in q]) for m, q in zip(mass, p)], "tokens double, p array<double>").coalesce(1)
    history, gap = mixing.fit_rates(stored, aim.tolist(), (aim / aim.sum()).tolist())
    rows = stored.withColumn("rate", mixing._rate(history)).collect()
    total = sum(r.rate * r.tokens * np.array(r.p) for r in rows)
    slow = projected_least_squares(mass, p, aim, 20_000 if reached else mixing.STEPS)
    assert min(r.rate for r in rows) >= 0 and abs(gap - np.abs(total - aim).sum() / aim.sum()) < 1e-6
    assert np.linalg.norm(total - aim) <= np.linalg.norm(slow - aim) * 1.05 + 1e-5 * aim.sum()
    # unequal targets bind: some rates are 0, and yet the totals of the first are met
    assert (gap < 1e-5) == reached and (min(r.rate for r in rows) == 0) == (aim[1] > aim[0])


def test_mixing_keeps_the_callers_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5), (1, "a b", "x", 5), (2, None, "y", 6)], "doc_id long, text string, _key string, rate int").withColumn("row", F.lit(1))
    found = mixing.soft_mix(docs, docs.select("text", F.lit("u").alias("domain")), {"u": 1, "v": 0}, tokens=2.0).collect()
    assert sorted(r._key for r in found) == ["x", "x", "y"] and {r.row for r in found} == {1} and all(isinstance(r.rate, float) for r in found)


def test_classifier_bound_holds_with_repeated_texts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LABELLED_ROWS", 3)
    rows = spark.createDataFrame([("same words", "a")] * 50 + [(f"other{k}", "b") for k in range(20)], "text string, domain string")
    logs, prior = mixing.classifier(rows, ["a", "b"], "text", "domain")
    assert np.allclose(np.exp(logs).sum(1), 1) and 2 < 5 * (np.exp(prior).sum()) < 6


def test_groups_keep_all_chunks(spark):
    from lexispark.llm import common
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1] * 3), pa.array(["x" * 10] * 3)], ["k", "t"])
    whole = common.joined_batches([common.wide_strings(batch), common.wide_strings(batch)])
    assert whole.num_rows == 6 and pa.types.is_large_string(whole.schema.field("t").type)


def test_toxicity_takes_a_carried_text_once(spark, monkeypatch):
    rows = [(1, "a b c"), (2, None), (3, "word " * 300_000), (None, ""), (4, "a ö c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    network = toxicity.Network.new(1)
    plain = {r.id: r.score for r in toxicity.scores(docs, network).collect()}
    once = toxicity.scores(docs, network, carried={"row": F.struct("doc_id", "text")}, text_in=True)
    assert once.columns == ["id", "score", "row"]
    found = once.collect()
    assert {r.id: r.score for r in found} == pytest.approx(plain) and sorted(r.row.text or "" for r in found) == sorted(t or "" for _, t in rows)


def test_toxicity_reads_a_batch_in_slices(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "text_scores", lambda texts, words: (seen.append(len(texts)), np.zeros(len(texts)))[1])
    monkeypatch.setattr(toxicity, "texts_of", lambda column: (seen.append(-len(column)), column.to_pylist())[1])
    run = {}
    monkeypatch.setattr(toxicity, "spread_scan", lambda df: type("Scan", (), {"mapInArrow": lambda self, fn, schema: run.update(fn=fn)})())
    toxicity.scores(spark.createDataFrame([(1, "a")], "doc_id long, text string"), toxicity.Network.new(1))
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(["x" * 600_000] * 8)], ["id", "text"])
    out = list(run["fn"](iter([batch])))
    assert out[0].num_rows == 8 and min(seen) >= -2  # not all texts of the batch at once


def test_toxicity_features_of_many_words_are_made_in_slices():
    words = [f"{k * 2654435761 % 2**40:x}wort" for k in range(5 * toxicity.AT_ONCE // 2)]
    each = [toxicity.word_features([w]) for w in words[:50]]
    some = toxicity.word_features(words[:50])
    assert all(np.array_equal(np.concatenate([e[k] for e in each]), some[k]) for k in range(3))
    assert [len(x) for x in toxicity.word_features([])] == [0, 0, 0]
    tracemalloc.start()
    found = toxicity.word_features(words)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < held + 3000 * toxicity.AT_ONCE
    assert np.array_equal(found[0][-50:], toxicity.word_features(words[-50:])[0])
