"""The stages' decisions against brute force on a small table."""

import corpus_pipeline
from lexispark.llm import decontaminate, pii, simhash, stages

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = stages.without_near_duplicates(spark, docs, small)
    assert kept.columns == COLUMNS
    ids = {r.doc_id for r in kept.collect()}
    first = {}
    for i in sorted(texts):
        first.setdefault(texts[i], i)
    assert ids <= set(first.values())

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}

    sets = {i: shingles(texts[i]) for i in texts}
    for i in set(texts) - ids:
        assert any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in texts if j != i)
    whole = lambda t: " " + " ".join(decontaminate.words_of(t)) + " "
    items = [whole(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    clean = stages.without_benchmark(spark, docs, small)
    left = {r.doc_id for r in clean.collect()}
    held = {i for i, t in texts.items() if any(w in whole(t) for w in items)}
    assert clean.columns == COLUMNS and not left & held
    redacted = stages.without_personal_data(spark, docs, small)
    rows = redacted.collect()
    assert redacted.columns == COLUMNS and len(rows) == len(texts) and all(r.n_chars == len(r.text) for r in rows)
    assert pii.find_spans(redacted, kinds=pii.BASE).where("size(spans) > 0").count() == 0


def test_run_keeps_each_document_once(spark, small):
    rows = corpus_pipeline.run(spark, small).collect()
    assert len({r.doc_id for r in rows}) == len(rows) > 0 and all(r.rate > 0.5 for r in rows)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "mixing"]


def test_near_copies_under_a_repeated_id(spark):
    text = lambda c: " ".join(f"{c}{k}" for k in range(200))
    near = text("a").replace("a100", "changed")
    rows = [(1, text("a")), (5, near), (5, text("b")), (6, text("c")), (6, text("d")), (7, text("e")), (7, text("e").replace("e9 ", "x ")), (8, text("f")), (8, text("f")), (None, text("a"))]
    kept = stages.without_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(found) == len(set(found)) == 7 and sum(i == 7 for i, _ in found) == 1
    assert {(1, text("a")), (5, text("b")), (6, text("c")), (6, text("d")), (8, text("f")), (None, text("a"))} < set(found)


def test_candidates_of_near_copies_grow_with_their_number(spark, monkeypatch):
    made, inner = {}, simhash.materialize

    def counted(df, name, *args):
        made.setdefault(name, []).append(kept := inner(df, name, *args))
        return kept

    monkeypatch.setattr(simhash, "materialize", counted)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join([f"own{i}" if k == 3 * i % 400 else w for k, w in enumerate(words)]) for i in range(130)]
    texts += [" ".join(f"x{i}y{k}" for k in range(50)) for i in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.id: r.component for r in simhash.similar_documents(docs, block=8).collect()}
    assert found == {i: 0 if i < 130 else i for i in range(140)}
    # each pair of the 17 blocks of a bucket gave its rows before, 12,782 in all
    assert sum(x.count() for x in made["wide-candidates"]) < 20 * 140
