"""Readers, cache and sinks."""

import pytest

from lexispark.operators.cleaning import CleaningConfig
from lexispark.session import materialize, new_path, shared_dir
from lexispark.sources import cache, sinks, tables


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [(1, 'The "big" cats,\nand dogs\t', 0), (2, "plain", 1), (3, "  ", 0)], "id long, abstract string, label_id long")


def test_quoted_text_survives(spark, raw):
    root = new_path(spark, "t")
    sinks.write_delimited(raw, f"{root}/train.csv", "\t")
    sinks.write_delimited(raw.select("id", "abstract"), f"{root}/test.csv", "\t")
    train, test = tables.load_train_test(spark, root)
    assert sorted(map(tuple, train.collect())) == sorted(map(tuple, raw.collect()))
    assert train.dtypes == raw.dtypes and test.columns == ["id", "abstract"]


def test_missing_files_and_columns(spark, raw):
    root = new_path(spark, "t")
    with pytest.raises(FileNotFoundError):
        tables.load_train_test(spark, root)
    assert tables.read_optional(spark, f"{root}/none") is None
    sinks.write_delimited(raw.drop("label_id"), f"{root}/train.csv", "\t")
    with pytest.raises(ValueError, match="label_id"):
        tables.read_delimited(spark, f"{root}/train.csv", tables.TRAIN_SCHEMA)


def test_taxonomy_ignores_other_columns(spark):
    path = new_path(spark, "x")
    wide = spark.createDataFrame([("note", "math", 3)], "remark string, category string, label_id long")
    sinks.write_delimited(wide, path, "\t")
    got = tables.read_taxonomy(spark, path)
    assert got.dtypes == [("label_id", "bigint"), ("category", "string")] and tuple(got.first()) == (3, "math")


def test_cache_follows_configuration(spark, raw):
    path = new_path(spark, "c")
    full = CleaningConfig(use_lemmatization=False)
    regex = CleaningConfig(preset="regex_only", use_lemmatization=False)

    def texts(df, cfg, **kw):
        return [r.cleaned_abstract for r in cache.cached_cleaning(df, path, "id", "abstract", ("label_id",), cfg, **kw)
                .orderBy("id").collect()]

    assert texts(raw, full) == ["big cats dogs", "plain", ""]
    changed = raw.withColumn("abstract", raw.abstract.substr(1, 0))
    assert texts(changed, full) == ["big cats dogs", "plain", ""]          # same configuration: cache
    assert texts(changed, full, use_cache=False) == ["", "", ""]
    assert texts(raw, regex) == ["the big cats and dogs", "plain", ""]     # changed: made anew
    assert texts(changed, regex, refresh=True) == ["", "", ""]
    assert full.fingerprint() != CleaningConfig(use_lemmatization=False, extra_stopwords=frozenset("x")).fingerprint()


def test_legacy_formats(spark):
    root = new_path(spark, "l")
    cleaned = spark.createDataFrame([(1, 0, "a b"), (2, 1, None)], "id long, label_id long, cleaned_abstract string")
    for name, sep in (("tab", "\t"), ("comma", ",")):
        sinks.write_delimited(cleaned, f"{root}/{name}", sep)
        got = cache.read_legacy_cache(spark, f"{root}/{name}")
        assert sorted(map(tuple, got.collect())) == [(1, 0, "a b"), (2, 1, "")]


def test_prediction_contract(spark):
    test = spark.createDataFrame([(1,), (2,)], "id long")
    schema = "id long, label_id long"
    good = spark.createDataFrame([(1, 0), (2, 5)], schema)
    path = new_path(spark, "p")
    sinks.write_predictions(good, test, path)
    assert sorted(map(tuple, tables.read_delimited(spark, path, schema, ",").collect())) == [(1, 0), (2, 5)]
    for rows in ([(1, 0)], [(1, 0), (1, 0), (2, 0)], [(1, 0), (3, 0)]):
        with pytest.raises(ValueError):
            sinks.check_predictions(spark.createDataFrame(rows, schema), test)
    with pytest.raises(ValueError):
        sinks.check_predictions(good.select("label_id", "id"), test)


def test_renamed_column(spark):
    old = spark.createDataFrame([(1,)], "candidate_rank_stage1 int")
    assert tables.reload_results(old).columns == ["candidate_rank_tuning"]
    both = spark.createDataFrame([(1, 2)], "candidate_rank_stage1 int, candidate_rank_tuning int")
    assert tables.reload_results(both).columns == both.columns


def test_result_contract(spark):
    with pytest.raises(ValueError, match="mean_accuracy"):
        sinks.write_results(spark.range(1), new_path(spark, "r"), ("mean_accuracy",))


def test_materialized_table_has_no_lineage(spark):
    df = materialize(spark.range(10).withColumnRenamed("id", "x"), "m")
    assert df.count() == 10 and all(f.startswith(("file:", "/")) for f in df.inputFiles())
    assert shared_dir(spark)


def test_cache_follows_its_input(spark, tmp_path):
    from lexispark.sources.cache import cached_cleaning

    rows = [(1, "one text"), (2, "two texts")]
    first = spark.createDataFrame(rows, "id long, abstract string")
    path = str(tmp_path / "cache")
    assert cached_cleaning(first, path, "id", "abstract").count() == 2
    more = spark.createDataFrame([*rows, (3, "three texts")], "id long, abstract string")
    assert cached_cleaning(more, path, "id", "abstract").count() == 3


def test_single_line_reader(spark, tmp_path):
    from lexispark.sources.tables import read_delimited

    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text('id\tabstract\n1\t"x ""y"""\n')
    found = read_delimited(spark, str(tmp_path), "id long, abstract string", multi_line=False).collect()
    assert [tuple(r) for r in found] == [(1, 'x "y"')] * 2
