import corpus_pipeline
from tests.llm import brute
from tidewright.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "MinHash near-dedup", "benchmark decontamination", "best-fit packing"]


def test_each_filter_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 150")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    exact = corpus_pipeline.exact_stage(spark, docs, SF)
    assert exact.columns == docs.columns
    assert {r.doc_id for r in exact.collect()} == {min(ids) for ids in brute.exact_groups(rows).values()}
    near = corpus_pipeline.near_stage(spark, docs, SF)
    assert {r.doc_id for r in near.collect()} == {c for _, c in brute.near_duplicates(rows, 5).values()}
    clean = {r.doc_id for r in corpus_pipeline.decontamination_stage(spark, docs, SF).collect()}
    items = [" ".join(brute.words(r.text)).lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, t in rows if any(i in " ".join(brute.words(t)).lower() for i in items)}
    assert leaked and not leaked & clean and len(clean) > 0.8 * (len(rows) - len(leaked))


def test_quality_stage_keeps_good_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, SF).collect()}
    good = [r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()]
    assert sum(d in kept for d in good) > 0.9 * len(good)


def test_stages_take_nulls_repeats_clashing_columns_and_nothing(spark):
    rows = [(r.doc_id, r.text, "en", "s", 1, True, "p", 0.5, 1, "x") for r in spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 40").collect()]
    rows += [(None, "no id", None, None, None, False, None, None, None, None), (None, None, None, None, None, None, None, None, None, None), (900, None, None, None, None, None, None, None, None, None), (901, "", None, None, None, None, None, None, None, None), rows[3], rows[3]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, part string, score double, n int, component string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and 0 < out.count() <= len(rows)
        assert stage(spark, docs.limit(0), SF).count() == 0
    same = corpus_pipeline.exact_stage(spark, docs, SF).collect()
    assert sum(r.doc_id is None for r in same) == 2 and sum(r.doc_id == rows[3][0] for r in same) in (0, 3)
    packed = corpus_pipeline.packing_stage(spark, docs, SF)
    assert packed.groupBy().sum("length").first()[0] > 0 and {r.doc_id for r in packed.collect()} == {r[0] for r in rows}
    assert corpus_pipeline.packing_stage(spark, docs.limit(0), SF).count() == 0


def test_run_packs_what_is_left(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and all(0 < r.length <= 2048 for r in out)
    assert len({(r.doc_id, r.piece) for r in out}) == len(out)


def test_queries_and_oracles_have_the_same_names():
    assert set(oracle_sql()) <= set(queries())
    assert sorted(n for n in queries() if n.startswith("op")) == sorted(f"op{n}_{x}" for n, x in enumerate(("substring_dedup", "line_dedup", "quality_classifier", "exact_dedup", "chat_format", "best_fit_packing", "language_id", "near_dedup", "decontamination", "url_filter"), 1))
