"""The pipeline against the operators' brute-force versions, stage by stage."""

import public_tokenizers as P

import __spark_entry__ as E
import corpus_pipeline
from encore.llm import language_id, packing, words
from encore.llm.common import stored, table
from tests.llm import brute
from tests.llm.test_tokens import check_packing, pieces_of

SF = "/root/testdata/sf0.001"


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "language ID", "n-gram Jaccard join", "substring dedup", "best-fit packing"]


def test_every_stage_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    names = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-stage")
        out[name] = docs
        if name != "best-fit packing":
            assert docs.columns == names
    first = by_id(table(spark, SF, "documents"))
    good = by_id(out["quality rules"])
    assert set(good) == {i for i, r in first.items() if brute.quality(r.text)[-1]}
    assert good == {i: first[i] for i in good}
    known = by_id(out["language ID"])
    pred = language_id.predict_query(spark, out["quality rules"]).collect()
    assert set(known) == {r.doc_id for r in pred if r.lang_pred != "und" and r.score >= language_id.MIN_SCORE}
    assert len(known) >= 0.95 * len(good)
    rows = [(i, r.text) for i, r in sorted(known.items())]
    single = by_id(out["n-gram Jaccard join"])
    assert set(single) == {i for i, _, c in brute.jaccard(rows) if i == c}
    rows = [(i, r.text) for i, r in sorted(single.items())]
    expect = {}
    for (i, t), (_, n, gone, _) in zip(rows, brute.dedup(rows)):
        if gone == 0:
            expect[i] = t
        elif gone < n:
            expect[i] = None                     # rewritten
    final = by_id(out["substring dedup"])
    assert set(final) == set(expect)
    digest = {i: d for (i, _), (_, _, _, d) in zip(rows, brute.dedup(rows))}
    import hashlib
    for i, t in expect.items():
        if t is not None:
            assert final[i] == single[i]
        else:
            assert hashlib.sha256(final[i].text.encode()).hexdigest() == digest[i]
            assert final[i].n_chars == len(final[i].text)
    packed = [tuple(r) for r in out["best-fit packing"].select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    pieces = pieces_of([(i, r.text) for i, r in final.items()])
    used = check_packing(packed, pieces)
    assert used <= -(-sum(p[3] for p in pieces) // 1024) + 3


def test_run_is_registered(spark):
    assert E.queries()["pipeline"](spark, SF).count() > 0
    assert P.path("byte_bpe_50k.json")


def test_stages_accept_edge_rows(spark):
    docs = brute.edge_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        assert stage(spark, docs, SF).count() > 0


def test_queries_have_oracles_where_sql_can_say_it(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    sql = E.oracle_sql()
    for name in ("op5_quality_rules", "op6_substring_dedup", "op8_jaccard_join", "op10_metric_range_join"):
        got = E.queries()[name](spark, SF).toPandas()
        expect = con.execute(sql[name]).df()
        cols = sorted(expect.columns)
        assert cols == sorted(got.columns)
        key = "vec_id" if "vec_id" in cols else "doc_id"
        a, b = (x[cols].sort_values(key).astype(str).reset_index(drop=True) for x in (got, expect))
        assert a.equals(b)


def test_every_stage_hands_small_batches_to_its_workers(spark):
    """Also when a stage is called by itself, without ``run``."""
    key, size = corpus_pipeline.BATCH
    before = spark.conf.get(key)
    docs = brute.edge_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:2] + corpus_pipeline.STAGES[-1:]:
        spark.conf.set(key, before)
        stage(spark, docs, "")
        assert spark.conf.get(key) == size
    spark.conf.set(key, before)


def test_worker_tables_stay_small():
    """What a worker keeps and holds follows the text that it handles at once."""
    assert words.CHUNK_BYTES < 1 << 19 and packing.CHUNK_BYTES <= 1 << 20
