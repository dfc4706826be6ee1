"""The corpus pipeline against brute force, and the registered queries against SQL or brute force."""

import hashlib

import duckdb
import pytest

import corpus_pipeline
import test_decontaminate
import test_quality
import test_simhash
import test_suffix_dedup
from shelfline.llm import bpe, pii, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sources():
    con = duckdb.connect()
    docs = con.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    bench = con.execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    return docs, bench


def test_run_equals_brute_force(spark, sources, vocabulary):
    docs, bench = sources
    kept = {r.doc_id for r in queries.op6_quality_rules(spark, SF).filter("kept").collect()}
    # (the plain version takes texts of up to 1000 words)
    assert not any(test_quality.brute(t)[-1] for d, t in docs if d in kept and len(t.split()) < 1000)
    first = {d: t for d, t in docs if d in kept}
    print_of = {d: test_simhash.fingerprint(t) for d, t in first.items()}
    groups = test_simhash.brute_components(print_of.values())
    best = {}
    for d, f in print_of.items():
        best[groups[f]] = min(best.get(groups[f], d), d)
    second = {d: first[d] for d in best.values()}
    third = {r[0]: second[r[0]] for r in test_decontaminate.brute(list(second.items()), bench) if not r[4]}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(third)
    assert len(rows) == len(third) < len(docs)
    encoder = bpe.TextEncoder(bpe.read_ranks(vocabulary[0]), vocabulary[1])
    for r in rows:
        source = third[r.doc_id]
        found = pii.find(source)
        if not found:
            assert r.text == source
        assert not any(source[a:b] in r.text for a, b, k, _ in found if k in ("EMAIL", "CARD", "SECRET"))
        assert r.n_chars == len(r.text)
        assert list(r.ids) == encoder([r.text])[0].tolist()


def test_stages_return_documents_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.withColumn("extra", docs.doc_id), SF)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_stages_take_odd_rows(spark):
    """Nulls in any column, empty, repeated and very long texts, through every stage."""
    prose = " ".join(f"word{i} and more{i % 7} of it." for i in range(40))
    long = "\n".join(" ".join(f"w{(i * 8 + j) * 7919 % 50_021}" for j in range(8)) + "." for i in range(6000))
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, prose, None, None, None),
            (3, prose, "en", "s", None), (3, prose, "en", "s", 1), (4, long, "en", None, 9), (5, long + " Mail a.b@c.org now.", None, "s", 9),
            (6, "x" * 300_000, "en", "s", 1), (7, prose + " call +1 (212) 555-0123 or 4111111111111111.", "de", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    for name, stage in corpus_pipeline.STAGES[1:]:  # each stage on the rows as they are
        assert stage(spark, docs, SF).count() <= len(rows), name
    kept = corpus_pipeline.quality_rules(spark, docs, SF)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 3, 4, 5, 7]
    single = corpus_pipeline.simhash_dedup(spark, kept, SF).collect()
    assert sorted(len(r.text) for r in single if r.text == prose) == [len(prose)]
    assert {r.doc_id for r in single if r.text == prose} == {3}
    assert corpus_pipeline.decontamination(spark, docs, SF).count() == len(rows)
    safe = corpus_pipeline.pii_surrogates(spark, docs, SF).collect()
    assert len(safe) == len(rows)
    assert not any(p in (r.text or "") for r in safe for p in ("a.b@c.org", "555-0123", "4111111111111111"))
    assert {r.text for r in safe if r.doc_id == 4} == {long}
    coded = corpus_pipeline.bpe_tokens(spark, docs, SF).collect()
    assert len(coded) == len(rows)
    assert all(r.n_tokens == len(r.ids) for r in coded)
    assert all((r.n_tokens == 0) == (not r.text) for r in coded)


def test_op3_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(queries.ORACLE["op3_chat_format"]).fetchall()
    assert sorted(map(tuple, queries.op3_chat_format(spark, SF).collect())) == sorted(want)


def test_op2_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE["op2_decontamination"]).fetchall()
    assert sorted(map(tuple, queries.op2_decontamination(spark, SF).collect())) == sorted(want)


def test_op2_equals_brute_force(spark, sources):
    want = {r[0]: r for r in test_decontaminate.brute(*sources)}
    rows = queries.op2_decontamination(spark, SF).collect()
    assert len(rows) == len(want)
    for r in rows:
        w = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (w[1], w[2], len(w[3]), w[4])
        assert r.items_sha256 == hashlib.sha256(",".join(w[3]).encode()).hexdigest()


def test_op1_equals_brute_force(spark, sources):
    rows = queries.op1_suffix_dedup(spark, SF).collect()
    assert sorted((tuple(r) for r in rows), key=str) == test_suffix_dedup.brute(sources[0], 400)


def test_op10_counts_equal_op5(spark):
    tokens = {r.doc_id: r.n_tokens for r in queries.op5_byte_bpe(spark, SF).collect()}
    assert {r.doc_id: r.n_tokens for r in queries.op10_token_counts(spark, SF).collect()} == tokens


def test_op7_covers_all_documents(spark, sources):
    rows = queries.op7_pii_surrogates(spark, SF).collect()
    texts = dict(sources[0])
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert (r.text == texts[r.doc_id]) == (r.n_entities == 0) == (not pii.find(texts[r.doc_id]))


def test_other_queries_give_a_row_per_input(spark, sources):
    n = len(sources[0])
    assert queries.op8_simhash(spark, SF).count() == n
    assert queries.op9_language_id(spark, SF).filter("score BETWEEN 0 AND 1").count() == n
    assert queries.op4_url_filter(spark, SF).filter("verdict IN ('allow', 'block')").count() == \
        spark.read.parquet(f"{SF}/pages.parquet").count()
