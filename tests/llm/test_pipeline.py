"""The pipeline's stages on planted cases, end to end."""

import inspect

import pytest

import corpus_pipeline
from lakeloom.llm import queries
from tests.llm import cases


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean and toxic documents, copies, and a passage that two share."""
    import random

    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu") for b in ("ra", "se", "ti", "vo", "zu", "dal")]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    shared = prose(70)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 1
        text = prose(50) + (" you vilefool" if toxic else "") + " " + prose(30)
        rows.append((i, text, "en", f"src{i % 3}", len(text)))
        labels.append((i, 1, int(toxic)))
    rows += [(500, rows[0][1], "en", "src0", 0), (501, rows[0][1], "fr", "src1", 0),
             (502, prose(40) + " " + shared, "en", "src2", 0), (503, prose(45) + " " + shared, "en", "src2", 0),
             (504, None, None, None, None), (505, "", None, "src9", None)]
    path = str(tmp_path_factory.mktemp("planted"))
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, shared


def test_stages(spark, planted, tmp_path):
    path, rows, shared = planted
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, path).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = {k: {r.doc_id for r in v} for k, v in kept.items()}
    assert not any(i % 4 == 1 and i < 400 for i in ids["toxicity"])
    assert len(kept["toxicity"]) == len(rows) - 100  # every clean document stays
    assert 0 in ids["near_duplicates"] and not {500, 501} & ids["near_duplicates"]
    assert len({504, 505} & ids["near_duplicates"]) == 1
    text = {r.doc_id: r.text or "" for r in kept["repeated_passages"]}
    assert shared in text[502] and shared not in text[503] and len(cases.words(text[503])) == 45
    assert {r.doc_id: r.n_chars for r in kept["repeated_passages"]}[503] == len(text[503])
    mixed = {}
    for r in kept["mix_sources"]:
        assert r.text == text[r.doc_id]
        mixed[r.doc_id] = mixed.get(r.doc_id, 0) + 1
    assert max(mixed.values()) <= 2
    total = sum(len(cases.words(t)) for t in text.values())
    assert sum(len(cases.words(text[i])) * n for i, n in mixed.items()) == pytest.approx(1.5 * total, rel=0.01)
    by_doc = {}
    for r in kept["pack_sequences"]:
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.length / r.doc_tokens
    assert by_doc == {i: pytest.approx(n) for i, n in mixed.items()}


def test_run_equals_its_stages_and_takes_an_empty_table(spark, planted, tmp_path):
    path, rows, _ = planted
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_match_their_sql(spark):
    from tests.conftest import SF001
    from tests.oracle_harness import compare

    report = compare(spark, SF001, sorted(queries.ORACLES), verbose=False)
    assert all(v.startswith("OK") for v in report.values()), report


def test_every_operator_is_registered_once():
    names = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(queries.ORACLES) <= set(names)
    for _, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
