"""Registered queries of this subpackage, and the pipeline stage by stage."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.check_oracles import connect, differences
from tests.llm.test_exact_dedup import plain
from tests.llm.test_filters import plain_hits
from tests.llm.test_simhash import components, plain_fingerprint
from tremorlane.llm.common import staged
from tremorlane.llm.oracles import ORACLES
from tremorlane.llm.queries import QUERIES
from tremorlane.llm.toxicity import fit_toxicity, score_toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF)
    yield connection
    connection.close()


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(shipped, duck, name):
    result = queries()[name](shipped, SF).toPandas()
    assert differences(result, duck.execute(ORACLES[name]).df()) is None


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ORACLES])
def test_one_row_per_document(shipped, name):
    result = queries()[name](shipped, SF).toPandas()
    ids = shipped.read.parquet(f"{SF}/documents.parquet").select("doc_id").toPandas()
    assert sorted(result.doc_id) == sorted(ids.doc_id)


def test_held_out_toxicity(shipped):
    sf = "/root/testdata/sf0.1"
    docs, labels = (shipped.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    scores = score_toxicity(docs, fit_toxicity(docs, labels)).where("held_out").toPandas()
    rows = scores.merge(labels.toPandas(), on="doc_id")
    bad, good = (rows[rows.toxic == y].score.to_numpy() for y in (1, 0))
    assert np.mean(bad[:, None] > good[None, :]) > 0.95
    assert np.mean(bad >= 0.5) > 0.8
    assert np.mean(good >= 0.5) < 0.01


def test_pipeline_stages(shipped):
    docs = shipped.read.parquet(f"{SF}/documents.parquet")
    benchmark = [tuple(row) for row in shipped.read.parquet(f"{SF}/benchmark.parquet").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    assert names == ["toxicity", "exact_dedup", "simhash_dedup", "decontamination", "byte_bpe"]

    def texts(table):
        return {row["doc_id"]: row["text"] for row in table.collect()}

    def step(name, table):
        out = staged(stages[name](shipped, table, SF), name)
        assert name == names[-1] or out.columns == docs.columns
        return out

    labels = shipped.read.parquet(f"{SF}/labels.parquet")
    scores = score_toxicity(docs, fit_toxicity(docs, labels)).collect()
    clean = step("toxicity", docs)
    assert set(texts(clean)) == {row["doc_id"] for row in scores if not row["predicted"]}

    before, distinct = texts(clean), step("exact_dedup", clean)
    first = {}
    for doc_id in sorted(before):
        first.setdefault(plain(before[doc_id]), doc_id)
    assert set(texts(distinct)) == set(first.values())

    before, apart = texts(distinct), step("simhash_dedup", distinct)
    prints = {doc_id: plain_fingerprint(text or "") for doc_id, text in before.items()}
    found = components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert set(texts(apart)) == set(found.values())

    before, free = texts(apart), step("decontamination", apart)
    expected = {i for i, text in before.items() if not plain_hits(text, benchmark, 10)[1]}
    assert set(texts(free)) == expected

    encoded = step("byte_bpe", free)
    assert {row["doc_id"] for row in encoded.collect()} == expected
    whole = corpus_pipeline.run(shipped, SF)
    assert sorted(whole.collect()) == sorted(encoded.collect())


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(shipped, odd_docs, no_docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(shipped, no_docs, SF).count() == 0
    assert 0 < stage(shipped, odd_docs, SF).count() <= odd_docs.count()


NAMES = "_id _sha _n _words _of _stays _kept _h _k _r _d _fp row first last fp root idx uid level name sha"


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_keep_columns_of_any_name(shipped, odd_rows, name):
    """Other columns may be called what the operators call theirs; their values stay with their rows."""
    names = NAMES.split()
    kinds = ", ".join(f"`{other}` string" for other in names)
    rows = [(*row, *(f"{other}{i}" for other in names)) for i, row in enumerate(odd_rows)]
    docs = shipped.createDataFrame(rows, f"doc_id long, text string, {kinds}").repartition(3)
    out = dict(corpus_pipeline.STAGES)[name](shipped, docs, SF)
    found = [tuple(row) for row in out.collect()]
    if name == "byte_bpe":
        assert len(found) == len(rows)
    else:
        assert out.columns == docs.columns
        assert 0 < len(found) == len(set(found)) and set(found) <= set(rows)
