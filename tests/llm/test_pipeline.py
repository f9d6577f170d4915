"""The pipeline stage by stage, each against a brute-force version on what came before."""

import corpus_pipeline as cp
import pytest
from arrears.llm import quality
from arrears.sources.staging import stage

from . import test_decontamination as decontamination
from . import test_line_dedup as line_dedup
from . import test_simhash as simhash

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, table):
    """The documents before the first stage and after each one."""
    docs = [table("documents")]
    for _, step in cp.STAGES:
        docs.append(stage(step(spark, docs[-1], FOLDER)))
    return docs


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(steps):
    assert all(d.columns == steps[0].columns for d in steps[:-1])


def test_quality(steps, table):
    kept = {r.doc_id for r in quality.classify(steps[0], table("labels")).where("kept").collect()}
    assert texts(steps[1]).keys() == kept and 0.5 < len(kept) / steps[0].count() < 1


def test_line_dedup(steps):
    before = texts(steps[1])
    expected = line_dedup.brute_force(list(before.items()))
    expected = {i: t for i, t in expected.items() if t == before[i] or t.strip()}
    assert texts(steps[2]) == expected
    assert all(r.n_chars == len(r.text) for r in steps[2].collect() if r.text != before[r.doc_id])


def test_near_dedup(steps):
    before = texts(steps[2])
    found = simhash.brute_force(list(before.items()))
    assert texts(steps[3]) == {i: before[i] for i, (_, root) in found.items() if i == root}


def test_decontamination(steps, table):
    before = texts(steps[3])
    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    found = decontamination.brute_force(list(before.items()), items)
    assert texts(steps[4]) == {i: before[i] for i in before if not found[i][3]}


def test_run_is_the_last_stage(spark, steps):
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(cp.run(spark, FOLDER)) == rows(steps[5])
    assert steps[5].count() == steps[4].count()


def test_empty_and_odd_documents(spark, frame):
    docs = frame([])
    for _, step in cp.STAGES:
        docs = step(spark, docs, FOLDER)
    assert docs.collect() == []
    docs = frame([(None, None), (1, ""), (2, "a text"), (2, "a text")], _spans="x", fp="y")
    for name, step in cp.STAGES[:-1]:
        docs = step(spark, docs, FOLDER)
        assert docs.columns[-2:] == ["_spans", "fp"], name
    assert cp.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()
