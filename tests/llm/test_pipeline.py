"""The pipeline: what each stage is given, what it keeps, and that all of it is run."""

import brute
import corpus_pipeline
import pandas as pd
import pytest
from harkline.llm import lines
from __spark_entry__ import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """What each stage returns, written and read again, after the documents themselves."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return [d.toPandas() for d in out]


def test_columns(written):
    assert all(list(d.columns) == list(written[0].columns) for d in written[:-1])
    assert {"doc_id", "size", "copies", "taken", "target"} <= set(written[-1].columns)


def test_quality_stage(written):
    docs, left = written[0].set_index("doc_id"), written[1].set_index("doc_id")
    failed = {d for d, t in docs.text.items() if brute.quality_counts(t)[-1]}
    assert not failed & set(left.index) and left.text.equals(docs.text[left.index])
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id")
    good = set(labels[labels.quality == 1].index) - failed
    assert len(good & set(left.index)) >= 0.99 * len(good)


def test_line_stage(written):
    rows = list(zip(written[1].doc_id, written[1].text))
    sure, least = brute.line_runs(rows, lines.SURE_LINES), brute.line_runs(rows, lines.MIN_LINES)
    left = written[2].set_index("doc_id")
    for d, t in rows:
        own = [x for x in t.split("\n") if brute.words(x)]
        if d not in left.index:
            assert len(least[d, t]) == len(own)
            continue
        stay = [x for x in left.text[d].split("\n") if brute.words(x)]
        assert len(own) - len(least[d, t]) <= len(stay) <= len(own) - len(sure[d, t])
        assert left.n_chars[d] == len(left.text[d])


def test_near_copy_stage(written):
    docs = list(zip(written[2].doc_id.tolist(), written[2].text))
    component = brute.components(brute.jaccard_links(docs), [d for d, _ in docs])
    assert set(written[3].doc_id) == set(component.values())


def test_decontamination_stage(written):
    plain = lambda t: f" {' '.join(brute.words(brute.lowered(t)))} "
    items = [plain(t) for t in pd.read_parquet(f"{SF}/benchmark.parquet").text]
    leaks = {d for d, t in zip(written[3].doc_id, map(plain, written[3].text)) if any(x in t for x in items)}
    gone = set(written[3].doc_id) - set(written[4].doc_id)
    assert leaks <= gone and len(gone) <= len(leaks) + 2


def test_mixing_stage(written):
    rows = written[5]
    assert sorted(zip(rows.doc_id, rows["size"])) == sorted((d, len(brute.words(t))) for d, t in zip(written[4].doc_id, written[4].text))
    by = rows.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert ((by.taken - by.target).abs() <= by.most).all()


def test_run_is_all_stages(spark, written):
    got = queries()["pipeline"](spark, SF).toPandas()
    key = lambda f: sorted(map(tuple, f[sorted(f.columns)].values.tolist()))
    assert key(got) == key(written[-1])
