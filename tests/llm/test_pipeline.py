"""The pipeline against its stages done by hand, on a small corpus."""

from __future__ import annotations

import collections
import random
import re

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_mixing import brute_targets
from tests.llm.test_pii import brute as base_spans
from tests.llm.test_simhash import brute_components, brute_print
from tillscope.llm import nbsvm

BIG = SF_DIR.replace("sf0.001", "sf0.01")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns over the tables, as lists of rows."""
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    found = {"documents": [tuple(r) for r in docs.select(*COLUMNS).collect()]}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, BIG)
        rows = [tuple(r) for r in out.collect()]
        found[name] = rows
        docs = spark.createDataFrame(rows, out.schema)
    return found


def test_stages_and_registration(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "decontamination", "pii", "mixing"]
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in registered.oracle_sql()
    names = registered.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_quality_keeps_what_the_model_accepts(spark, stages):
    kept = {r[0] for r in stages["quality"]}
    scores = nbsvm.query(spark, BIG).toPandas()
    assert kept == set(scores[scores.predicted == 1].doc_id)


def test_one_document_of_each_group_stays(stages):
    prints = {r[0]: brute_print(r[1]) for r in stages["quality"]}
    values = sorted(set(prints.values()))
    links = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 2]
    label = brute_components(links, values)
    least = collections.defaultdict(list)
    for doc_id, value in prints.items():
        least[label[value]].append(doc_id)
    assert {r[0] for r in stages["simhash"]} == {min(ids) for ids in least.values()}


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{BIG}/benchmark.parquet").collect()]
    near = [r for r in stages["simhash"] if any(w in (r[1] or "").lower() for _, t in items for w in [" ".join(t.lower().split()[2:5])])]
    bad = {d for d, _ in contaminated([(r[0], r[1], r[3]) for r in near], items)}
    assert {r[0] for r in stages["decontamination"]} == {r[0] for r in stages["simhash"]} - bad


def test_no_personal_data_stays(stages):
    before = {r[0]: r for r in stages["decontamination"]}
    assert {r[0] for r in stages["pii"]} == set(before)
    for row in stages["pii"]:
        assert base_spans(row[1]) == [] and row[4] == len(row[1])
        if not re.search("[0-9@]|dot", before[row[0]][1], re.I):
            assert row == before[row[0]]


def test_mix_is_over_what_is_left(stages):
    sizes = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in stages["pii"]}
    totals = collections.Counter()
    for r in stages["pii"]:
        totals[r[3]] += sizes[r[0]]
    targets = brute_targets(dict(totals))
    source = {r[0]: r[3] for r in stages["pii"]}
    assert {r[0]: r[1] for r in stages["mixing"]} == sizes
    for doc_id, _, source_size, target, *_ in stages["mixing"]:
        assert source_size == totals[source[doc_id]] and target == pytest.approx(targets[source[doc_id]])


def test_odd_documents_pass_all_stages(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["la", "mo", "ren"]) + str(i % 7) for _ in range(i)), "en", "s", 0) for i in range(20)]
    rows += [(None, None, None, None, None), (None, "x", None, None, 1), (30, None, "en", "s", None), (30, None, "en", "s", None), (31, "", "", "", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {r[0] for r in rows} and len(got) >= 10
