"""Every stage of the corpus pipeline against its contract, on its own input."""

import os
import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from rootline.storage import folder, store  # noqa: E402

from tests.llm.test_others import brute_hits  # noqa: E402
from tests.llm.test_substrings import brute_components, brute_lines  # noqa: E402


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = store(stage(spark, docs, small), "test")
        after = {r.doc_id: r for r in docs.collect()}
        texts = [(d, r.text) for d, r in before.items()]
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS and docs.count() == len(after) and set(after) <= set(before)
        if name == "toxicity":
            assert not [d for d in set(before) - set(after) if labels.get(d) == 0]
        elif name == "line dedup":
            left, count = brute_lines(texts, 3, 5), lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
            assert {d: r.text for d, r in after.items()} == {d: x[2] for d, x in left.items() if not x[1] or x[1] < x[0] and 4 * count(x[2]) >= count(before[d].text)}
            assert all(r.n_chars == len(r.text) for d, r in after.items() if left[d][1])
        elif name == "near duplicates":
            assert set(after) == {d for d, x in brute_components(texts).items() if x[1] == d}
        elif name == "decontamination":
            assert set(after) == {d for d, x in brute_hits(texts, items, 13).items() if not x[4]}
        else:
            assert set(after) == set(before)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_of_odd_rows(spark, small, name):
    """Nulls in any column, empty and very long texts, repeated rows and ids, clashing extra columns, an empty table."""
    stage = dict(corpus_pipeline.STAGES)[name]
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, "a plain text of some words", "en", "s", 26), (1, "a plain text of some words", "en", "s", 26), (1, None, None, None, None), (2, None, None, None, None), (3, "", None, "s", 0)]
    rows += [(4, long, "en", None, len(long)), (5, "another text that nobody repeats", "en", "s", None), (None, "lost text", "en", "s", 9)]
    extra = "doc_id long, text string, lang string, source string, n_chars long, n_removed int, left string, component_id int, toxic int, doc_tokens int"
    docs = spark.createDataFrame([(*r, 1, "x", 2, 1, 3) for r in rows], extra).repartition(3)
    got = stage(spark, docs, small).collect()
    if name == "packing":
        assert sorted({r.doc_id for r in got if r.doc_id}) == [1, 2, 3, 4, 5] and sum(r.start == 0 for r in got) == len(rows)
    else:
        kept = {r.doc_id: r.text for r in got}
        assert len(got) == len(kept) and got[0].asDict().keys() == set(corpus_pipeline.COLUMNS)
        assert kept == {1: None, 2: None, 3: "", 4: long, 5: "another text that nobody repeats"}
    assert stage(spark, docs.limit(0), small).count() == 0


def test_run_deletes_what_it_stored(spark, small):
    there = lambda: set(os.listdir(folder(spark)))
    before = there()
    assert corpus_pipeline.run(spark, small).count() > 0
    assert [x.rsplit("-", 1)[0] for x in there() - before] == ["stage-packing"]
