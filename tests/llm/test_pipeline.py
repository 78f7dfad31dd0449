"""The pipeline's stages, each held against a plain version on its own input."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from delayworks.llm import quality, simhash, toxicity
from delayworks.llm.quality import training_rows
from tests.llm import frames
from tests.llm.test_packing import check_placement, ids_of
from tests.llm.test_simhash import plain_groups, plain_print

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.collect()]
    for name, function in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(function(spark, docs, FOLDER), f"test-{name}")
        out.append(docs.collect())
    return out


def labelled(spark, rows, label, most):
    docs = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return training_rows(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), label, most=most)


def test_toxic_documents_go_and_no_other(steps, spark):
    before, after = steps[0], steps[1]
    model = toxicity.train(*labelled(spark, before, "toxic", toxicity.FIT_DOCUMENTS))
    scores, _, _ = model.scores([toxicity.tokens_of(r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r, s in zip(before, scores) if s < toxicity.THRESHOLD)
    texts = {r.doc_id: r for r in before}
    assert all(texts[r.doc_id] == r for r in after)


def test_poor_documents_go_and_no_other(steps, spark):
    before, after = steps[1], steps[2]
    model = quality.train(*labelled(spark, before, "quality", quality.FIT_DOCUMENTS))
    scores = model.scores(quality.lines_of([r.text for r in before]))
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r, s in zip(before, scores) if s >= 0.5)


def test_one_document_of_each_group_stays(steps):
    before, after = sorted(steps[2], key=lambda r: r.doc_id), steps[3]
    groups = plain_groups([plain_print(r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted({before[g].doc_id for g in groups})


def test_mixed_documents_hold_words_of_their_own(steps):
    before, after = {r.doc_id: r for r in steps[3]}, steps[4]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    for r in after:
        assert 0 < count(r.text) <= 2 * count(before[r.doc_id].text) and r.n_chars == len(r.text) and r.source == before[r.doc_id].source
    total = sum(count(r.text) for r in before.values())
    assert abs(sum(count(r.text) for r in after) / total - 1.5) < 0.02


def test_packed_pieces_cover_the_mix(steps):
    rows, docs = steps[5], {r.doc_id: ids_of(r.text) for r in steps[4]}
    check_placement(rows, 4096)
    assert sum(r.length for r in rows) == sum(map(len, docs.values())) and {r.doc_id for r in rows} == set(docs)


def test_stage_columns_and_run(steps, spark):
    columns = list(corpus_pipeline.COLUMNS)
    assert [list(rows[0].asDict()) for rows in steps[1:5]] == [columns] * 4 and [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality", "simhash", "mixing", "packing"]
    assert sorted(corpus_pipeline.run(spark, FOLDER).collect()) == sorted(steps[5])


def test_awkward_rows_go_through_every_stage(spark):
    docs = frames.documents(spark)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, FOLDER)
    assert docs.count() > 0
    empty = frames.documents(spark).where("false")
    for _, function in corpus_pipeline.STAGES:
        empty = function(spark, empty, FOLDER)
    assert empty.count() == 0


def test_one_of_each_keeps_the_smallest_id(spark):
    docs = frames.documents(spark, [(9, "a b c d e", "en", "a", 1), (4, "A B C D E", "en", "a", 1), (4, "A B C D E", "en", "a", 1), (5, "x y z w v u t", "en", "a", 1)])
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == [4, 5]


def test_the_rest_stands_without_the_package(tmp_path):
    root = Path(__file__).resolve().parents[2]
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("delayworks.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=".".join(name.split(".")[:2]))
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
names = e.queries()
assert "gold_combined" in names and "pipeline" not in names and not any(n.startswith("op1_") for n in names)
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)


def test_a_broken_import_inside_is_not_swallowed(tmp_path):
    root = Path(__file__).resolve().parents[2]
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
class Broken:
    def find_spec(self, name, path=None, target=None):
        if name == "xxhash":
            raise ModuleNotFoundError("No module named 'xxhash'", name="xxhash")
sys.meta_path.insert(0, Broken())
try:
    import __spark_entry__
except ModuleNotFoundError as error:
    assert error.name == "xxhash"
else:
    raise SystemExit("swallowed")
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
