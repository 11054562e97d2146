"""The pipeline against a brute-force version of its stages, and its stages on awkward rows."""
import os
import subprocess
import sys

import pytest
from .rows import CLASHING, SMALL, awkward_rows, with_clashes
from .test_pairs import groups_of, slow_groups
from .test_rows import check_packed, slow_matches

import corpus_pipeline
from tickwise.llm import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, documents):
    """Every stage on what the one before it kept, written and reread."""
    docs = documents
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        given = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, SMALL)
        if name == "packing":
            assert check_packed(given, out.collect()) == 0
            break
        assert out.columns == COLUMNS
        got = sorted(r.doc_id for r in out.collect())
        if name == "toxicity":
            classifier = toxicity.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
            want = sorted(r.doc_id for r in toxicity.score(docs, classifier).collect() if r.score < 0.5)
        elif name == "exact_dedup":
            want = sorted(max(ids) for ids in groups_of(given).values())
        elif name == "simhash_dedup":
            want = sorted({int(c) for _, _, c in slow_groups(given)})
        else:
            want = sorted(i for i, t in given if not slow_matches(t, items)[3])
        assert got == want
        docs = out.checkpoint()


def test_run_gives_pieces_of_the_kept_documents(spark):
    assert set(corpus_pipeline.run(spark, SMALL).columns) >= {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"}


@pytest.mark.parametrize("k", range(4))
def test_stages_on_awkward_rows(spark, awkward, nothing, k):
    name, stage = corpus_pipeline.STAGES[k]
    df = with_clashes(awkward)
    out = stage(spark, df, SMALL)
    assert out.columns == df.columns
    got = out.collect()
    assert got and {r["doc_id"] for r in got} <= {i for i, _ in awkward_rows()}
    assert all(r[c] == f"own {c}" for r in got for c in CLASHING)
    assert stage(spark, nothing, SMALL).collect() == []


def test_packing_stage_on_awkward_rows(spark, awkward, nothing):
    stage = corpus_pipeline.STAGES[4][1]
    assert check_packed(awkward_rows(), stage(spark, with_clashes(awkward), SMALL).collect()) == 0
    assert stage(spark, nothing, SMALL).collect() == []


def test_the_rest_does_not_need_this_package(tmp_path):
    """Without the package and the pipeline the entry still imports and has the other queries."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys, importlib.abc\n"
            "class No(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('tickwise.llm'):\n"
            "            raise ModuleNotFoundError(name)\n"
            "sys.meta_path.insert(0, No())\n"
            f"sys.path.insert(0, {root!r})\n"
            "import __spark_entry__ as e\n"
            "q = e.queries()\n"
            "assert q and not any(k.startswith('op') or k == 'pipeline' for k in q)\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)


def test_run_writes_and_rereads_each_stage(spark):
    """The last stage reads what the one before it wrote, and each written stage holds that stage's rows."""
    out = corpus_pipeline.run(spark, SMALL)
    files = out.inputFiles()
    assert files and all("/corpus-" in f and "/decontamination/" in f for f in files)
    folder = files[0].rsplit("/decontamination/", 1)[0]
    left = [spark.read.parquet(f"{folder}/{name}") for name, _ in corpus_pipeline.STAGES[:-1]]
    assert all(df.columns == COLUMNS for df in left)
    counts = [df.count() for df in left]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    kept = [(r.doc_id, r.text) for r in left[-1].collect()]
    assert check_packed(kept, out.collect()) == 0
