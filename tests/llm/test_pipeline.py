"""The pipeline stage by stage against brute force, and the entry point without the subpackage."""

import os
import subprocess
import sys
import tempfile

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.fixtures import components, documents, sentence, texts
from tests.llm.test_table_operators import _labelled

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _folder(spark, rows, labels):
    path = tempfile.mkdtemp(prefix="shoplens-pipeline-")
    documents(spark, rows).drop("bucket", "rank", "spans").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark):
    labelled = [(10_000 + i, t, y) for i, t, y in _labelled(240)]
    rows = texts() + [(i, t) for i, t, _ in labelled]
    path = _folder(spark, rows, [(i, 1, y) for i, _, y in labelled])
    docs = spark.read.parquet(f"{path}/documents.parquet")

    toxic = {i for i, _, y in labelled if y}
    kept = corpus_pipeline.toxicity(spark, docs, path)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns
    assert len(toxic & set(ids)) <= 0.05 * len(toxic)
    assert {i for i, _ in rows} - toxic <= set(ids)  # no clean document goes

    near = corpus_pipeline.near_copies(spark, docs, path)
    want = components([r for r in rows if r[0] is not None])
    got = sorted(r["doc_id"] for r in near.collect() if r["doc_id"] is not None)
    assert near.columns == docs.columns
    assert got == sorted({i for i, c in want.items() if i == c})
    assert near.filter("doc_id is null").count() == 1

    masked = corpus_pipeline.personal_data(spark, docs, path)
    assert masked.columns == docs.columns and masked.count() == len(rows)
    assert "@" not in masked.filter("doc_id = 24").first()["text"]

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "personal_data", "packing"]


def test_toxicity_keeps_columns_that_clash(spark):
    labelled = [(100 + i, t, y) for i, t, y in _labelled(240)]
    clean = "a plain text of some words"
    rows = [(i, t) for i, t, _ in labelled] + [(1, None), (2, ""), (None, clean), (3, clean), (3, clean)]
    path = _folder(spark, rows, [(i, 1, y) for i, _, y in labelled])
    docs = spark.read.parquet(f"{path}/documents.parquet").selectExpr("*", "9.5 AS _toxicity_score", "1 AS __Toxicity_spans")
    kept = corpus_pipeline.toxicity(spark, docs, path)
    assert kept.schema == docs.schema
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.filter("doc_id is null or doc_id < 100").collect())
    assert got == [(0, clean), (1, ""), (2, ""), (3, clean), (3, clean)]
    assert {r["_toxicity_score"] for r in kept.collect()} == {docs.first()["_toxicity_score"]}
    # labels of one class teach nothing: all stay
    one = _folder(spark, rows, [(i, 1, 0) for i, _, y in labelled if not y])
    assert corpus_pipeline.toxicity(spark, docs, one).count() == len(rows)


def test_repeated_ids_lose_only_their_copies(spark):
    a, b, c, d = (sentence(k, 60) for k in (3, 11, 17, 23))
    rows = [(3, a), (5, a + " tail"), (5, b), (7, c), (7, c + " more"), (7, d), (9, d + " end"), (None, a)]
    rows += [(11, b + " x"), (3, a), (12, ""), (12, None)]
    path = _folder(spark, rows, [])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.near_copies(spark, docs, path).collect()
    got = sorted((r["doc_id"] or 0, (r["text"] or "")[:30], len(r["text"] or "")) for r in kept)
    seven = [t for i, _, t in got if i == 7]
    assert [x[0] for x in got] == [0, 3, 5, 7, 7, 12, 12]
    assert (5, b[:30], len(b)) in got and (7, d[:30], len(d)) in got
    assert sorted(seven) in (sorted([len(c), len(d)]), sorted([len(c + " more"), len(d)]))


def test_run_packs_what_the_stages_keep(spark):
    rows = [(i, sentence(i * 3 + 1, 30)) for i in range(20)] + [(50, sentence(4, 30) + " more"), (51, "ann@mail.example.com")]
    path = _folder(spark, rows, [(1, 1, 0)])
    out = corpus_pipeline.run(spark, path).collect()
    texts_ = dict(rows) | {51: "[EMAIL]"}
    del texts_[50]  # a near copy of document 1
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in texts_.items()}
    got: dict[int, int] = {}
    for r in out:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_empty_tables(spark):
    path = _folder(spark, [], [])
    assert corpus_pipeline.run(spark, path).count() == 0


def test_entry_without_the_subpackage():
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name in ('corpus_pipeline', 'shoplens.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) == 24 and len(e.oracle_sql()) == 24\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "shoplens")):
        for name in files:
            if name.endswith(".py") and os.path.basename(folder) != "llm":
                assert "shoplens.llm" not in open(os.path.join(folder, name)).read(), name


def test_queries_are_registered():
    import __spark_entry__ as e

    names = [k for k in e.queries() if k.startswith("op")]
    assert [int(k[2:].split("_")[0]) for k in names] == list(range(1, 14))
    assert "pipeline" in e.queries()


def test_operators_reach_the_workers_from_any_folder(tmp_path):
    # only the driver's own path holds the package
    code = """
import sys
sys.path.insert(0, %r)
from pyspark.sql import SparkSession
from shoplens.llm.html_main import extract_main_text
from shoplens.llm.ngram_join import near_duplicates
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
same = "one two three four five six seven"
docs = spark.createDataFrame([(4, same), (2, same), (3, "another text")], "doc_id long, text string")
print(sorted((r.doc_id, r.component_id) for r in near_duplicates(docs).collect()))
pages = spark.createDataFrame([(1, "u", "<p>word</p>")], "page_id long, url string, html string")
print(extract_main_text(pages).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code % ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert run.stdout.split("\n")[-3:-1] == ["[(2, 2), (3, 3), (4, 2)]", "1"]
