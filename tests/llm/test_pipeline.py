"""The pipeline against its stages done by hand, and the library without this subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from hexsite.llm import mixing
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_jaccard import brute as classes

ROOT = Path(__file__).parents[2]


@pytest.fixture
def folder(docs, spark, texts, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, " ".join(texts[7][1].split()[10:30]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages(spark, docs, texts, folder):
    benchmark = [(1, " ".join(texts[7][1].split()[10:30]))]
    rows = [(i, t) for i, t in texts if i not in (1, 2, 3)]
    out = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, out, folder)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        got = sorted(str(r["doc_id"]) for r in out.collect())
        if name == "language_id":
            assert got == sorted(str(i) for i, _ in rows)
        elif name == "near_duplicates":
            found = classes(rows)
            rows = list(dict.fromkeys((i, t) for i, t in rows if any(j == i and c == i for j, c, _ in found)))
            assert got == sorted(str(i) for i, _ in rows)
        elif name == "benchmark_decontamination":
            clean = [r[0] for r in contaminated(rows, benchmark) if not r[-1]]
            rows = [(i, t) for i, t in rows if i in clean]
            assert got == sorted(str(i) for i, _ in rows)
            wanted = {r["doc_id"]: r["copies"] for r in mixing.mixed(out).collect()}
        else:
            assert got == sorted(str(i) for i, n in wanted.items() for _ in range(n))
    last = corpus_pipeline.STAGES[4][1](spark, out, folder).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    length = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows}
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in last) == sorted((str(i), length[i]) for i, n in wanted.items() for _ in range(n))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).collect()) == sorted(tuple(r) for r in last)


def test_an_empty_table(spark, docs, folder, tmp_path):
    empty = tmp_path / "none"
    docs.limit(0).write.parquet(str(empty / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(str(empty / "benchmark.parquet"))
    out = spark.read.parquet(str(empty / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, out, str(empty))
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_the_rest_stands_alone(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not [n for n in q if n.startswith('op')] and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": str(copy)})


def test_nothing_else_imports_it():
    for path in ROOT.rglob("*.py"):
        inside = path.relative_to(ROOT).parts
        if "llm" not in inside and inside[-1] not in ("corpus_pipeline.py", "__spark_entry__.py"):
            assert "hexsite.llm" not in path.read_text(), path


def test_a_broken_import_is_not_hidden(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    (copy / "hexsite/llm/mixing.py").write_text("import no_such_module_at_all\n")
    got = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries()"], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)})
    assert got.returncode and "no_such_module_at_all" in got.stderr
