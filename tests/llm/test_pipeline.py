"""The pipeline's stages, and its parts without the guard."""

import ast
from pathlib import Path

import corpus_pipeline
from vigilog.llm import queries

ROOT = Path(__file__).resolve().parents[2]


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = [docs.count()]
    toxic = {r["doc_id"] for r in queries.QUERIES["op5_toxicity"](spark, sf_dir).where("predicted = 1").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        if name == "toxicity":
            assert {r["doc_id"] for r in docs.select("doc_id").collect()} - {r["doc_id"] for r in out.select("doc_id").collect()} == toxic
        docs = out
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] and sizes[4] == sizes[5]


def test_nothing_else_imports_the_package():
    for path in [*ROOT.glob("*.py"), *ROOT.glob("vigilog/**/*.py"), *ROOT.glob("tests/*.py")]:
        if "llm" in path.relative_to(ROOT).parts or path.name in ("__spark_entry__.py", "corpus_pipeline.py"):
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") or n == "corpus_pipeline" for n in names), path
