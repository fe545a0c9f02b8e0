"""The pipeline and the package's place in the repository."""

import os
import subprocess

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from jobweave.llm import decontamination, neardup, suffixes, toxicity
from jobweave.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def test_nothing_else_imports_the_package():
    found = subprocess.run(["grep", "-rlE", r"\bllm\b", "jobweave", "--include=*.py"], cwd=ROOT, capture_output=True, text=True)
    assert all(line.startswith("jobweave/llm/") for line in found.stdout.split())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")
def test_pipeline(spark):
    """Each stage's decisions take effect, and clean documents come through."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    toxic = {r["doc_id"] for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    after = stages["toxicity"](spark, docs, SF_DIR).cache()
    ids = {r["doc_id"] for r in docs.collect()}
    assert after.columns == docs.columns and {r["doc_id"] for r in after.collect()} == ids - toxic
    kept = {r["doc_id"] for r in neardup.near_duplicates(after).where("kept").collect()}
    after = stages["near_dedup"](spark, after, SF_DIR).cache()
    assert {r["doc_id"] for r in after.collect()} == kept
    sizes = {r["doc_id"]: r["n_bytes"] - r["n_removed"] for r in suffixes.remove_repeats(after).collect()}
    after = stages["suffix_dedup"](spark, after, SF_DIR).cache()
    rows = after.collect()
    assert after.columns == docs.columns and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert all(0 <= len(r["text"].encode()) - sizes[r["doc_id"]] <= 6 * 200 for r in rows)
    bad = {r["doc_id"] for r in decontamination.decontaminate(after, benchmark).where("contaminated").collect()}
    after = stages["decontamination"](spark, after, SF_DIR).cache()
    assert {r["doc_id"] for r in after.collect()} == kept - bad
    pieces = stages["packing"](spark, after, SF_DIR)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == kept - bad
    ran = corpus_pipeline.run(spark, SF_DIR)
    assert ran.columns == pieces.columns and ran.count() == pieces.count()
