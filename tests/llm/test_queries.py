"""Registered queries: DuckDB comparison, the pipeline against its operators, and independence of the library."""

import re
from pathlib import Path

import pytest

from llm_fixtures import *  # noqa: F401,F403
import corpus_pipeline
from conftest import ROOT, SF_MID, SF_SMALL
from oracle_harness import compare, duck_connection
from tessera.llm import catalog, decontaminate, near_dedup, token_store, toxicity
from tessera.llm.common import read


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in catalog.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_oracle(spark, name, sf):
    r = compare(spark, sf, name, catalog.QUERIES[name], catalog.ORACLES[name], duck_connection(sf))
    assert r["values"], r.get("detail")


def test_nothing_else_imports_the_package():
    for f in [*Path(ROOT, "tessera").rglob("*.py"), *Path(ROOT, "tests").glob("*.py"), Path(ROOT, "bench.py")]:
        if "llm" not in f.relative_to(ROOT).parts:
            assert not re.search(r"^\s*(from|import)\s+(tessera\.llm|corpus_pipeline)", f.read_text(), re.M), f


def test_pipeline_stages_take_effect(spark, scratch):
    docs = read(spark, SF_MID, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontaminate", "mixing", "token_store"]
    seen = [docs]
    for name, step in corpus_pipeline.STAGES:
        step(spark, seen[-1], SF_MID).write.parquet(f"{scratch}/{name}")
        seen.append(spark.read.parquet(f"{scratch}/{name}"))
        if name != "token_store":
            assert seen[-1].columns == columns
    ids = [[r.doc_id for r in s.select("doc_id").collect()] for s in seen]
    model, curve = toxicity.train(spark, docs, read(spark, SF_MID, "labels"), toxicity.learnable)
    fine = {r.doc_id for r in toxicity.score(docs, model, curve).where(f"score < {toxicity.THRESHOLD}").collect()}
    assert set(ids[1]) == fine and len(ids[1]) < len(ids[0])
    kept = {r.doc_id for r in near_dedup.near_duplicates(seen[1]).where("kept").collect()}
    assert sorted(ids[2]) == sorted(kept)
    hit = {r.doc_id for r in decontaminate.hit_runs(seen[2], read(spark, SF_MID, "benchmark")).where("size(runs) > 0").collect()}
    assert sorted(ids[3]) == sorted(set(ids[2]) - hit)
    assert set(ids[4]) <= set(ids[3]) and len(set(ids[4])) > 0.97 * len(set(ids[3])) and len(ids[4]) > len(ids[3])
    assert set(ids[4]) == set(ids[3])
    import public_tokenizers
    enc = token_store.Encoder(public_tokenizers.path(token_store.TOKENIZER), token_store.END_ID)
    sizes = sorted((r.doc_id, len(enc.encode(r.text)) // enc.width) for r in seen[4].collect())
    assert sorted((r.doc_id, r.n_tokens) for r in seen[5].collect()) == sizes


def test_pipeline_with_awkward_rows(spark):
    docs = read(spark, SF_SMALL, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (7, None, "en", "s", 0), (7, "", None, None, None),
                                 (900, "x y " * 40_000, "en", "s", 1), (900, "x y " * 40_000, "en", "s", 1)], docs.schema)
    both = docs.unionByName(odd)
    for rows in (both, docs.where("false")):
        for _, step in corpus_pipeline.STAGES:
            rows = step(spark, rows, SF_SMALL)
        assert rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        rows.collect()


def test_pipeline_with_clashing_columns(spark):
    """Columns named like the operators' own keep their values through every stage."""
    names = "score copy rate print n_tokens p_0 row logit t keep_id keep_print n shard".split()
    docs = read(spark, SF_SMALL, "documents")
    plain, wide = docs, docs.selectExpr("*", *(f"concat('{n}', doc_id) AS {n}" for n in names))
    for name, step in corpus_pipeline.STAGES:
        plain, wide = step(spark, plain, SF_SMALL), step(spark, wide, SF_SMALL)
        if name != "token_store":
            assert wide.columns == [*docs.columns, *names]
            assert wide.where(" OR ".join(f"{n} != concat('{n}', doc_id)" for n in names)).count() == 0
        assert sorted(map(str, wide.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
