"""The pipeline's stages against brute-force versions, and its edge cases."""

import hashlib

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from peerlens.llm import bpe, decontam, minhash
from peerlens.llm.queries import TOXIC, op5_toxicity
from tests.conftest import SF_SMALL
from tests.llm.test_near_duplicates import _brute


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "decontamination", "byte_bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_every_stage_equals_brute_force(spark, scratch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, steps = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(f"{scratch}/{name}")
        steps.append((docs, spark.read.parquet(f"{scratch}/{name}")))
        docs = steps[-1][1]
        if name != "byte_bpe":
            assert docs.columns == columns
    rows = [[{r.doc_id: r.text for r in x.select("doc_id", "text").collect()} for x in pair] for pair in steps[:3]]
    toxic = {r.doc_id for r in op5_toxicity(spark, SF_SMALL).collect() if r.score >= TOXIC}
    assert toxic and set(rows[0][1]) == set(rows[0][0]) - toxic
    classes = _brute(rows[1][0])
    assert set(rows[1][1]) == {i for i, c in classes.items() if i == c} and len(rows[1][1]) < len(rows[1][0])
    items = [" ".join(t.lower().split()) for (t,) in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("text").collect()]
    leaked = {i for i, t in rows[2][0].items() if any(x in " ".join(t.lower().split()) for x in items)}
    assert leaked and set(rows[2][1]) == set(rows[2][0]) - leaked  # here all copies are exact
    library = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    final = {r.doc_id: r for r in docs.collect()}
    assert set(final) == set(rows[2][1])
    for i, text in rows[2][1].items():
        ids = library.encode_ordinary(text)
        assert final[i].n_tokens == len(ids) and final[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    whole = {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert whole == {(i, r.ids_sha256) for i, r in final.items()}


def test_stages_on_nulls_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (None, "a text without id", "en", "s", 17), (2, "", "", "", 0), (2, "", "", "", 0), (3, "some text", None, "s", 9)]
    docs = spark.createDataFrame([(*r, "more") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    for name, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
        kept = stage(spark, docs, SF_SMALL).collect()
        assert len(kept) == (4 if name == "minhash_near_dedup" else 5), name  # repeated rows stay once
    last = corpus_pipeline.STAGES[3][1](spark, docs, SF_SMALL)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and last.count() == 5
    assert minhash.SIMILARITY == 0.8 and minhash.SHINGLE == 5 and decontam.needed(100) == 26
