"""The pipeline against plain Python, stage by stage."""

import hashlib

import corpus_pipeline as pipeline
from test_near import plain_components
from tokenizers import Tokenizer

from wattlake.llm import packing, pii, quality
from wattlake.llm.queries import ACCEPTED, quality_model


def test_pipeline_against_plain_python(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    scorer = quality.Scorer(quality_model(docs, labels))
    rows = [(r.doc_id, r.text) for r in docs.collect() if scorer.score(r.text or "") >= ACCEPTED]
    last = {}
    for i, t in rows:
        last[hashlib.sha256((t or "").encode()).hexdigest()] = max(i, last.get(hashlib.sha256((t or "").encode()).hexdigest(), i))
    rows = sorted((i, t) for i, t in rows if i in last.values())
    gone = plain_components(rows)
    assert gone
    rows = [(i, pii.masked(t or "", pii.find(t or ""))) for i, t in rows if i not in gone]
    library = Tokenizer.from_file(packing.VOCABULARY)
    want = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}
    got = pipeline.run(spark, small).collect()
    assert {p.doc_id: p.doc_tokens for p in got} == want
    assert sum(p.length for p in got) == sum(want.values())


def test_stages_keep_the_columns(spark, table, small):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = table([(k, f"word{k} and some more text number {k} to be kept") for k in range(30)] + [(50, None), (51, "")])
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns[:5] == names, name
    assert pipeline.STAGES[-1][1](spark, docs, small).count() > 0
