"""Each stage takes effect on its own input, run() chains them."""

import corpus_pipeline
import public_tokenizers
import tiktoken
from tiktoken.load import load_tiktoken_bpe
from snapdeck.llm import quality, secret_scan, simhash

from tests.llm.test_native import brute_hits, brute_quality
from tests.llm.test_simhash import brute_components, brute_fingerprint


def test_stages(spark, odd, none):
    sf = "/root/testdata/sf0.001"
    for df in (odd, none):
        for name, fn in corpus_pipeline.STAGES[:-1]:
            assert fn(spark, df, sf).columns == df.columns, name
    assert corpus_pipeline.encode(spark, odd, sf).count() == odd.count()


def test_run(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = docs
    sizes = [docs.count()]
    for _, fn in corpus_pipeline.STAGES[:-1]:
        left = fn(spark, left, sf).cache()
        sizes.append(left.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4]
    found = simhash.near_duplicates(left).collect()  # redaction may bring texts nearer, not the stage before it
    assert len(found) == sizes[4]
    out = corpus_pipeline.run(spark, sf)
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in left.select("doc_id").collect())


def test_each_stage_against_brute_force(spark):
    """Every stage on what its predecessor kept."""
    sf = "/root/testdata/sf0.001"
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = lambda df: {r.doc_id: r.text for r in df.collect()}

    kept = stages["quality_rules"](spark, docs, sf).cache()
    before, after = rows(docs), rows(kept)
    failed = {d for d, t in before.items() if brute_quality(t)[-1]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert not failed & after.keys()
    assert all(d in after for d in before if labels.get(d) == 1 and d not in failed)
    assert after.keys() == {r.doc_id for r in quality.score(docs).collect() if r.kept}

    one = stages["simhash_near_duplicates"](spark, kept, sf).cache()
    groups = brute_components([(d, brute_fingerprint(t)) for d, t in after.items()])
    assert rows(one) == {d: after[d] for d in {c for _, _, c in groups}}

    clean = stages["benchmark_decontamination"](spark, one, sf).cache()
    hit = {x[0] for x in brute_hits(list(rows(one).items()), items) if x[5]}
    assert hit and rows(clean) == {d: t for d, t in rows(one).items() if d not in hit}

    safe = stages["secret_scan"](spark, clean, sf).cache()
    spans, new = {r.doc_id: r.spans for r in secret_scan.scan(clean).collect()}, rows(safe)
    for d, text in rows(clean).items():
        cut = sorted((int(a), int(b)) for _, a, b in (s.rsplit(":", 2) for s in spans[d].split(",") if s))
        at = where = 0
        for a, b in [*cut, (len(text), len(text))]:  # what is outside of the spans is there, in order
            outside = text[at:a]
            where = new[d].index(outside, where) + len(outside)
            at = max(at, b)
        assert (new[d] == text) == (not cut) and all(text[a:b] not in new[d] for a, b in cut)

    out = stages["byte_bpe"](spark, safe, sf).collect()
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    texts = rows(safe)
    assert {r.doc_id: list(r.ids) for r in out} == {d: enc.encode_ordinary(t) for d, t in texts.items()}
    assert len(out) == len(texts)
