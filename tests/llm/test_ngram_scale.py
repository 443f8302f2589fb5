"""What the n-gram join keeps of its sets when the corpus has far more tokens than its map has bits."""

import random

from millrace.llm import ngram_join


def test_few_sets_go_on_when_tokens_outgrow_the_map(spark, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(200)) for _ in range(150)]
    texts += [t + " more" for t in texts[:4]] + texts[10:40]  # four near copies, thirty copies
    kept = []
    keep = ngram_join.written

    def written(df, name, *options):
        out = keep(df, name, *options)
        if name == "shingles":
            kept.extend(len(r["names"]) // 8 for r in out.select("names").collect())
        return out

    monkeypatch.setattr(ngram_join, "written", written)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(docs, bits=1 << 12).collect()}
    want = {i: i for i in range(150)} | {150 + i: i for i in range(4)} | {154 + i: 10 + i for i in range(30)}
    assert got == want and 8 <= sum(kept) <= 20
