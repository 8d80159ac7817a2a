"""The pipeline's stages, each on its own input, against plain versions."""

import public_tokenizers
import sentencepiece

import corpus_pipeline
from quaymart.llm import mixing, secrets
from quaymart.session import stage
from test_near_dup import brute


def test_stages(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "secrets", "mix", "sentencepiece"]
    rows, kept = docs, {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in rows.collect()]
        rows = stage(step(spark, rows, ""))
        assert rows.columns == docs.columns
        after = [tuple(r) for r in rows.collect()]
        kept[name] = after
        if name == "language_id":
            assert sorted(after, key=str) == sorted([r for r in before if r[1] and any(c.isalpha() for c in r[1])], key=str)
        elif name == "near_dedup":
            groups = brute(before)
            assert sorted(r[0] for r in after) == sorted({d for d in groups if groups[d] == d})
            assert set(after) <= set(before)
        elif name == "secrets":
            texts = {r[0]: r[1] for r in before}
            assert sorted(texts) == sorted(r[0] for r in after)
            for r in after:
                assert r[1] == secrets.mask(texts[r[0]], [(a, b) for _, a, b in secrets.find(texts[r[0]])]) and r[4] == len(r[1])
        else:
            copies = {r.doc_id: r.copies for r in mixing.mix(stage(spark.createDataFrame(before, docs.schema))).collect()}
            assert sorted(r[0] for r in after) == sorted(d for d, n in copies.items() for _ in range(n))
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r[0]: r[1] for r in kept["mix"]}
    out = corpus_pipeline.STAGES[-1][1](spark, rows, "").collect()
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in kept["mix"])
    assert all(r.ids == library.encode(texts[r.doc_id]) for r in out)
