"""Language identification: held-out accuracy, families, odd texts."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quaymart.llm import lang_id
from quaymart.llm.common import read


def test_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    out = lang_id.held_out()
    model = lang_id.train(docs, ~out)
    assert sorted(map(sorted, model.families)) == [["de", "en"], ["es", "fr"]]
    got = lang_id.predict(docs.withColumn("score", F.lit("clash")), model).filter(out).select("lang", "lang_pred", "score").collect()
    assert len(got) > 100 and all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97


def test_prediction_reads_only_the_text(spark, docs):
    model = lang_id.train(read(spark, "/root/testdata/sf0.001", "documents"))
    a = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.predict(docs, model).collect()}
    other = docs.withColumns({"lang": F.lit("fr"), "source": F.lit(None).cast("string")}).repartition(5)
    assert {r.doc_id: (r.lang_pred, r.score) for r in lang_id.predict(other, model).collect()} == a
    assert a[100] == a[101] == a[102] == ("und", 0.0)
    assert {r.doc_id for r in lang_id.recognised(docs, model).collect()} == {d for d in a if a[d][0] != "und"}


def test_few_languages(spark, empty):
    none = lang_id.train(empty)
    assert none.predict(pa.array(["abc", None], pa.string())) == (["und", "und"], [0.0, 0.0])
    one = lang_id.train(spark.createDataFrame([("hello you", "en"), (None, "fr"), ("12 3", "de"), ("x", None)], "text string, lang string"))
    assert one.predict(pa.array(["bonjour", "12"], pa.string()))[0] == ["en", "und"]
    assert lang_id.predict(empty, one).count() == 0


def test_profiles_do_not_mix_texts():
    texts = ["Hello, World", "", None, "ÉTÉ été", "a", "12", "the the"]
    whole = lang_id.profiles(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], lang_id.profiles(pa.array([t], pa.string()))[0])
    w = np.random.default_rng(1).standard_normal((lang_id.DIM, 2))
    assert np.allclose(lang_id.margins(pa.array(texts, pa.string()), w, np.zeros(2)), whole @ w, atol=1e-4)


def test_sample_is_bounded(spark):
    rnd = random.Random(1)
    rows = [("".join(rnd.choice("abc ") for _ in range(30)), "x") for _ in range(300)] + [("zzz yyy " + str(i), "y") for i in range(10)] + [("same text", "x")] * 300
    df = spark.createDataFrame(rows, "text string, lang string")
    model = lang_id.train(df, per_language=50)
    assert model.predict(pa.array(["zzz yyy", "abc ab"], pa.string()))[0] == ["y", "x"]
    assert pytest.approx(1.0, abs=1.0) == model.predict(pa.array(["zzz yyy"], pa.string()))[1][0]


@pytest.mark.parametrize("copy", ["eins zwei drei vier", "das ist ein satz", "noch ein anderer text"])
def test_copies_do_not_fill_the_sample(spark, copy):
    """A text counts once, however often it is repeated: the other texts of its language are learned."""
    rnd = random.Random(2)
    de, en = "der die das und nicht auch wird sind".split(), "the and that with have this from they".split()
    rows = [(" ".join(rnd.choice(en) for _ in range(12)), "en") for _ in range(60)]
    rows += [(" ".join(rnd.choice(de) for _ in range(12)), "de") for _ in range(60)] + [(copy, "de")] * 5000
    model = lang_id.train(spark.createDataFrame(rows, "text string, lang string").repartition(4), per_language=40)
    assert model.predict(pa.array(["die und nicht auch wird", "that with have this"], pa.string()))[0] == ["de", "en"]
