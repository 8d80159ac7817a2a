"""The language stage acts on the classifier's verdict: against the model applied to one text at a time."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from quaymart.llm import lang_id
from quaymart.llm.common import read

FOREIGN = ["Это русский текст о погоде и людях, которые живут в большом городе у реки.", "今天天气很好，我们去公园散步吧。",
           "xq zzkw vvptr qqj wxk zzt", "مرحبا بالعالم"]


def test_verdict_takes_effect(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    no, wrong = F.col("doc_id") % 50 == 1, F.col("doc_id") % 50 == 2
    odd = docs.withColumn("lang", F.when(wrong, "fr").when(~no, F.col("lang")))
    extra = spark.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(FOREIGN)], odd.schema)
    odd = odd.unionByName(extra)
    got = {r.doc_id: r for r in corpus_pipeline.language_stage(spark, odd, "").collect()}
    model = lang_id.train(odd)
    for r in odd.collect():
        text = pa.array([r.text])
        known = any(c.isalpha() for c in r.text) and float((lang_id.profiles(text)[0].astype(float) @ model.likely).max()) >= lang_id.FOREIGN
        assert (r.doc_id in got) == known == (r.doc_id >= 0)
        if known:
            assert got[r.doc_id].lang == model.predict(text)[0][0] and got[r.doc_id].text == r.text
    truth = {r.doc_id: r.lang for r in docs.collect()}
    touched = [d for d in truth if d % 50 in (1, 2)]
    assert touched and np.mean([got[d].lang == truth[d] for d in touched]) > 0.97
