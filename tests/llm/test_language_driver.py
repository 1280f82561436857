"""What language training brings to the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from basketry.llm import language


def test_language_training_sends_packed_counts_to_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    texts = [("guten tag die welt", "de"), ("good day to the world", "en"), (None, "en"), ("12 34", "de")] * 40
    labelled = spark.createDataFrame([(i, f"{text} {i}" if text else text, lang) for i, (text, lang) in enumerate(texts)], "doc_id long, text string, lang string")
    came, samples = [], []
    whole, fit = DataFrame.toArrow, language.fit
    monkeypatch.setattr(DataFrame, "toArrow", lambda frame: came.append(whole(frame)) or came[-1])
    monkeypatch.setattr(language, "fit", lambda rows: samples.extend(rows) or fit(rows))
    model = language.train(labelled)
    # Plain, a subword takes eight bytes.
    assert 0 < came[0].nbytes < 5 * sum(len(bag) for bag, _, _ in samples)
    named = {r.text: r.lang_pred for r in language.identify(labelled, model, carry=["text"]).where("text is not null").collect()}
    assert named["guten tag die welt 0"] == "de" and named["good day to the world 1"] == "en"
    for nothing in (labelled.limit(0), labelled.where("text is null"), labelled.withColumn("lang", F.lit(None).cast("string"))):
        assert language.train(nothing).languages == []
    assert language.train(labelled.where("text rlike '^12'")).languages == []


def test_packed_counts_come_back():
    for bag, count in (([], []), ([0], [1]), ([3, 4, 32767], [1, 70000, 2**31 - 1])):
        back = language._unpacked(language._packed(np.array(bag, np.int32), np.array(count)))
        assert [x.tolist() for x in back] == [bag, count] and {x.dtype for x in back} == {np.dtype(np.int32)}
