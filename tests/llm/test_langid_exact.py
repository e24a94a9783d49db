"""Grams beyond what is sent to every task."""
import pytest
from pyspark.sql import functions as F

from chargelens.llm import langid


def test_more_grams_than_are_sent_give_the_same_rows(spark):
    words = {"en": "the quick brown fox jumps over a lazy dog", "de": "der schnelle braune fuchs springt ueber den faulen hund"}
    rows = [(i, f"{words[k]} {i % 7} {words[k][i % 11:]}", k) for i in range(120) for k in words] + [(900, None, "en"), (901, "42", None), (902, "zzz qqq ψωξ", None), (903, "", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    sent, shuffled = ({(r.doc_id, r.lang_pred): (r.score, r.entropy, r.refused) for r in langid.identify(docs, F.col("doc_id") % 3 != 0, most_grams=n).collect()} for n in (langid.MODEL_GRAMS, 10))
    assert sent.keys() == shuffled.keys() and len(sent) == 244
    for k, (score, entropy, refused) in sent.items():
        assert shuffled[k][0] == pytest.approx(score) and shuffled[k][1] == (None if entropy is None else pytest.approx(entropy)) and shuffled[k][2] == refused
