"""Language identification: held-out accuracy, codes, odd inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowmill.llm import language
from rowmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    got = QUERIES["op4_language_id"](spark, SF).join(docs, "doc_id").where("held_out AND lang IS NOT NULL").toPandas()
    right = got.lang == got.lang_pred
    assert len(got) > 150 and right.mean() > 0.97
    assert got.score.between(0, 1).all()


@pytest.mark.parametrize("languages", [2, 3, 4, 7, 20, 40])
def test_codewords_are_apart(languages):
    code = language.codewords(languages)
    assert set(np.unique(code)) == {-1, 1} and len(np.unique(code, axis=0)) == languages
    assert (np.abs(code.sum(axis=0)) < languages).all()


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en", 0), (2, "der hund und die katze", "de", 0), (3, None, "en", 0), (4, "", None, 0), (5, "123 -- !", "de", 0), (None, "the", "en", 0), (1, "the cat and the dog", "en", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = language.fit(df, "doc_id", "text", "lang")
    assert model.languages == ["de", "en"]
    got = language.identify(df, model).collect()
    assert len(got) == len(rows)
    by = {r.id: r for r in got}
    assert by[1].lang_pred == "en" and by[2].lang_pred == "de" and by[None].lang_pred == "en"
    assert [(by[i].lang_pred, by[i].score) for i in (3, 4, 5)] == [("und", 0.0)] * 3


def test_nothing_or_one_language_learned(spark):
    df = spark.createDataFrame([(1, "abc def", "xx")], "doc_id long, text string, lang string")
    empty = language.fit(df.where("false"), "doc_id", "text", "lang")
    assert language.identify(df, empty).first().lang_pred == "und"
    one = language.fit(df, "doc_id", "text", "lang")
    row = language.identify(df, one).first()
    assert row.lang_pred == "xx" and row.score == 1.0
    assert language.identify(df.where("false"), one).count() == 0


def test_counts_do_not_cross_texts():
    together = language._counts(["ab", None, "ba"])
    assert (together[0] == language._counts(["ab"])[0]).all() and not together[1].any()
