import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import subjects as S
from strandline.sources.tables import table

ROOT = "/root/testdata/sf0.01"


SUBJECTS = "subject string, description string"


def listed(spark):
    return spark.createDataFrame([(s, None) for s in S.INSPECTED["en"]], SUBJECTS)


def test_text_handling():
    assert S.normalized("Großbrand <b>im</b>​ Depot") == "grossbrand  im  depot"
    assert S.normalized("a <" + "x" * 5000 + "> b") == "a   b"
    assert S.normalized("[17:11] qa_lead: Hail\n[9:02] ops: fell [a]: b").split() == ["hail", "fell", "[a]:", "b"]
    assert S.normalized('{"k4": null, "k": 3.5e1, "a": "hail", "b": true}').split() == ["{", ",", ",", '"a":', '"hail",', "}"]
    assert S.terms("a hail-storm in 津波注意報") == ["hail", "storm", "津波", "波注", "注意", "意報"]
    assert [S.language_group(t) for t in ("the ship was late", "der hafen und die werft", "el puerto y los barcos de la costa", "港が閉鎖された", "")] == ["en", "de", "es", "ja", "en"]


def test_every_subject_is_named_in_every_language():
    assert all(set(S.INSPECTED[g]) == set(S.INSPECTED["en"]) and all(len(words.split()) >= 5 for words in S.INSPECTED[g].values()) for g in S.LANGUAGES)
    # a subject that hasn't been inspected is named by its description
    assert S.naming_terms([("fire", "x"), ("space", "Rockets, satellites")], "en") == {"fire": S.INSPECTED["en"]["fire"].split(), "space": ["rockets", "satellites"]}
    assert S.naming_terms([("space", None)], "de") == {"space": []}


def test_digamma():
    x = np.array([0.01, 0.05, 0.7, 1.0, 3.3, 6.0, 50.0, 1e6])
    h = 1e-4 * x
    slope = [(math.lgamma(a + d) - math.lgamma(a - d)) / (2 * d) for a, d in zip(x, h, strict=True)]
    assert np.allclose(S.digamma(x), slope, rtol=1e-5, atol=1e-5)


def test_proportions_of_documents():
    weights = np.array([[0.5, 0.0], [0.5, 0.0], [0.0, 0.5], [0.0, 0.5]]) + 1e-6
    counts = [(np.array([0, 1]), np.array([5, 5])), (np.array([0, 2, 3]), np.array([8, 1, 1])), (np.array([2]), np.array([1]))]
    mean, owned = S.proportions(counts, weights, 0.05)
    assert np.allclose(mean.sum(axis=1), 1) and np.allclose(mean[:, 0], [10.05 / 10.1, 8.05 / 10.1, 0.05 / 1.1], atol=1e-3)
    assert owned.tolist() == [[2, 0], [1, 2], [0, 1]]
    # each document is inferred by itself, whatever stands beside it
    assert np.allclose(S.proportions(counts[1:2], weights, 0.05)[0], mean[1:2], atol=1e-3)


def test_fragments_are_left_out():
    weights = np.array([[500.0, 0.5, 0.1, 1.0], [500.0, 0.5, 0.1, 1.0]])
    assert S.kept_topics(weights, np.array([0, 0, 1, -1]), 0.002).tolist() == [0, 2]
    # large enough, but made of a subject's terms; one of terms of its own stays
    weights = np.array([[500.0, 90.0, 0.1], [500.0, 90.0, 0.1], [0.1, 20.0, 100.0]])
    assert S.kept_topics(weights, np.array([0, -1, -1]), 0.002).tolist() == [0, 2]


def test_topics_go_to_the_subject_their_terms_name():
    weights = np.array([[9.0, 0.1], [9.0, 0.1], [8.0, 0.1], [0.1, 5.0]])
    subject_of, fault = S.topic_subjects(weights, [[0], [1, 2], [3], []])
    # subject 0 has no topic of its own, and shares the first one, which holds 26 of 31.4
    assert subject_of.tolist() == [1, 2] and abs(fault - 1 - 26.1 / 31.4) < 0.01
    assert S.topic_subjects(weights, [[], [1, 2], [3], []])[1] == 0


def test_assignment(spark):
    words = ["storm", "flood", "vessel", "quay"]
    model = S.TopicModel({w: i for i, w in enumerate(words)}, np.array([[0.5, 0, 0.0], [0.5, 0, 0], [0, 0.5, 0], [0, 0.5, 0]]) + 1e-6, np.array([0, 1, -1]))
    rows = [(1, "en", "storm flood storm flood"), (2, "en", "storm flood vessel quay"), (3, "en", "storm other words"), (4, "en", "nothing"), (1, "en", "storm flood"), (5, "de", "storm flood"), (6, "en", "storm flood " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id long, group string, terms string").withColumn("subject", F.lit("clash")).withColumn("share", F.lit("clash"))
    got = sorted((r.doc_id, r.subject, round(r.share, 1)) for r in S.assign_subjects(df, {"en": model}, ["weather", "shipping"]).collect())
    # one term alone is no subject (3), nor is a document without a term or a model (4, 5)
    assert got == [(1, "weather", 1.0), (1, "weather", 1.0), (2, "shipping", 0.5), (2, "weather", 0.5), (6, "weather", 1.0)]


def test_empty_corpus(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.document_subjects(none, listed(spark)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "12"), (3, ""), (4, " ")], "doc_id long, text string")
    assert S.document_subjects(blank, listed(spark)).count() == 0
    assert S.document_subjects(spark.createDataFrame([(1, "flames scorched the depot")], "doc_id long, text string"), listed(spark).limit(0)).count() == 0


def test_a_language_with_one_document_has_a_model(spark):
    text = "La huelga entra en su día. El comité votó paro. Los estibadores votó huelga salarial con los horarios del comité."
    docs = spark.createDataFrame([(1, text, "x")], "doc_id long, text string, group string")
    assert [(r.doc_id, r.subject) for r in S.document_subjects(docs, listed(spark)).collect()] == [(1, "labour")]


@pytest.mark.skipif(not os.path.exists(ROOT), reason="no test data")
def test_accuracy_on_labels(spark):
    found = {}
    for r in S.document_subjects(table(spark, ROOT, "documents"), table(spark, ROOT, "subjects")).collect():
        found.setdefault(r.doc_id, set()).add(r.subject)
    labels = {}
    for r in table(spark, ROOT, "labels").collect():
        labels.setdefault(r.doc_id, set()).add(r.subject)
    hit = sum(len(v & found.get(d, set())) for d, v in labels.items())
    assert hit / sum(map(len, labels.values())) > 0.85
    assert hit / sum(len(found.get(d, set())) for d in labels) > 0.85


@pytest.mark.skipif(not os.path.exists(ROOT), reason="no test data")
@pytest.mark.parametrize("lang", ["en", "de"])
def test_a_text_copied_to_a_third_of_the_rows_keeps_its_subject(spark, lang):
    docs = table(spark, ROOT, "documents").select("doc_id", "lang", "text")
    labels = table(spark, ROOT, "labels").groupBy("doc_id").agg(F.collect_set("subject").alias("s"), F.countDistinct("annotator").alias("n"))
    one = docs.where(F.col("lang") == lang).join(labels, "doc_id").where("size(s) = 1").orderBy(F.col("n").desc(), F.length("text").desc(), "doc_id").first()
    copies = spark.range(docs.count() // 2).select((F.col("id") + 10**9).alias("doc_id"), F.lit(one.text).alias("text"))
    found = S.document_subjects(docs.select("doc_id", "text").unionByName(copies), table(spark, ROOT, "subjects")).where(F.col("doc_id") >= 10**9)
    assert {(r.subject, r["count"]) for r in found.groupBy("subject").count().collect()} == {(one.s[0], docs.count() // 2)}


def test_a_model_passes_over_its_texts_equally_often_at_every_size(spark, monkeypatch):
    seen, original = [], S.LDA
    monkeypatch.setattr(S, "LDA", lambda **k: seen.append(k["maxIter"] * k["subsamplingRate"]) or original(**k | {"maxIter": 1}))
    vocabulary = S.CountVectorizerModel.from_vocabulary(["storm", "vessel"], inputCol="terms", outputCol="features")
    for n in (40, 50_000):
        rows = vocabulary.transform(spark.range(n).select(F.array(F.lit("storm"), F.lit("vessel")).alias("terms")))
        S._topics(rows.select("features"), 2, S.Settings(), 1)
    assert seen[0] == seen[1] >= 5
