"""Held-out accuracy, fairness and defined cases of the two classifiers."""

import zlib

import numpy as np
import pytest

pytest.importorskip("folioforge.llm.queries")

from pyspark.sql import functions as F  # noqa: E402

from folioforge.llm import common, quality, toxicity  # noqa: E402

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("module,column,least", [(toxicity, "toxic", 0.97), (quality, "quality", 0.95)])
def test_held_out_accuracy(spark, module, column, least):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    labelled = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    got = module.classify(labelled, labels).join(labels, "doc_id").where("held_out").select("doc_id", "predicted", column, "score").toPandas()
    assert all(zlib.crc32(str(d).encode()) % 5 == 0 for d in got["doc_id"])
    assert ((got["score"] >= 0) & (got["score"] <= 1)).all()
    right = got["predicted"] == got[column]
    assert right.mean() >= least, right.mean()
    # Recall and precision of label 1.
    assert right[got[column] == 1].mean() >= 0.9 and right[got["predicted"] == 1].mean() >= 0.9


def test_training_sample_is_bounded(spark):
    """One row an id, so many ids, so many bytes; the same rows whatever else the table holds."""
    rows = [(i, f"text {i} " + "x" * 100) for i in range(200)] + [(3, "text 3 " + "y" * 50)] * 3 + [(7, f"other {i}") for i in range(500)] + [(None, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in [*range(200), 3, 3]] + [(None, 1)], "doc_id bigint, toxic int")
    taken = lambda *a, **k: (rows := common.labelled_sample(docs.repartition(5), labels, *a, **k)).mapInArrow(common.first_of_each, rows.schema).collect()
    every = taken("toxic", 1_000)
    assert len(every) == len({r["id"] for r in every}) and {3, 7} - {i for i in (3, 7) if zlib.crc32(str(i).encode()) % 5 == 0} <= {r["id"] for r in every}
    assert all(zlib.crc32(str(r["id"]).encode()) % 5 for r in every)
    ten = taken("toxic", 10)
    assert len(ten) == 10 and {tuple(r) for r in ten} <= {tuple(r) for r in every}
    few = taken("toxic", 1_000, most_bytes=1_000)
    assert 5 <= len(few) <= 20 and sum(len(r["text"]) for r in few) <= 1_000 and {tuple(r) for r in few} <= {tuple(r) for r in every}


def test_a_shared_folder_is_asked_for_on_a_cluster():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session)


@pytest.mark.parametrize("module,column", [(toxicity, "toxic"), (quality, "quality")])
def test_defined_cases(spark, module, column):
    rows = [(1, None), (2, ""), (3, "Some words here."), (3, "Some words here."), (None, "x y"), (6, "long " * 5000), (7, "ÄÖ"), (8, "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("label", F.lit("x")).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, 0), (6, 0), (7, None), (None, 1), (8, 0), (99, 1)], f"doc_id bigint, {column} int")
    for some in (labels, labels.limit(0)):
        got = module.classify(docs, some).toPandas()
        assert len(got) == len(rows) and got["score"].between(0, 1).all() and got["predicted"].isin([0, 1]).all()
        assert got[got["doc_id"] == 3]["score"].nunique() == 1
        assert got[got["doc_id"].isna()]["held_out"].isna().all()
    assert module.classify(docs.limit(0), labels).count() == 0


def test_scores_do_not_depend_on_other_columns(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} text", "en" if i % 2 else "de") for i in range(60)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, i % 7 == 0 and 1 or 0) for i in range(60)], "doc_id bigint, toxic int")
    one = toxicity.classify(docs, labels).toPandas().sort_values("doc_id")
    two = toxicity.classify(docs.withColumn("lang", F.lit(None)), labels).toPandas().sort_values("doc_id")
    assert np.array_equal(one["score"], two["score"])


def test_counterfactual_penalty_lowers_identity_weights():
    """Labels that go with one group's name: without the penalty a neutral mention scores high."""
    texts, labels = [], []
    for i in range(200):
        texts.append(f"the muslim people walk in town {i % 9} and talk." if i % 2 else f"the jewish people walk in town {i % 9} and talk.")
        labels.append(i % 2 if i % 5 else 0)
    neutral = ["a muslim baker.", "a jewish baker."]
    gap = lambda m: abs(np.subtract(*m.score_texts(neutral)))
    plain, fair = (toxicity.fit(texts, np.array(labels), fairness=f) for f in (0.0, 10.0))
    assert gap(fair) < 0.25 * gap(plain)


def test_quality_attention_is_a_distribution():
    per_doc, x = quality.passages(*__import__("folioforge.llm.textkernel", fromlist=["utf8"]).utf8(__import__("pyarrow").array(["a b " * 300, "", "c"])))
    model = quality.fit(x, per_doc, np.array([1, 0, 0]))
    a = model.forward((x - model.centre) / model.scale, per_doc)["a"]
    assert per_doc.tolist() == [6, 1, 1] and np.allclose(np.add.reduceat(a, [0, 6, 7]), 1)
