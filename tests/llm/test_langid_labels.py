"""A language of one document in thousands is learned, too."""

from pyspark.sql import functions as F

from cairn.llm.bigru_langid import fit, identify


def test_rare_language_is_learned(spark):
    common = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the cat sat on the mat and the dog "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    rare = spark.createDataFrame([(5000, "жили были дед и баба и была у них курочка ряба", "ru"), (5000, "снесла курочка яичко не простое", "ru"),
                                  (5001, "123 !!!", "none"), (5002, None, "null")], "doc_id long, text string, lang string")
    net = fit(common.unionByName(rare), sample_docs=200, updates=60)
    assert net.labels == ["en", "ru"]
    got = identify(spark.createDataFrame([(1, "дед и баба"), (2, "the dog and the cat")], "doc_id long, text string"), net).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got] == ["ru", "en"]
    assert fit(rare.filter("doc_id = 5001")) is None


def test_label_whose_rows_share_one_id_is_learned(spark):
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("und so weiter "), (F.col("id") % 3).cast("string")).alias("text"), F.lit("de").alias("lang"))
    assert fit(docs, sample_docs=20, updates=1).labels == ["de"]
