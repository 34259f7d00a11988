"""The language stage drops only what has no language."""

import corpus_pipeline

TEXTS = {
    "en": "the children watch the quick brown fox from the window this morning",
    "fr": "les enfants qui jouent près de la rivière dans la maison ce matin",
    "de": "die kinder spielen heute morgen am fluss vor dem alten haus zusammen",
    "es": "los niños juegan cerca del río en la casa vieja esta mañana juntos",
}


def test_mixed_and_short_documents_stay(spark):
    rows = [(10 * i + n, text, lang) for n, (lang, text) in enumerate(TEXTS.items()) for i in range(20)]
    mixed = " ".join(TEXTS.values())
    rows += [(900, mixed, "en"), (901, "De.", "en"), (902, "a", None), (903, "12 !!", "en"), (904, "", None), (905, None, "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.language(spark, docs, "").collect()
    assert sorted(map(tuple, kept)) == sorted(r for r in rows if r[0] not in (903, 904, 905))
