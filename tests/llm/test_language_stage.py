from assaysift.llm import language


def test_unlabelled_texts_stay(spark):
    rows = [(1, "some clean text"), (2, "12 ** 3"), (3, None), (4, ""), (5, "été")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "cast(null as string) as lang")
    kept = language.keep_languages(df, language.fit(df))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {1, 5}
    assert language.keep_languages(df, language.fit(df), languages=("en",)).count() == 0
