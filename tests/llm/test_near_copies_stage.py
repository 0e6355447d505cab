import corpus_pipeline


def test_rows_go_by_id_and_text(spark):
    words = [[f"{chr(97 + k)}{n}" for n in range(60)] for k in range(6)]
    a, b, c, d, e, f = [" ".join(w) for w in words]
    rows = [
        (1, a, "k"), (2, a, "gone"), (2, b, "k"), (3, c, "k"), (3, d, "k"), (3, d, "k"),
        (None, a, "gone"), (None, e, "k"), (None, e, "k"), (None, f"{f} x", "k or gone"), (None, f, "k or gone"),
        (4, None, "k"), (5, "", "k"), (None, None, "k"), (None, "", "k"), (None, "", "k"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [(r.doc_id, r.text) for r in corpus_pipeline.without_near_copies(spark, df, "").collect()]
    expected = [(1, a), (2, b), (3, c), (3, d), (None, e), (4, None), (5, ""), (None, None), (None, ""), (None, "")]
    rest = [x for x in out if x[1] not in (f, f"{f} x")]
    assert len(out) == len(rest) + 1
    key = lambda x: (str(x[0]), str(x[1]))
    assert sorted(rest, key=key) == sorted(expected, key=key)
