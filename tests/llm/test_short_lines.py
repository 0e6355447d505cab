import re

import corpus_pipeline
from cinelake.llm import line_dedup, queries


def brute(rows):
    """Line numbers to drop of every id; no two different lines here are near each other."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        out[doc_id] = []
        for number, line in enumerate((text or "").split("\n") if text is not None else []):
            if line in seen and (len(line) >= 20 or re.search(r"\S", line)):
                out[doc_id].append(number)
            seen.add(line)
    return out


def test_exact_repeats_of_short_lines_go(spark, tmp_path):
    rows = [
        (1, "Heading\na line that is quite long enough\n\n  \nThe end"), (2, "Heading\na line that is quite long enough\n\nThe end"),
        (3, "Headings\n\n \nthe end\n}"), (4, "}\n}\n日\n"), (5, None), (6, ""), (7, "\n\n  \n"), (8, "日\nThe end!"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows)
    assert expected[2] == [0, 1, 3] and expected[4] == [0, 1] and expected[8] == [0]
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.dropped for r in queries.lines(spark, str(tmp_path)).collect()}
    assert got == expected
    kept = {r.doc_id: r.text for r in corpus_pipeline.without_repeated_lines(spark, df, str(tmp_path)).collect()}
    assert kept == {
        doc_id: text if not expected[doc_id] else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in expected[doc_id])
        for doc_id, text in rows if doc_id != 2
    }
    assert line_dedup.report(df).where("doc_id = 4").first().dropped == []
