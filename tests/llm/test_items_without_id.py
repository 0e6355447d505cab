import hashlib

from cinelake.llm import decontaminate


def test_items_without_id_hit_but_are_not_named(spark):
    benchmark = spark.createDataFrame([(None, "one two three"), ("b", "four five six"), (None, None)], "item_id string, text string")
    docs = spark.createDataFrame([(1, "x one two three y"), (2, "four five six z"), (3, "none")], "doc_id long, text string")
    for part_bytes in (1 << 20, 8):
        out = {r.doc_id: r for r in decontaminate.scan(docs, benchmark, ["doc_id"], width=3, part_bytes=part_bytes).collect()}
        assert [(out[i].n_hit, out[i].n_items, out[i].contaminated) for i in (1, 2, 3)] == [(3, 0, True), (3, 1, True), (0, 0, False)]
        assert out[1].items_sha256 == hashlib.sha256(b"").hexdigest()
