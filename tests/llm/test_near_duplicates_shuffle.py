"""Bytes that the near-duplicate join moves, by the event log of a session of its own."""

import json
import subprocess
import sys
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from cinelake.llm.common import may_be_among

_RUN = """
import sys
import numpy as np
from cinelake.llm.near_duplicates import near_duplicates
from cinelake.session import build_session
spark = build_session("moved", "local[2]", **{
    "spark.sql.shuffle.partitions": "2", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.driver.host": "127.0.0.1",
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + sys.argv[1], "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false", "spark.checkpoint.dir": "file://" + sys.argv[2],
})
words = np.random.default_rng(3).integers(1 << 60, size=(200, 3000))
texts = [" ".join(map("{:x}".format, row.tolist())) for row in words]
rows = [(n, text) for n, text in enumerate([*texts, texts[7] + " tail"])]
found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
assert {r.doc_id for r in found.where("NOT kept").collect()} == {200}
spark.stop()
"""


def test_texts_without_candidates_are_not_shuffled(tmp_path):
    for name in ("events", "stored"):
        (tmp_path / name).mkdir()
    root = Path(__file__).resolve().parents[2]
    subprocess.run([sys.executable, "-c", _RUN, str(tmp_path / "events"), str(tmp_path / "stored")], cwd=root, check=True, timeout=300)
    written = 0
    for log in (tmp_path / "events").iterdir():
        for line in log.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                written += event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    assert written < 200 * 3000 * 15 / 8  # an eighth of the texts, briefs and sketches included


def test_filter_loses_no_key(spark):
    rows = spark.range(20_000).select(F.col("id").cast("string").cast("binary").alias("key"))
    keys = rows.where("CAST(CAST(key AS STRING) AS INT) % 50 = 0")
    for words in (None, 1):
        passed = may_be_among(rows, keys.union(keys), "key", words)
        assert passed.join(keys, "key").count() == 400 and passed.count() == passed.distinct().count()
    assert may_be_among(rows, keys, "key").count() < 600
    assert may_be_among(rows, keys.limit(0), "key").count() == 0


def test_nodes_of_equal_classes_are_compared_once(spark, monkeypatch):
    from cinelake.llm import near_duplicates

    asked = []
    kept = near_duplicates.materialize

    def stored(df, label="stage"):
        out = kept(df, label)
        if label == "small":
            asked.append((out.count(), out.select("node").distinct().count()))
        return out

    monkeypatch.setattr(near_duplicates, "materialize", stored)
    words = np.random.default_rng(4).integers(1 << 60, size=400).astype(str).tolist()
    rows = [(0, " ".join(words)), (1, " ".join([*words, "end"])), (2, "another text of a few words")]
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {0: 0, 1: 0, 2: 2}
    assert asked == [(2, 1)]
