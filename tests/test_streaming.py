"""The click filter is a plain projection + filter, so it runs on a stream unchanged."""

import os
import tempfile

from lodestar.operators import article_clicks


def test_article_clicks_on_a_stream(spark):
    folder = tempfile.mkdtemp(prefix="lodestar-stream-")
    rows = [("u1", "a1", "20240105", "AppClick", "内容详情页"),
            ("u2", "", "20240105", "AppClick", "内容详情页"),
            ("u3", "a2", "20240201", "AppClick", "内容详情页")]
    batch = spark.createDataFrame(rows, "distinct_id string, article_id string, logday string, "
                                        "event string, element_page string")
    batch.write.mode("overwrite").parquet(os.path.join(folder, "in"))
    stream = spark.readStream.schema(batch.schema).parquet(os.path.join(folder, "in"))
    q = (article_clicks(stream, "20240101", "20240131").writeStream.format("memory")
         .queryName("clicks_out").outputMode("append")
         .option("checkpointLocation", os.path.join(folder, "ckpt")).start())
    try:
        q.processAllAvailable()
        got = [(r.uid, r.article_id) for r in spark.sql("SELECT * FROM clicks_out").collect()]
    finally:
        q.stop()
    assert got == [("u1", "a1")]
