"""A stream gives what the batch gives."""

from pyspark.sql import functions as F

from sievemark import screen
from sievemark.operators import report
from sievemark.packs.neutral import NEUTRAL
from sievemark.sources import sinks
from sievemark.sources.lines import read_lines, stream_lines
from sievemark.streaming.screening import running_counters, screen_to_table


def test_stream_equals_batch_and_resumes(spark, documents, tmp_path):
    source, table, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    part = documents.select("doc_id", "text")
    fields = {"doc_id": "long"}

    def arrive(df):
        df.repartition(3).write.mode("append").json(source)
        stream = stream_lines(spark, source, fields, glob="*.json", max_files_per_trigger=2).documents
        screen_to_table(stream, NEUTRAL, table, progress).awaitTermination()

    arrive(part.where("doc_id < 100"))
    arrive(part.where("doc_id >= 100"))
    batch = screen(read_lines(spark, source, fields, number=False).documents, NEUTRAL)
    streamed = spark.read.schema(batch.schema).parquet(table)
    shape = ["doc_id", "text", F.to_json("explicit"), F.to_json("sensitive"), "keep"]
    assert streamed.select(shape).exceptAll(batch.select(shape)).count() == 0
    assert batch.select(shape).exceptAll(streamed.select(shape)).count() == 0


def test_running_counters(spark, documents, tmp_path):
    source = str(tmp_path / "in")
    sinks.write_jsonl(documents.select("doc_id", "text").repartition(3), source)
    stream = stream_lines(spark, source, max_files_per_trigger=1).documents
    query = (
        running_counters(screen(stream, NEUTRAL), NEUTRAL)
        .writeStream.format("memory")
        .queryName("counters")
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    expected = report.issue_summary(screen(documents, NEUTRAL), NEUTRAL).first().asDict()
    assert spark.table("counters").first().asDict() == {"total_processed": 200, **expected}
