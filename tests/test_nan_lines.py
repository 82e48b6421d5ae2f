"""Lines with many NaN members are read in linear time, strings left alone."""

import json
import time

from sievemark.sources.lines import documents_from_lines


def test_nan_members_linear_and_outside_strings(spark):
    n = 200_000
    members = ", ".join(f'"k{i}": NaN' for i in range(n))
    line = '{"text": "keep NaN and \\"Infinity\\" here", ' + members + ', "x": -Infinity}'
    rows = [(line,), ('{"text": "a", "v": NaN}',), ('{"text": "NaN", "w": "b\\\\"}',), ('{"text": "open NaN',)]
    df = spark.createDataFrame(rows, "value string")
    documents_from_lines(df.limit(1)).count()
    started = time.monotonic()
    got = documents_from_lines(df).select("text", "__reason").collect()
    assert time.monotonic() - started < 5
    assert got[0].text == 'keep NaN and "Infinity" here' and got[0]["__reason"] is None
    assert got[1].text == "a" and got[2].text == "NaN"
    assert got[3].text == '{"text": "open NaN'  # a broken line stays whole
    assert json.loads('{"text": "NaN", "w": "b\\\\"}')["text"] == "NaN"
