"""A tie of scores decides as documented, in the query and in its SQL."""

import duckdb
import pandas as pd

from sievemark.plans import oracles, queries


def test_model_scores_tie_equals_its_sql(spark, tmp_path):
    texts = ["x" * n for n in (49, 50, 51, 150)]
    frame = pd.DataFrame(
        {"doc_id": range(4), "text": texts, "lang": "en", "source": "s", "n_chars": [len(t) for t in texts]}
    )
    frame.to_parquet(tmp_path / "documents.parquet")
    got = {r.doc_id: r.ml_label for r in queries.model_scores(spark, str(tmp_path)).collect()}
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    sql = connection.execute(oracles.oracle_sql()["model_scores"]).df()
    expected = dict(zip(sql["doc_id"], sql["ml_label"]))
    # 50 characters: toxic 0.5 against neutral 0.5, the last label by code point.
    assert got == expected and got[1] == "TOXIC" and got[0] == "NEUTRAL"
