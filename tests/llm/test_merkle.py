"""The Merkle manifest against a plain tree, built in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sievemark.llm import merkle
from sievemark.llm.queries import op11_merkle_manifest

SF = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _leaf(row):
    return _h("".join(_field(row[f]) for f in FIELDS))


def _tree(digests, fan):
    """Levels of a tree over digests in order; the last level holds one digest."""
    levels = [list(digests)]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_h("".join(below[i : i + fan])) for i in range(0, len(below), fan)])
    return levels


def _siblings(levels, index, fan):
    out = []
    for level in levels[:-1]:
        start = index - index % fan
        out.append((level[start:index], level[index + 1 : start + fan]))
        index //= fan
    return out


def _fold(digest, siblings):
    for left, right in siblings:
        digest = _h("".join(left) + digest + "".join(right))
    return digest


def plain(rows, fan, tamper):
    """doc_id -> (leaf, subroot, root, proof, folded, verified)."""
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append((row, _leaf(row)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees, order = {}, {}
    for name in names:
        members = sorted(groups[name], key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        order[name] = members
        trees[name] = _tree([d for _, d in members], fan)
    top = _tree([trees[n][-1][0] for n in names], fan)
    out = []
    for g, name in enumerate(names):
        for i, (row, digest) in enumerate(order[name]):
            siblings = _siblings(trees[name], i, fan) + _siblings(top, g, fan)
            proof = _h("".join("".join(l) + "".join(r) for l, r in siblings))
            checked = _leaf(tamper(row))
            folded = _fold(checked, siblings)
            out.append((row["doc_id"], digest, trees[name][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def _lowered(row):
    if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and row["text"] is not None:
        return {**row, "text": "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row["text"])}
    return row


def _run(spark, rows, fan, schema="doc_id long, source string, lang string, n_chars long, text string"):
    df = spark.createDataFrame(rows, schema)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    text = F.when(tampered, F.translate("text", upper, lower)).otherwise(F.col("text"))
    checked = [text if f == "text" else F.col(f) for f in FIELDS]
    found = merkle.manifest(
        df, F.col("source"), F.col("doc_id"), merkle.leaf([F.col(f) for f in FIELDS]), merkle.leaf(checked), fan=fan
    )
    got = found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted((tuple(r) for r in got), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def _rows(n, sources, seed=0):
    rows = []
    for i in range(n):
        rows.append(
            {
                "doc_id": i,
                "source": sources[(i * 7 + seed) % len(sources)],
                "lang": "en" if i % 3 else None,
                "n_chars": i * 11,
                "text": None if i % 13 == 5 else f"Text Number {i} With CAPS" + "x" * (i % 4),
            }
        )
    return rows


@pytest.mark.parametrize("fan,n", [(2, 37), (3, 50), (16, 300)])
def test_manifest_equals_a_plain_tree(spark, fan, n):
    rows = _rows(n, ["b", "a", None, "é", "ab"])
    assert _run(spark, rows, fan) == plain(rows, fan, _lowered)


def test_one_row_one_group_and_empty_table(spark):
    one = [{"doc_id": 7, "source": "s", "lang": None, "n_chars": None, "text": ""}]
    got = _run(spark, one, 16)
    leaf = _leaf(one[0])
    assert got == [(7, leaf, leaf, leaf, _h(""), leaf, True)]
    assert _run(spark, [], 16) == []


def test_ties_nulls_repeated_rows_and_long_texts(spark):
    rows = _rows(40, ["x", None])
    rows += [dict(rows[3]), dict(rows[3]), {**rows[4], "doc_id": None}, {**rows[5], "doc_id": None, "text": "A" * 300_000}]
    assert _run(spark, rows, 4) == plain(rows, 4, _lowered)


def test_clashing_columns_pass_through(spark):
    rows = [{**r, "root": "mine"} for r in _rows(20, ["a"])]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, root string")
    found = merkle.manifest(df, F.col("source"), F.col("doc_id"), merkle.leaf([F.col(f) for f in FIELDS]), fan=3)
    assert found.where(~F.col("verified")).count() == 0
    assert found.select("root").distinct().count() == 1 and found.first().root != "mine"


def test_query_equals_a_plain_tree_on_documents(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in op11_merkle_manifest(spark, SF).collect())
    assert got == sorted(plain(docs, 16, _lowered))
    assert 0 < sum(not r[6] for r in got) < len(got)
