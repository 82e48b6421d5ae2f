"""Line files, numbering, named corpora, rule files, output names."""

import json

import pytest
from pyspark.sql import functions as F

from sievemark.functions.text import WHITESPACE
from sievemark.packs import RulePack
from sievemark.sources import sinks
from sievemark.sources.corpus import read_corpus
from sievemark.session import setting, shared_dir
from sievemark.sources.lines import UPLOAD_ENDINGS, read_lines
from sievemark.sources.rules import RuleFile, check_rules, load_rules, load_three_category_pack, read_rule_lines

REJECTED = object()

# line → text, or REJECTED
JSON_CASES = [
    ('{"text": "plain"}', "plain"),
    ('  {"text": "padded"}\t', "padded"),
    ('{"text": " kept spaces "}', " kept spaces "),
    ('{"text": "é 漢 \\u00e9"}', "é 漢 é"),
    ('{"text": ""}', ""),
    ('{"text": null}', REJECTED),
    ('{"text": 5}', REJECTED),
    ('{"text": true}', REJECTED),
    ('{"text": ["a"]}', REJECTED),
    ('{"text": {"a": 1}}', REJECTED),
    ('{"other": 1}', '{"other": 1}'),
    ('{"text": "cut', '{"text": "cut'),
    ('{"text": "a"} junk', '{"text": "a"} junk'),
    ('{"text": "a"}]', '{"text": "a"}]'),
    ('{"text": "a"}]}', '{"text": "a"}]}'),
    ('{"text": "a"}}', '{"text": "a"}}'),
    ('{"text": "a"},{"text": "b"}', '{"text": "a"},{"text": "b"}'),
    ('{"text": "a"} {"text": "b"}', '{"text": "a"} {"text": "b"}'),
    ('{"list": [{"b": 1}], "text": "nested"}', "nested"),
    ('{"list": [{"b": 1} ] , "text": "nested"}', "nested"),
    ("{'text': 'single'}", "{'text': 'single'}"),
    ('{"text": "first", "text": "last"}', "last"),
    ('{"text": "a",}', '{"text": "a",}'),
    ('{"text": "tab\there"}', '{"text": "tab\there"}'),
    ('{"a": NaN, "text": "n"}', "n"),
    ('{"text": "x: NaN, \\"y\\"", "v": [-Infinity, Infinity]}', 'x: NaN, "y"'),
    ('{"text": "NaN", "v": NaN}', "NaN"),
    ('{"text": NaN}', REJECTED),
    ('{"a": NaNx, "text": "n"}', '{"a": NaNx, "text": "n"}'),
    ('{"a": -NaN, "text": "n"}', '{"a": -NaN, "text": "n"}'),
    ("{}", "{}"),
    ("{", "{"),
    ('["text"]', '["text"]'),
    ("raw text", "raw text"),
    ("　 raw \xa0 x ", "raw \xa0 x"),
]


def test_json_cases(spark, tmp_path):
    path = tmp_path / "cases.jsonl"
    path.write_text("\n".join(line for line, _ in JSON_CASES) + "\n\n   \n\xa0\n", encoding="utf-8")
    lines = read_lines(spark, str(path))
    got = {r.line_no: r.text for r in lines.documents.collect()}
    rejected = {r.line_no: (r.line, r.reason) for r in lines.rejected.collect()}
    for i, (line, expected) in enumerate(JSON_CASES, 1):
        if expected is REJECTED:
            assert i not in got and rejected[i][0] == line and rejected[i][1].startswith("text is ")
        else:
            assert got[i] == expected, line
            # the expectation itself is what a strict JSON reader does
            stripped = line.strip()
            try:
                assert expected == json.loads(stripped).get("text", stripped)
            except (json.JSONDecodeError, AttributeError):
                assert expected == stripped
    assert len(got) + len(rejected) == len(JSON_CASES)
    assert {r.dataset_id for r in lines.documents.collect()} == {"cases.jsonl"}


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\r"])
def test_line_ends(spark, tmp_path, newline):
    (tmp_path / "ends.txt").write_bytes(newline.join(["one", "", "three"]).encode())
    rows = read_lines(spark, str(tmp_path / "ends.txt")).documents.collect()
    assert sorted((r.line_no, r.text) for r in rows) == [(1, "one"), (3, "three")]


def test_line_numbers_over_many_splits_and_files(spark, tmp_path):
    expected = set()
    for name, count in (("a.txt", 4000), ("b.jsonl", 37), ("c.json", 900), ("d.csv", 50)):
        lines = ["" if i % 7 == 0 else f"{name} line {i} " + "é" * (i % 23) for i in range(1, count + 1)]
        (tmp_path / name).write_text("\n".join(lines), encoding="utf-8")
        expected |= {(name, i, line.strip()) for i, line in enumerate(lines, 1) if line}
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        documents = read_lines(spark, str(tmp_path)).documents
        assert documents.rdd.getNumPartitions() > 10
        rows = documents.collect()
    finally:
        spark.conf.set(key, before)
    assert len(rows) == len(expected)
    assert {(r.dataset_id, r.line_no, r.text) for r in rows} == expected


def test_numbering_does_not_shuffle_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    plan = read_lines(spark, str(tmp_path)).documents._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning" not in plan


def test_extra_fields(spark, tmp_path):
    (tmp_path / "f.jsonl").write_text('{"text": "a", "url": "u", "n": 3}\nraw\n')
    rows = read_lines(spark, str(tmp_path), {"url": "string", "n": "long"}, number=False).documents.collect()
    assert sorted((r.text, r.url, r.n) for r in rows if r.n) == [("a", "u", 3)]
    assert [(r.url, r.n) for r in rows if r.text == "raw"] == [(None, None)]


def test_named_corpus(spark, tmp_path):
    rows = [("big", "ms", "train", t) for t in ("one", "", None, " two ")] + [("big", "ms", "test", "no")]
    rows += [("big", "en", "train", "no"), ("other", "ms", "train", "no")]
    df = spark.createDataFrame(rows, "dataset string, subset string, split string, text string")
    df.coalesce(1).write.partitionBy("dataset", "subset", "split").parquet(str(tmp_path / "c"))
    corpus = read_corpus(spark, str(tmp_path / "c"), "big", "ms")
    assert sorted(tuple(r) for r in corpus.collect()) == [("big/ms/train", 1, "one"), ("big/ms/train", 4, " two ")]
    assert all("/dataset=big/subset=ms/split=train/" in f for f in corpus.inputFiles())


def test_corpus_numbers_run_through_files(spark, tmp_path):
    df = spark.range(1000).select(
        F.lit("big").alias("dataset"), F.lit("ms").alias("subset"), F.lit("train").alias("split"),
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("text"),
    )
    df.repartition(5).write.partitionBy("dataset", "subset", "split").json(str(tmp_path / "c"))
    corpus = read_corpus(spark, str(tmp_path / "c"), "big", "ms", format="json").collect()
    numbers = {r.line_no for r in corpus}
    assert len(corpus) == len(numbers) == 666 and max(numbers) <= 1000


def test_rule_file(spark, tmp_path):
    path = tmp_path / "rules.txt"
    path.write_text(
        "# comment\n\n  \\bone\\b  \n(broken\n(?P<name>x)y\n\\btwo.?\\b\n   # also comment\n[z-a]\n\\bé\\b\n",
        encoding="utf-8",
    )
    assert read_rule_lines(spark, str(path))[:2] == [r"\bone\b", "(broken"]
    accepted, rejected = load_rules(
        spark,
        [
            RuleFile(str(path), lang="en"),
            RuleFile(str(tmp_path / "missing.txt"), lang="bm"),
            RuleFile(str(path), kind="entity", category="c"),
        ],
    )
    rules = accepted.where("kind = 'rule'").orderBy("ord").collect()
    assert [r.pattern for r in rules] == [r"\bone\b", r"\btwo.?\b", r"\bé\b"]
    reasons = {r.pattern: r.reason for r in rejected.where("kind = 'rule'").collect()}
    assert reasons["(broken"].startswith("invalid regex") and reasons["[z-a]"].startswith("invalid regex")
    assert reasons["(?P<name>x)y"] == "not supported by the matching engine"
    pack = RulePack.from_df(accepted)
    assert pack.explicit == (("en", (r"\bone\b", r"\btwo.?\b", r"\bé\b")),)
    assert pack.category("c").entities[0] == r"\bone\b"


def test_default_pack_from_files(spark, tmp_path):
    for name, content in {"en": r"\bfig\b", "race": "# none\n\\bhoot\\b\n(", "hard": "vile owl\n(x\n"}.items():
        (tmp_path / name).write_text(content)
    pack = load_three_category_pack(
        spark,
        {"en": str(tmp_path / "en"), "bm": str(tmp_path / "missing")},
        race=str(tmp_path / "race"),
        hard=str(tmp_path / "hard"),
    )
    assert pack.explicit == (("en", (r"\bfig\b",)), ("bm", ()))
    assert [c.name for c in pack.categories] == ["race", "religion", "royalty"]
    assert pack.verified.rules == (r"\bhoot\b",) and pack.verified.hard == ("vile owl",)
    assert len(pack.category("religion").entities) == 18 and len(pack.amplifiers) == 31


def test_bad_rules_are_found_one_by_one(spark):
    rules = ["ok%d" % i for i in range(20)]
    for i in (3, 4, 17):
        rules[i] = "(?P<n>a)"
    assert set(check_rules(spark, rules)) == {3, 4, 17}


def test_any_file_is_read_unless_restricted(spark, tmp_path):
    import gzip

    names = ["a.jsonl", "b.JSONL", "c.ndjson", "d.log", "part-00000"]
    for name in names:
        (tmp_path / name).write_text(f"in {name}\n")
    with gzip.open(tmp_path / "e.json.gz", "wt") as file:
        file.write('{"text": "in e.json.gz"}\n')
    texts = lambda **k: sorted(r.text for r in read_lines(spark, str(tmp_path), **k).documents.collect())
    assert texts() == sorted(f"in {n}" for n in [*names, "e.json.gz"])
    assert texts(endings=UPLOAD_ENDINGS) == ["in a.jsonl", "in b.JSONL"]
    assert [r.text for r in read_lines(spark, str(tmp_path / "part-00000")).documents.collect()] == ["in part-00000"]
    with pytest.raises(FileNotFoundError):
        read_lines(spark, str(tmp_path / "d.log"), endings=UPLOAD_ENDINGS)


def test_equal_names_in_two_folders_stay_apart(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "p0.jsonl").write_text(f"from {folder}\n")
    rows = read_lines(spark, [str(tmp_path / "x"), str(tmp_path / "y")]).documents.collect()
    assert sorted((r.dataset_id, r.line_no, r.text) for r in rows) == [("x/p0.jsonl", 1, "from x"), ("y/p0.jsonl", 1, "from y")]


@pytest.mark.parametrize("layout", ["one large", "many small"])
def test_moved_splits_never_number_wrongly(spark, tmp_path, layout):
    if layout == "one large":
        (tmp_path / "big.txt").write_text("\n".join(f"line {i}" for i in range(1, 60_001)))
        changes = {"spark.sql.files.maxPartitionBytes": "20000"}
    else:
        for k in range(40):
            (tmp_path / f"s{k:02}.txt").write_text("\n".join(f"line {i}" for i in range(1, 40 + 3 * k)))
        changes = {"spark.sql.files.minPartitionNum": "23"}
    documents = read_lines(spark, str(tmp_path)).documents
    before = {key: spark.conf.get(key, None) for key in changes}
    for key, value in changes.items():
        spark.conf.set(key, value)
    try:
        rows = documents.collect()
        assert len(rows) in (60_000, sum(39 + 3 * k for k in range(40)))
        assert all(r.text == f"line {r.line_no}" for r in rows)
    except Exception as error:
        assert "split differently" in str(error)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_settings_of_the_session_stay(spark, tmp_path):
    key = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(key)
    (tmp_path / "twice.jsonl").write_text('{"text": "first", "text": "last"}\n')
    documents = read_lines(spark, str(tmp_path)).documents
    assert spark.conf.get(key) == before
    assert [r.text for r in documents.collect()] == ["last"]
    with setting(spark, key, "true"):
        with setting(spark, key, "true"):
            assert spark.conf.get(key) == "true"
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == before


def test_rules_of_several_files_are_all_kept(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a1\na2\n")
    (tmp_path / "b.txt").write_text("b1\n(\nb2\nb3\n")
    (tmp_path / "folder").mkdir()
    for name in ("part-0", "part-1"):
        (tmp_path / "folder" / name).write_text(f"{name} x\n{name} y\n")
    assert read_rule_lines(spark, str(tmp_path / "folder")) == ["part-0 x", "part-0 y", "part-1 x", "part-1 y"]
    accepted, rejected = load_rules(spark, [RuleFile(str(tmp_path / n), lang="en") for n in ("a.txt", "b.txt")])
    assert RulePack.from_df(accepted).explicit == (("en", ("a1", "a2", "b1", "b2", "b3")),)
    assert rejected.count() == 1
    with pytest.raises(ValueError, match="share a place"):
        RulePack.from_df(accepted.union(accepted))
    other, _ = load_rules(spark, [RuleFile(str(tmp_path / "a.txt"), lang="en")], pack="other")
    with pytest.raises(ValueError, match="several packs"):
        RulePack.from_df(accepted.union(other))
    assert RulePack.from_df(accepted.union(other), pack="other").explicit == (("en", ("a1", "a2")),)
    with pytest.raises(ValueError, match="max_rules"):
        RulePack.from_df(accepted, max_rules=4)


def test_partition_names_are_not_numbers(spark, tmp_path):
    rows = [("p/q", s, "train", f"text {s}") for s in ("01", "1")]
    df = spark.createDataFrame(rows, "dataset string, subset string, split string, text string")
    df.write.partitionBy("dataset", "subset", "split").json(str(tmp_path / "c"))
    (tmp_path / "c" / "dataset=other" / "subset=1" / "split=train").mkdir(parents=True)
    (tmp_path / "c" / "dataset=other" / "subset=1" / "split=train" / "x.json").write_text('{"text": "no", "odd": 1}\n')
    corpus = read_corpus(spark, str(tmp_path / "c"), "p/q", "01", format="json")
    assert corpus.columns == ["dataset_id", "line_no", "text"]
    assert [tuple(r) for r in corpus.collect()] == [("p/q/01/train", 1, "text 01")]


def test_only_local_sessions_may_lack_a_shared_folder():
    from types import SimpleNamespace

    def session(master, folder=None):
        context = SimpleNamespace(master=master, applicationId="app-x", getCheckpointDir=lambda: folder)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: None))

    assert shared_dir(session("yarn", "hdfs://x/shared")) == "hdfs://x/shared"
    assert "sievemark-" in shared_dir(session("local[4]"))
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://h:1"):
        with pytest.raises(RuntimeError):
            shared_dir(session(master))


def test_output_names():
    assert sinks.dataset_stem("org/name/ms/train") == "org_name_ms_train"
    assert sinks.dataset_stem("folder/shard.0001.jsonl") == "shard.0001"
    assert sinks.corpus_stem("org/name", "ms", "train") == "org_name_ms_train"
    assert sinks.file_stem("/data/in/shard.0001.jsonl") == "shard.0001"
    assert sinks.cleaned_path("/out/", "shard") == "/out/shard_cleaned.jsonl"
    assert sinks.custom_cleaned_path("/out", "shard") == "/out/shard_custom_cleaned.jsonl"
