"""Language, language model, decision list, privacy, URLs and mixing on small tables."""

import math
import random
import re
from collections import Counter

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.llm import katz, language, mixing, oracles, prefix, privacy, quality, urls
from sievemark.llm.queries import URL_RULES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _sf(spark, name="documents"):
    return spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


# --- language ---


def test_greedy_phrases_are_longest_matches():
    texts = (("x", "abracadabra abba cab"), ("y", "zebra zab"))
    parser = language.Parser(texts)
    for text in ("abba cadabra zeb", "qqq", "a", "abracadabraabba" * 40):
        for name, count, log in zip(parser.names, parser.scores([text])[0][0], parser.logs):
            known = re.sub("[^a-z]+", " ", dict(texts)[name])
            letters = {c for t in dict(texts).values() for c in t}
            phrases = 0
            for at in range(0, len(text), language.SEGMENT):
                rest = "".join(c if c in letters else "?" for c in text[at : at + language.SEGMENT])
                while rest:
                    k = 1
                    while k < len(rest) and rest[: k + 1] in known:
                        k += 1
                    phrases, rest = phrases + 1, rest[k:]
            assert count * len(text) / log == pytest.approx(phrases), (text, name)


def test_language_of_held_out_documents(spark):
    docs = _sf(spark)
    held = language.fold(F.col("doc_id"), 3) == 1
    training = language.training_texts(docs.where(~held))
    rows = language.identify(docs.where(held), training).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect() if brute.fold(r.doc_id, 3) == 1}
    right = sum(r.lang == r.lang_pred for r in rows)
    assert right >= 0.95 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_language_cases(spark):
    docs = _sf(spark)
    odd = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "123 !! \n", "en", "s", 0), (4, "漢字", None, None, None), (4, "漢字", None, None, None)]
    df = spark.createDataFrame(odd, DOCS).withColumn("score", F.lit("own"))
    got = language.identify(df, language.training_texts(docs)).collect()
    assert [(r.doc_id, r.lang_pred == "und") for r in sorted(got, key=lambda r: r.doc_id)] == [(1, True), (2, True), (3, True), (4, False), (4, False)]
    assert language.identify(df, {}).where("lang_pred = 'und'").count() == 5
    assert language.training_texts(spark.createDataFrame([], DOCS)) == {}
    assert language.identify(spark.createDataFrame([], DOCS), {"en": "the"}).count() == 0


# --- language model ---


def _plain_katz(rows, model):
    """The same model by dictionaries: classes as given, counts and weights recomputed."""
    frequent = set(model.hashes.tolist())
    from sievemark.llm.texts import hash_of

    cls = lambda w: w if w == "</s>" or hash_of(w) in frequent else "<rare>"
    tokens = {i: brute.WORD.findall(brute.lowered(t)) + ["</s>"] for i, t in rows}
    train = [tokens[i] for i, _ in rows if brute.fold(i, 7) != 2]
    words = Counter(w for t in train for w in t)
    total, distinct = sum(words.values()), len(words)
    rare = {w: c for w, c in words.items() if cls(w) == "<rare>"}
    classes = Counter(cls(w) for t in train for w in t)
    share = {c: n / (total + 2) for c, n in classes.items()}
    share["<rare>"], share["</s>"] = (sum(rare.values()) + 1) / (total + 2), (classes["</s>"] + 1) / (total + 2)
    pairs = Counter(p for t in train for p in zip(["<s>", *map(cls, t[:-1])], map(cls, t)))
    context = Counter(a for t in train for a in ["<s>", *map(cls, t[:-1])])
    cut = katz.discounts({r: sum(c == r for c in pairs.values()) for r in range(1, katz.K + 2)})
    rare_cut = katz.discounts({r: sum(c == r for c in rare.values()) for r in range(1, katz.K + 2)})
    freed = sum((1 - rare_cut[min(c, katz.K + 1)]) * c for c in rare.values())

    def behind(a):
        own = {b: c for (x, b), c in pairs.items() if x == a}
        seen = {b: cut[min(c, katz.K + 1)] * c / context[a] for b, c in own.items()}
        left = 1 - sum(share[b] for b in own)
        alpha = (1 - sum(seen.values())) / left if own else 1.0
        return {b: seen.get(b, alpha * p) for b, p in share.items()}

    def score(t):
        out = 0.0
        for a, w in zip(["<s>", *map(cls, t[:-1])], t):
            out += math.log10(behind(a)[cls(w)])
            if cls(w) == "<rare>":
                c = rare.get(w, 0)
                out += math.log10(rare_cut[min(c, katz.K + 1)] * c / sum(rare.values()) if c else freed / sum(rare.values()))
        return out

    base = lambda t: sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in t)
    return {i: (brute.fold(i, 7) == 2, len(t), sum(w in words for w in t), base(t), score(t), total) for i, t in tokens.items()}, behind


def test_katz_scores_equal_a_plain_model(spark):
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(9000)]
    rows, at = [], 0
    for i in range(120):
        n = rng.randint(0, 130)
        rows.append((i, " ".join(words[at : at + n]).replace("w3", "W3")))
        at = (at + n) % 8000
    rows += [(900, None), (901, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = language.fold(F.col("doc_id"), 7) == 2
    got = {r.id: r for r in katz.train_and_score(df, held).collect()}
    chosen = df.select(F.col("doc_id").alias("id"), held.alias("held"), "text")
    model = katz.vocabulary(katz.count_words(chosen, 16))
    assert 5 < len(model.hashes) < 500
    expected, behind = _plain_katz(rows, model)
    for i, (held_out, n, known, base, score, total) in expected.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)
    for a in ("<s>", "<rare>", "w1", "w2"):
        assert sum(behind(a).values()) == pytest.approx(1.0)


def test_katz_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert katz.train_and_score(empty, F.lit(False)).count() == 0
    one = spark.createDataFrame([(1, "a a a b", "x")], "doc_id long, text string, score string")
    for held in (True, False):
        r = katz.train_and_score(one, F.lit(held)).collect()[0]
        assert r.n_tokens == 5 and math.isfinite(r.score) and math.isfinite(r.base_score)


def test_discounts_stay_in_range():
    assert (katz.discounts({}) > 0).all() and (katz.discounts({1: 10}) > 0).all()
    n = {1: 1000, 2: 350, 3: 170, 4: 100, 5: 66, 6: 47}
    cut = katz.discounts(n)
    assert all(0 < d < 1 for d in cut[1:6]) and cut[6] == 1
    freed = sum((1 - cut[r]) * r * n[r] for r in range(1, 6))
    assert freed == pytest.approx(n[1])  # Good-Turing frees the mass of the singletons


# --- quality ---


def test_counts_equal_plain_ones(spark):
    rng = random.Random(6)
    parts = ["a", "b", "c", " ", " ", "\n", "\t", "#", "é", "!", "|", "\x0b", "\u00a0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += [None, "", "a b c a b c", "x x x x", "\n\n", "a\na\n a\na b", "w " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.with_counts(df).collect():
        own = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert own == brute.quality_row(texts[r.doc_id]), repr(texts[r.doc_id])


def test_decision_list_learns_planted_rules(spark):
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(60, 90))]
        if not good:
            words = [w.upper() + "!!" for w in words] if rng.random() < 0.5 else [w + " |" for w in words]
        rows.append((i, " ".join(words), int(good)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 2] + [(None, 1), (1, None), (99999, 0)], "doc_id long, quality int")
    judged = quality.judge(docs, labels).collect()
    wrong = sum(r.method_keeps != bool(rows[r.doc_id][2]) for r in judged)
    assert len(judged) == 1500 and wrong <= 15


def test_decision_list_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.method_keeps for r in quality.judge(docs, none).collect()] == [True] * 3
    assert quality.judge(docs.where("false"), none).count() == 0


# --- privacy ---


def test_copies_of_texts_change_no_disclosure(spark):
    held = [f"call Zoltan at z@zoltan.org now {i}" for i in range(3)]
    texts = held * 30 + [f"call anyone at noon {i}" for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.text for r in privacy.sanitise(privacy.find_spans(df.repartition(3))).collect()}
    assert not any("Zoltan" in t for t in out) and "call anyone at noon 7" in out


def test_base_spans_equal_plain_ones(spark):
    rng = random.Random(10)
    parts = ["a", "B.", "@", "x@y.z", "1", "23", ".", "-", " ", "+", "(", "4111111111111111", "10.0.0.255", "256", "é", "😀", "\n", "_", "c@d.e", "+1 555 0100 200"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    texts += [None, "", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "a" * 30000, "1" * 30000, "1 " * 9000, "a@" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = privacy.find_spans(df, min_support=10**6)
    for r in found.select("doc_id", privacy.span_text(F.col("base_spans")).alias("s")).collect():
        assert r.s == ",".join(brute.pii(texts[r.doc_id])), repr(texts[r.doc_id])[:200]


def test_revealing_terms_are_found_and_replaced(spark):
    rng = random.Random(12)
    filler = [f"word{c}{d}" for c in "abcdefghij" for d in "abcdefghij"]
    say = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    rows = [(i, f"{say(30)} Quillfeather wrote from q.f@mail.example {say(30)}") for i in range(8)]
    rows += [(100 + i, f"{say(40)} other{i}@mail.example {say(20)}") for i in range(40)]
    rows += [(200 + i, say(60)) for i in range(200)]
    rows += [(500, f"quillfeather {say(5)} q.f@mail.example and Quillfeathers"), (501, None)]
    df = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, spans string")
    found = privacy.find_spans(df)
    by_id = {r.doc_id: [(s.kind, s.value) for s in r.spans] for r in found.collect()}
    for i in range(8):
        assert ("term", "Quillfeather") in by_id[i] and ("email", "q.f@mail.example") in by_id[i]
    assert all(k != "term" for i in range(100, 140) for k, _ in by_id[i]) and all(not by_id[200 + i] for i in range(200))
    assert [v for k, v in by_id[500] if k == "term"] == ["quillfeather"]
    texts = {r.doc_id: r.text for r in privacy.sanitise(found).collect()}
    assert "uillfeather wrote" not in texts[0] and "[EMAIL]" in texts[0] and texts[501] is None
    assert texts[200] == dict(rows)[200] and texts[500].endswith("and Quillfeathers")
    assert privacy.find_spans(df.where("false")).count() == 0


def test_sanitise_overlaps(spark):
    text = "call +4222222222222 now 10.0.0.1@x.y"
    out = privacy.sanitise(privacy.find_spans(spark.createDataFrame([(1, text)], "doc_id long, text string"))).collect()[0].text
    assert "4222" not in out and "10.0.0.1" not in out and out.startswith("call ") and " now " in out


# --- urls ---


def test_rules_equal_plain_ones(spark):
    rng = random.Random(14)
    parts = ["http", "://", "/", "?", "#", "com", "net", ".", "example.com", "WWW.example.com", "/en/", "/es/", "/fr/", "x", "\n", "1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(1500)] + [None, "", "://", "a://", "a://Net/es/"]
    df = spark.createDataFrame(list(enumerate(texts)), "page_id long, url string")
    for r in urls.judge(df, URL_RULES).collect():
        best = brute.url_rule(texts[r.page_id], URL_RULES)
        assert (r.host, r.path) == brute.url_parts(texts[r.page_id]), repr(texts[r.page_id])
        assert r.rule == (best[1] if best else None)
        assert best is None or r.verdict == best[0]


def test_templates_generalise_and_reject(spark):
    rows = [(i, f"http://shop.net/es/item/{i}.html") for i in range(300)]
    rows += [(1000 + i, f"http://shop.net/en/item/{i}") for i in range(300)]
    rows += [(2000 + i, f"http://news.com/story/slug-{chr(97 + i % 26)}{i}x") for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("path", F.lit("own"))
    got = {r.page_id: r for r in urls.judge(df, [("block", "net/es/item/1"), ("allow", "com/")]).collect()}
    assert got[5].template == "shop.net/es/item/<n>.html" and got[1005].template == "shop.net/en/item/<n>"
    assert got[2005].template == "news.com/*/*" or got[2005].template == "news.com/story/*"
    assert got[5].rule is None and got[5].verdict == "block"  # the template is pure
    assert got[1005].verdict == "allow" and got[1005].rule is None
    assert urls.judge(df.where("false"), URL_RULES).count() == 0


# --- mixing ---


def test_running_totals_over_many_tasks(spark):
    rng = random.Random(16)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.random(), rng.randint(0, 9)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, k double, v long").repartition(5)
    order = [F.col("g").asc_nulls_last(), F.col("k")]
    got = {r.k: r.before for r in prefix.running_totals(df, order, "v", "before", group="g").collect()}
    totals = Counter()
    for g, k, v in sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1])):
        assert got[k] == totals[g]
        totals[g] += v
    whole = {r.k: r.before for r in prefix.running_totals(df, [F.col("k")], "v", "before").collect()}
    done = 0
    for _, k, v in sorted(rows, key=lambda r: r[1]):
        assert whole[k] == done
        done += v


def test_mix_equals_sql_and_meets_targets(spark, tmp_path):
    rng = random.Random(18)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 40))), "en", rng.choice(["b", "a", "ä", None, "tiny"] + ["c"] * 5), 1) for i in range(700)]
    rows = [r for r in rows if r[3] != "tiny" or r[0] % 9 == 0] + [(5000, None, "en", "nothing", 0), (3, "w w", "en", "a", 1), (3, "w w", "en", "a", 1)]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(df).select("doc_id", "size", "source_size", "target", "taken").toPandas()
    table = df.toPandas()
    connection = duckdb.connect()
    connection.register("documents", table)
    expected = connection.execute(oracles.oracle_sql()["op8_weighted_mix"]).df()[list(got.columns)]
    key = list(got.columns)
    a, b = (x.sort_values(key).reset_index(drop=True) for x in (got, expected))
    assert np.allclose(a.to_numpy(dtype=float), b.to_numpy(dtype=float))
    assert (got.taken <= 3 * got["size"]).all()
    taken = mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r.t - r.g) <= 1 for r in taken)


def test_copies_follow_the_mix(spark):
    rows = [(i, f"w{i} b c", "en", "ab"[i % 2], 1) for i in range(40)] + [(99, None, None, None, None)]
    mixed = mixing.mix(spark.createDataFrame(rows, DOCS))
    out = mixing.copies(mixed).collect()
    words = Counter()
    for r in out:
        words[r.doc_id] += len(r.text.split())
    assert words == Counter({r.doc_id: r.taken for r in mixed.collect() if r.taken})
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


# --- columns of the same names ---


def test_own_columns_replace_those_of_the_same_name(spark):
    rows = [(i, f"w{i} b c d", "en", "ab"[i % 2], 9) for i in range(8)]
    names = ["size", "TARGET", "taken", "Source_Size", "n_words", "RULE", "kept", "words"]
    df = spark.createDataFrame(rows, DOCS).select("*", *[F.lit("own").alias(n) for n in names])
    mixed = mixing.mix(df)
    assert sorted(c.lower() for c in mixed.columns) == sorted({c.lower() for c in mixed.columns})
    assert all(r["size"] == 4 and r["kept"] == "own" for r in mixed.collect())
    judged = quality.judge(df, spark.createDataFrame([(1, 0)], "doc_id long, quality int"))
    assert len({c.lower() for c in judged.columns}) == len(judged.columns)
    assert all(r["n_words"] == 4 and r["rule"] is None and r["kept"] == "own" for r in judged.collect())


def test_terms_are_counted_before_they_meet_candidates(spark):
    """No explode of words lies below the join with the candidates."""
    from pyspark.sql import functions as F

    from sievemark.llm import privacy

    texts = spark.createDataFrame([("kites and boats and kites",), ("boats",)], "text string")
    words = texts.select(F.explode(F.split("text", " ")).alias("term"))
    candidates = spark.createDataFrame([("kites",), ("boats",)], "term string")
    counted = privacy.counted_terms(words, candidates)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Scan parquet" in plan
    assert sorted(tuple(r) for r in counted.collect()) == [("boats", 2), ("kites", 2)]
