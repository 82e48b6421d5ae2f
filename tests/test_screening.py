"""Boost, verification, decisions and scores."""

from dataclasses import replace

import pytest
from plain import screened
from pyspark.sql import functions as F

from sievemark import Category, RulePack, ScreenConfig, screen, screen_categories, screen_explicit
from sievemark.operators.scores import (
    score_categories,
    score_explicit,
    with_category_scores,
    with_explicit_scores,
)
from sievemark.packs.defaults import three_category_pack
from sievemark.packs.neutral import NEUTRAL, WIDE

# Neutral words in every role: entity "owl", insult "grim", safe "study", hard "vile owl".
PACK = RulePack(
    explicit=(("en", (r"\bfig\b", r"\bplum\b")), ("bm", (r"\bfig\b", r"\bkiwi\b"))),
    categories=(
        Category(
            "birds",
            rules=(r"\bhoot\b", r"\bbeak\b"),
            entities=("owl", "jay"),
            score_label="bird hate",
            verify_entities=("owl",),
            safe=("study", "news"),
            hard=("vile owl",),
        ),
        Category("trees", rules=(r"\bbark\b",), entities=("oak", "red oak", "al-oak"), score_label="tree hate"),
    ),
    amplifiers=("grim", "dire"),
    safe_label="fine",
)


def decide(spark, texts, pack=PACK, config=ScreenConfig(), extra=""):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = screen(df, pack, config).orderBy("id").collect()
    return rows


def compare(rows, pack, **options):
    for row in rows:
        expected = screened(row.text or "", pack, **options)
        got = row.sensitive.asDict()
        assert row.explicit.is_explicit == expected.explicit, row.text
        assert row.explicit.language == expected.language, row.text
        assert row.explicit.matched_keywords == expected.explicit_matches, row.text
        for name, flag in expected.flags.items():
            assert got[f"{name}_flagged"] == flag, (name, row.text)
            assert got[f"{name}_matches"] == expected.matches[name], (name, row.text)
        checked = pack.verified
        if checked:
            assert got[f"{checked.name}_verified"] == expected.verified, row.text
            assert got["verification_reason"] == expected.reason, row.text
        assert got["categories"] == [n.upper() for n, f in expected.flags.items() if f]
        assert row.keep == expected.keep, row.text


PAD = "x" * 78
CASES = [
    "nothing here",
    "a Fig",
    "kiwi and plum and fig",
    "hoot",
    "hoot beak bark",
    "Vile OWL hoot study study",
    "hoot study news",
    "hoot study study grim",
    "hoot study study grim dire",
    "hoot study study study grim dire",
    "hoot study grim dire",
    "hoot study grim owl",
    "hoot grim " + "y " * 30 + "owl",
    "hoot owl grim",
    "hoot study " + "z " * 40 + "grim dire owl",
    # boost: amplifier at 80 and at 81 characters after the entity
    "owl " + "." * 75 + "grim",
    "owl " + "." * 76 + "grim",
    "owl " + "." * 77 + "grim",
    "grim" + "." * 76 + "owl",
    "grim" + "." * 77 + "owl",
    # the first place is inside another word, far from the amplifier
    "growl " + "." * 200 + " owl grim",
    "owl " + "." * 200 + " owl grim",
    "OWL owl Owl owl grim",
    # windows cut words: a boundary appears at the cut
    "owl " + "." * 75 + "grimmer",
    "owl " + "." * 75 + "grimmer hoot",
    "hoot owl" + "." * 36 + "grimmer",
    "hoot owl" + "." * 35 + "grimmer",
    "hoot owl" + "." * 37 + "grimmer",
    "mergrim" + "." * 36 + "owl hoot",
    "mergrim" + "." * 37 + "owl hoot",
    # characters of two code units inside the windows
    "hoot grim" + "😀" * 36 + "owl",
    "hoot grim" + "😀" * 37 + "owl",
    "hoot grim" + "𝒳 " * 18 + "owl",
    "grim" + "😀" * 76 + "owl",
    "grim" + "😀" * 77 + "owl",
    "owl" + "😀" * 76 + "grim hoot",
    # entities that share text
    "red oak grim",
    "al-oak " + "." * 74 + "grim",
    "al-oak " + "." * 75 + "grim",
    "oak al-oak red oak dire",
    "al-oak\ngrim",
    "İowl grim",
    "",
]


def test_cases_agree_with_plain_statement(spark):
    compare(decide(spark, CASES), PACK)


def test_threshold_two(spark):
    compare(decide(spark, CASES, config=ScreenConfig(keyword_threshold=2)), PACK, threshold=2)


def test_other_windows(spark):
    config = ScreenConfig(context_window=5, target_window=3)
    compare(decide(spark, CASES, config=config), PACK, window=5, tight=3)


def test_every_reason_without_scores_is_reached(spark):
    reasons = {r.sensitive.verification_reason.split("(")[0] for r in decide(spark, CASES)}
    assert reasons == {
        "",
        "hard_slur",
        "safe_context",
        "safe_dominates",
        "insult_not_targeted_at_entity",
        "targeted_insult",
        "keyword_match",
    }


@pytest.mark.parametrize("pack", [NEUTRAL, replace(NEUTRAL, categories=NEUTRAL.categories[1:])])
def test_test_documents(spark, documents, pack):
    compare(screen(documents, pack).collect(), pack)


def test_default_lexicons(spark, documents):
    pack = three_category_pack(
        {"en": [r"\bthe\b"], "bm": [r"\bder\b"]},
        race=[r"\bof\b"],
        religion=[r"\bin\b"],
        hard=["by the", "in.?of"],
    )
    texts = [
        "The king is a liar and the palace is stupid",
        "al-quran, they say, is not evil",
        "the bible " + "." * 70 + " evil",
        "Orang asli bodoh; kajian universiti of history",
        "of chinese bumi murder",
        "of court. Reported by news, according to a study",
        "dr.x dr. of",
        "undang-undang of bersama sama evil evil",
    ]
    rows = decide(spark, texts, pack=pack)
    compare(rows, pack)
    compare(screen(documents, pack).collect(), pack)


def test_wide_pack(spark, documents):
    rows = screen_explicit(documents, WIDE).collect()
    for row in rows[:60]:
        expected = screened(row.text, WIDE)
        assert row.explicit.matched_keywords == expected.explicit_matches


def test_null_text_is_kept(spark):
    rows = decide(spark, [None])
    assert rows[0].keep and rows[0].sensitive.categories == []


def test_switches(spark):
    df = spark.createDataFrame([("fig hoot bark",)], "text string")
    assert screen_explicit(df, PACK).columns == ["text", "explicit", "keep"]
    assert screen_categories(df, PACK).columns == ["text", "sensitive", "keep"]
    neither = screen(df, PACK, ScreenConfig(skip_explicit=True, skip_categories=True))
    assert neither.columns == ["text", "keep"] and neither.first().keep


def test_threshold_must_be_positive():
    with pytest.raises(ValueError):
        ScreenConfig(keyword_threshold=0)


def test_higher_threshold_never_adds_explicit_flags(documents):
    low = screen_explicit(documents, NEUTRAL).where("explicit.is_explicit").select("doc_id")
    high = screen_explicit(documents, NEUTRAL, ScreenConfig(keyword_threshold=2)).where("explicit.is_explicit")
    assert high.select("doc_id").exceptAll(low).count() == 0


# --- scores ----------------------------------------------------------------------

ML = ScreenConfig(use_ml=True)


def scored(spark, texts, category_scores, explicit_scores=()):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = spark.createDataFrame(
        [(i, k, v) for i, s in enumerate(category_scores) for k, v in s.items()], "id int, label string, score double"
    )
    df = with_category_scores(df, table, ["id"], PACK)
    if explicit_scores:
        df = with_explicit_scores(df, spark.createDataFrame(explicit_scores, "id int, label string, score double"), ["id"])
    return screen(df, PACK, ML).orderBy("id").collect()


def test_model_rows_of_the_verification(spark):
    texts = ["hoot", "hoot", "hoot", "calm", "calm study study", "calm owl grim", "hoot study dire", "bark", "oak"]
    scores = [
        {"bird hate": 0.125, "fine": 0.375},
        {"bird hate": 0.705},
        {},
        {"bird hate": 0.9, "fine": 0.95},
        {"bird hate": 0.9},
        {"fine": 0.015, "bird hate": 0.005},
        {"fine": 1.0, "other label": 0.99},
        {"tree hate": 0.7},
        {"tree hate": 0.71, "bird hate": 0.7},
    ]
    rows = scored(spark, texts, scores)
    for row, label_scores in zip(rows, scores):
        expected = screened(row.text, PACK, label_scores=label_scores)
        got = row.sensitive
        assert got.birds_flagged == expected.flags["birds"], row.text
        assert got.trees_flagged == expected.flags["trees"], row.text
        assert got.birds_verified == expected.verified and got.verification_reason == expected.reason, row.text
    assert rows[0].sensitive.verification_reason == "ml_safe(0.38>0.12)"
    assert rows[6].sensitive.ml_scores == {"fine": 1.0}


def test_best_label_decides(spark):
    rows = scored(
        spark,
        ["calm", "calm", "calm", "fig", "calm"],
        [{}] * 5,
        [(0, "toxic", 0.8), (0, "neutral", 0.3), (1, "toxic", 0.6), (2, "neutral", 0.9), (3, "toxic", 0.1), (2, "toxic", 0.8)],
    )
    assert [r.explicit.is_explicit for r in rows] == [True, False, False, True, False]
    assert [r.explicit.ml_label for r in rows] == ["TOXIC", "TOXIC", "NEUTRAL", "TOXIC", None]


def test_scores_are_ignored_unless_asked_for(spark):
    df = spark.createDataFrame([(0, "calm")], "id int, text string").withColumn(
        "explicit_score", F.struct(F.lit("toxic").alias("label"), F.lit(0.9).alias("score"))
    )
    assert screen(df, PACK).first().keep
    assert not screen(df, PACK, ML).first().keep


def test_scorers_survive_errors(spark):
    def explicit():
        def score(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("cannot score")
            return [[("toxic", min(1.0, len(t) / 512))] for t in texts]

        return score

    def broken():
        raise OSError("no model")

    df = spark.createDataFrame([(0, "y" * 9000), (1, "boom"), (2, "short")], "id int, text string").coalesce(1)
    rows = screen(score_categories(score_explicit(df, explicit), broken), PACK, ML).orderBy("id").collect()
    assert [r.explicit.ml_score for r in rows] == [1.0, None, 5 / 512]
    assert [r.keep for r in rows] == [False, True, True]
    assert all(r.sensitive.ml_scores == {} for r in rows)


# --- packs -----------------------------------------------------------------------


def test_pack_survives_its_table(spark):
    again = RulePack.from_df(PACK.to_df(spark), order=["en", "bm", "birds", "trees"])
    assert replace(again, safe_label="fine") == PACK


def test_pack_limits():
    with pytest.raises(ValueError):
        RulePack(categories=(Category("a"), Category("a")))
    with pytest.raises(ValueError):
        RulePack(categories=(Category("a", verify_entities=("x",)), Category("b", verify_entities=("x",))))
    with pytest.raises(ValueError):
        RulePack(explicit=(("en", tuple(str(i) for i in range(20_001))),))


def test_words_behind_terms_that_end_in_a_mark(spark):
    pack = three_category_pack({}, race=[r"\bhoot\b"])
    texts = ["hoot news dr.study cina bodoh bodoh", "hoot dr.news cina bodoh", "hoot dr.news", "hoot dr. news", "hoot dr.dr.news study"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = screen(df, pack).orderBy("id").collect()
    for row in rows:
        expected = screened(row.text, pack)
        assert row.sensitive.verification_reason == expected.reason, row.text
        assert row.keep == expected.keep, row.text
    assert rows[0].keep and rows[0].sensitive.verification_reason == "safe_dominates(3>2)"


def test_word_hits_of_terms_with_marks(spark):
    import random
    import re

    from sievemark.functions.regex import word_hits

    rng = random.Random(21)
    terms = ["dr.", "a-", "-b", "news", "x.y", "é.", "a", "dr", "new+", "ab?"]
    terms = [re.escape(t) if "?" not in t else t for t in terms]
    parts = ["dr", ".", "a", "-", "b", "news", " ", "x.y", "é", "new+", "_", "ab", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    for chosen in (terms, terms[:1] + terms[3:4], terms[3:4] + terms[6:8]):
        plain = re.compile(r"\b(?:" + "|".join(chosen) + r")\b", re.IGNORECASE)
        df = spark.createDataFrame([(t,) for t in texts], "text string")
        for row in df.select("text", word_hits(F.col("text"), chosen).alias("hits")).collect():
            assert row.hits == plain.findall(row.text), (row.text, chosen)


def test_score_errors_are_visible_and_cost_one_text(spark):
    from sievemark.operators.scores import score

    df = spark.createDataFrame([(i, "bad" if i == 37 else f"t{i}") for i in range(100)], "id long, text string").coalesce(1)

    def explicit():
        def run(texts):
            if "bad" in texts:
                raise ValueError("bad text")
            return [[("toxic", 0.9)] for _ in texts]

        return run

    def missing():
        raise OSError("no model")

    rows = {r.id: r for r in score(df, explicit).collect()}
    assert rows[37].explicit_score is None and "bad text" in rows[37].score_error
    assert all(r.explicit_score.label == "TOXIC" and r.score_error is None for i, r in rows.items() if i != 37)
    assert all("no model" in r.score_error for r in score(df, explicit, missing).where("id <> 37").collect())
    with pytest.raises(Exception, match="no model"):
        score(df, missing, strict=True).collect()
    whole = score(df, lambda: lambda texts: [[("toxic", float(len(t)))] for t in texts], explicit_chars=None)
    assert whole._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_pages_by_key_follow_each_other(spark):
    from sievemark.operators.review import review_page

    df = spark.createDataFrame([(f"d{i % 3}", i) for i in range(30)], "dataset_id string, line_no long")
    whole = [tuple(r) for r in df.orderBy("dataset_id", "line_no").collect()]
    seen, after = [], None
    while page := [tuple(r) for r in review_page(df, per_page=7, after=after).collect()]:
        seen, after = seen + page, page[-1]
    assert seen == whole
