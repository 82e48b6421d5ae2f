"""The registered queries in SQL, for DuckDB.

Written from the meaning of the operators, not from their Spark form: rules use
consuming separators in place of Unicode word boundaries (RE2's ``\\b`` is ASCII
only), windows come from marked and split texts, and counts run on texts with
doubled separators, so that neighbours do not share one.
"""

from __future__ import annotations

SEP = r"[^\p{L}\p{N}_]"
UNMARKED_SEP = r"[^\p{L}\p{N}_\x01\x02]"

AMPLIFIERS = "idiot|clown|moron|trash|stupid|disgusting|loser"
SAFE = "was|have|not|you"
HARD = "scum|for trash"
EXPLICIT = {"en": ["idiot", "moron", "clown", "this with"], "de": ["der und", "idiot", "pathetic"]}
RULES = {
    "alpha": ["scum", "for.{0,10}trash", "of the"],
    "beta": ["worthless", "this.?is"],
    "gamma": ["pathetic", "by.*loser"],
}
ENTITIES = {"alpha": "from|with|for", "beta": "that|this", "gamma": "this|with"}
CATEGORIES = list(RULES)


def word(core: str) -> str:
    return f"'(?i)(?:^|{SEP})({core})(?:$|{SEP})'"


def has(text: str, core: str) -> str:
    return f"regexp_matches({text}, {word(core)})"


def count(wide_text: str, core: str) -> str:
    return f"len(regexp_extract_all({wide_text}, {word(core)}, 1))"


def evidence(text: str, rules: list[str]) -> str:
    cases = [f"CASE WHEN {has(text, r)} THEN regexp_extract({text}, {word(r)}, 1) END" for r in rules]
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


def joined(array: str) -> str:
    return f"coalesce(array_to_string({array}, '|'), '')"


def wide(text: str) -> str:
    return rf"regexp_replace({text}, '({SEP})', '\1\1', 'g')"


def entities(category: str) -> str:
    return f"regexp_extract_all(wide, {word(ENTITIES[category])}, 1)"


def boost(category: str) -> str:
    start = "greatest(instr(low, lower(h)) - 80, 1)"
    snippet = f"substr(text, {start}, instr(low, lower(h)) + length(h) + 80 - {start})"
    return f"len(list_filter(list_distinct(e_{category}), lambda h: {has(snippet, AMPLIFIERS)})) > 0"


def _marked(text: str) -> str:
    """Entities of category alpha between chr(1) and chr(2).

    Two passes: the first leaves out every other one of a run of neighbours.
    """
    for _ in range(2):
        text = (
            f"regexp_replace({text}, '(?i)(^|{UNMARKED_SEP})({ENTITIES['alpha']})($|{UNMARKED_SEP})', "
            r"'\1' || chr(1) || '\2' || chr(2) || '\3', 'g')"
        )
    return text


def _at_entity() -> str:
    position = "(length(replace(array_to_string(pieces[1:i-1], ''), chr(2), '')) + 1)"
    size = "length(split_part(pieces[i], chr(2), 1))"
    start = f"greatest({position} - 40, 1)"
    window = f"substr(low, {start}, {position} + {size} + 40 - {start})"
    return f"len(list_filter(range(2, len(pieces) + 1), lambda i: {has(window, AMPLIFIERS)})) > 0"


def scored(
    source: str = "SELECT * FROM documents",
    text: str = "text",
    threshold: int = 1,
    scores: bool = False,
    ml_threshold: float = 0.7,
    skip_explicit: bool = False,
    skip_categories: bool = False,
) -> str:
    """CTEs ending in ``scored``: the source's columns plus every decision.

    With ``scores`` the source brings ml_label, ml_score, alpha_score,
    beta_score, gamma_score and safe_score.
    """
    k = threshold
    by_score = {c: f"coalesce({c}_score >= {ml_threshold}, false)" if scores else "false" for c in CATEGORIES}
    toxic = (
        "coalesce(ml_label IN ('TOXIC', 'SEVERE_TOXIC', 'OBSCENE', 'THREAT', 'INSULT', 'IDENTITY_HATE', 'LABEL_1') "
        f"AND ml_score >= {ml_threshold}, false)"
        if scores
        else "false"
    )
    model = (
        f"""
      WHEN coalesce(safe_score, 0) > coalesce(alpha_score, 0) AND coalesce(alpha_score, 0) < {ml_threshold}
        THEN 'ml_safe(' || printf('%.2f', coalesce(safe_score, 0)) || '>' || printf('%.2f', coalesce(alpha_score, 0)) || ')'
      WHEN coalesce(alpha_score, 0) >= {ml_threshold}
        THEN 'ml_confirmed(racial=' || printf('%.2f', coalesce(alpha_score, 0)) || ')'"""
        if scores
        else ""
    )
    comma = ",\n  "
    return rf"""
WITH source_rows AS ({source}),
base AS (
  SELECT *, {text} AS the_text, lower({text}) AS low, {wide(text)} AS wide, {wide(f"lower({text})")} AS low_wide
  FROM source_rows),
ruled AS (
  SELECT *, {evidence("the_text", EXPLICIT["en"])} AS ev_en, {evidence("the_text", EXPLICIT["de"])} AS ev_de,
  {comma.join(f'{evidence("the_text", RULES[c])} AS r_{c}' for c in CATEGORIES)}
  FROM base),
mentioned AS (
  SELECT *, {comma.join(f"CASE WHEN len(r_{c}) < {k} THEN {entities(c)} ELSE [] END AS e_{c}" for c in CATEGORIES)}
  FROM ruled),
boosted AS (
  SELECT *, {comma.join(f"({boost(c).replace('substr(text', 'substr(the_text')}) AS b_{c}" for c in CATEGORIES)}
  FROM mentioned),
raised AS (
  SELECT *,
  {comma.join(f"(len(r_{c}) >= {k} OR b_{c} OR {by_score[c]}) AS raised_{c}" for c in CATEGORIES)},
  {comma.join(f"CASE WHEN b_{c} THEN list_concat(r_{c}, e_{c}[1:3]) ELSE r_{c} END AS m_{c}" for c in CATEGORIES)}
  FROM boosted),
looked_at AS (
  SELECT *,
  raised_alpha AND {has("low", HARD)} AS hard,
  CASE WHEN raised_alpha THEN {count("low_wide", SAFE)} ELSE 0 END AS safe,
  CASE WHEN raised_alpha THEN {count("low_wide", AMPLIFIERS)} ELSE 0 END AS insults,
  CASE WHEN raised_alpha THEN string_split({_marked("low")}, chr(1)) ELSE [''] END AS pieces
  FROM raised),
targeting AS (SELECT *, {_at_entity()} AS targeted FROM looked_at),
reasoned AS (
  SELECT *,
  CASE
      WHEN NOT raised_alpha THEN ''
      WHEN hard THEN 'hard_slur'
      WHEN safe >= 2 AND insults <= 1 THEN 'safe_context(' || safe || '≥2,insults=' || insults || '≤1)'
      WHEN safe > 0 AND safe > insults THEN 'safe_dominates(' || safe || '>' || insults || ')'
      WHEN NOT targeted AND safe > 0 THEN 'insult_not_targeted_at_entity'{model}
      WHEN targeted THEN 'targeted_insult'
      ELSE 'keyword_match'
  END AS verification_reason
  FROM targeting),
flagged_rows AS (
  SELECT *,
  CASE WHEN raised_alpha THEN verification_reason IN ('hard_slur', 'targeted_insult', 'keyword_match')
       OR verification_reason LIKE 'ml\_confirmed%' ESCAPE '\' END AS alpha_verified,
  list_concat(ev_en, ev_de) AS matched_list,
  CASE WHEN len(ev_en) > 0 AND len(ev_de) > 0 THEN 'both' WHEN len(ev_en) > 0 THEN 'en'
       WHEN len(ev_de) > 0 THEN 'de' ELSE 'unknown' END AS language,
  {"false" if skip_explicit else f"(len(ev_en) + len(ev_de) >= {k} OR {toxic})"} AS is_explicit
  FROM reasoned),
decided AS (
  SELECT *,
  {"false" if skip_categories else "coalesce(alpha_verified, false)"} AS alpha_flagged,
  {"false" if skip_categories else "raised_beta"} AS beta_flagged,
  {"false" if skip_categories else "raised_gamma"} AS gamma_flagged
  FROM flagged_rows),
scored AS (
  SELECT *, (alpha_flagged OR beta_flagged OR gamma_flagged) AS is_sensitive,
  NOT (is_explicit OR alpha_flagged OR beta_flagged OR gamma_flagged) AS keep,
  concat_ws('|', CASE WHEN alpha_flagged THEN 'ALPHA' END, CASE WHEN beta_flagged THEN 'BETA' END,
            CASE WHEN gamma_flagged THEN 'GAMMA' END) AS categories,
  {joined("matched_list")} AS matched,
  {comma.join(f"{joined(f'm_{c}')} AS {c}_matches" for c in CATEGORIES)}
  FROM decided)
"""


DECISION = "language, matched, categories, verification_reason, keep"

DETAIL = """is_explicit AS is_porn, language AS porn_language, matched AS porn_keywords,
CAST(NULL AS DOUBLE) AS porn_ml_score, is_sensitive AS is_sensitive_3r, categories AS three_r_categories,
alpha_matches AS alpha_keywords, beta_matches AS beta_keywords, gamma_matches AS gamma_keywords,
alpha_verified, verification_reason, substr(text, 1, 300) AS text_preview"""


def _sample(array: str) -> str:
    return joined(f"{array}[1:5]")


TABLE = f"""is_explicit AS is_porn, language AS porn_language, {_sample("matched_list")} AS porn_keywords_sample,
CAST(NULL AS DOUBLE) AS porn_ml_score, is_sensitive AS is_sensitive_3r, categories AS three_r_categories,
{_sample("m_alpha")} AS alpha_keywords_sample, {_sample("m_beta")} AS beta_keywords_sample,
{_sample("m_gamma")} AS gamma_keywords_sample, replace(substr(text, 1, 200), chr(10), ' ') AS text_preview"""

COUNTERS = """CAST(count_if(NOT keep) AS BIGINT) AS total_flagged,
CAST(count_if(is_explicit) AS BIGINT) AS total_porn,
CAST(count_if(alpha_flagged) AS BIGINT) AS total_3r_alpha,
CAST(count_if(beta_flagged) AS BIGINT) AS total_3r_beta,
CAST(count_if(gamma_flagged) AS BIGINT) AS total_3r_gamma"""

REMOVED = """, removed AS (
  SELECT DISTINCT doc_id FROM scored
  WHERE NOT keep AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1))
"""


def _quoted(array: str) -> str:
    return f"coalesce(array_to_string(list_transform({array}[1:6], lambda x: '«' || x || '»'), ', '), '')"


def _rule_hit_stats() -> str:
    lists = [("explicit", lang, rules) for lang, rules in EXPLICIT.items()]
    lists += [("category", name, rules) for name, rules in RULES.items()]
    parts = [
        f"SELECT '{kind}' AS kind, '{name}' AS list_name, CAST({i} AS BIGINT) AS ord, '\\b{rule}\\b' AS pattern, "
        f"count(*) AS documents FROM documents WHERE {has('text', rule)}"
        for kind, name, rules in lists
        for i, rule in enumerate(rules)
    ]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE documents > 0"


def _wide_rule_scan() -> str:
    parts = "th er ti on re an ing ed st ou nd ha at en es or nt ea it is hi sh ly ble"
    return rf"""
WITH parts AS (SELECT unnest(string_split('{parts}', ' ')) AS part),
rules AS (SELECT a.part || b.part AS rule, count(*) AS copies FROM parts a, parts b GROUP BY ALL),
words AS (
  SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '{SEP}+')) AS rule FROM documents),
hits AS (SELECT doc_id, sum(copies) AS n FROM words JOIN rules USING (rule) GROUP BY doc_id)
SELECT d.doc_id, coalesce(h.n, 0) > 0 AS is_explicit, CAST(coalesce(h.n, 0) AS BIGINT) AS rules_hit
FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id"""


def _mixed_rule_scan() -> str:
    parts = "th er ti on re an ing ed st ou nd ha at en es or nt ea it is hi sh ly ble".split()
    pairs = [(a, b) for a in parts for b in parts]
    literal = ", ".join(f"'{a}{b}'" for i, (a, b) in enumerate(pairs) if i % 14 != 13)
    cores = []
    for i, (a, b) in enumerate(pairs):
        if i % 14 == 13:
            cores.append([f"{a}.?{b}", f"{a}.{{0,20}}{b}", f"{a}.*{b}", f"[{a[0]}x]{a[1:]}{b}"][i // 14 % 4])
    other = " + ".join(f"CAST({has('text', core)} AS INT)" for core in cores)
    return rf"""
WITH rules AS (SELECT rule, count(*) AS copies FROM (SELECT unnest([{literal}]) AS rule) GROUP BY rule),
words AS (SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '{SEP}+')) AS rule FROM documents),
hits AS (SELECT doc_id, sum(copies) AS n FROM words JOIN rules USING (rule) GROUP BY doc_id),
counted AS (SELECT d.doc_id, CAST(coalesce(h.n, 0) + {other} AS BIGINT) AS rules_hit
  FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id)
SELECT doc_id, rules_hit > 0 AS is_explicit, rules_hit FROM counted"""


_CATEGORY_SCORES = ", ".join(
    f"(l.doc_id * {7 * i + 3} % 101) / 100.0::DOUBLE AS {name}_score" for i, name in enumerate([*CATEGORIES, "safe"])
)
_LABEL_SCORES = f"""
SELECT d.*, CASE WHEN l.doc_id IS NULL THEN NULL
       WHEN (l.doc_id % 41 + 60 * l.toxic, 'toxic') > (l.doc_id % 97, 'neutral') THEN 'TOXIC' ELSE 'NEUTRAL' END AS ml_label,
  greatest(l.doc_id % 41 + 60 * l.toxic, l.doc_id % 97) / 100.0::DOUBLE AS ml_score, {_CATEGORY_SCORES}
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

_LENGTH_SCORES = """
SELECT *, CASE WHEN shown % 100 >= 50 THEN 'TOXIC' ELSE 'NEUTRAL' END AS ml_label,
  greatest(0.5::DOUBLE, (shown % 100) / 100.0::DOUBLE) AS ml_score,
  (longer % 90) / 100.0::DOUBLE AS alpha_score, NULL::DOUBLE AS beta_score, NULL::DOUBLE AS gamma_score,
  (longer % 80) / 100.0::DOUBLE AS safe_score
FROM (SELECT *, length(substr(text, 1, 512)) AS shown, length(substr(text, 1, 1024)) AS longer FROM documents)"""


def _skip_switches() -> str:
    runs = {"all": (False, False), "no_explicit": (True, False), "no_categories": (False, True), "none": (True, True)}
    parts = [
        f"SELECT '{name}' AS checks, * FROM ({scored(skip_explicit=a, skip_categories=b)} "
        "SELECT count_if(keep) AS kept, count_if(NOT keep) AS flagged FROM scored)"
        for name, (a, b) in runs.items()
    ]
    return (
        "SELECT checks, CAST(kept AS BIGINT) AS kept, CAST(flagged AS BIGINT) AS flagged FROM ("
        + " UNION ALL ".join(parts)
        + ")"
    )


def oracle_sql() -> dict[str, str]:
    plain = scored()
    reviewed = plain + REMOVED
    keyed = scored("SELECT source AS dataset_id, doc_id AS line_no, text, lang FROM documents")
    flagged = f"SELECT doc_id, {DETAIL} FROM scored WHERE NOT keep"
    not_removed = " FROM scored WHERE doc_id NOT IN (SELECT doc_id FROM removed)"
    matches = ", ".join(f"{c}_matches" for c in CATEGORIES)
    flags = ", ".join(f"{c}_flagged" for c in CATEGORIES)
    return {
        "digit_spellings": plain
        + "SELECT doc_id, is_explicit, language, len(matched_list) AS hits, categories, keep, true AS wording_kept FROM scored",
        "explicit_flags": plain
        + "SELECT doc_id, is_explicit, language, len(matched_list) AS hits, matched FROM scored",
        "explicit_evidence": plain
        + """SELECT doc_id, unnest(range(0, len(matched_list))) AS pos, unnest(matched_list) AS keyword
FROM scored""",
        "explicit_language_counts": plain + "SELECT language, count(*) AS documents FROM scored GROUP BY language",
        "threshold_two": scored(threshold=2)
        + f"SELECT doc_id, is_explicit, {flags}, {matches}, verification_reason, keep FROM scored",
        "wide_rule_scan": _wide_rule_scan(),
        "indexed_rule_scan": _wide_rule_scan(),
        "mixed_rule_scan": _mixed_rule_scan(),
        "category_flags": plain + f"SELECT doc_id, is_sensitive, categories, {flags}, {matches} FROM scored",
        "category_rules": plain
        + f"SELECT doc_id, {', '.join(f'{joined(f"r_{c}")} AS {c}_rules' for c in CATEGORIES)} FROM scored",
        "entity_mentions": f"""WITH base AS (SELECT doc_id, {wide("text")} AS wide FROM documents)
SELECT doc_id, {', '.join(f'{joined(entities(c))} AS {c}_entities' for c in CATEGORIES)} FROM base""",
        "boost_flags": f"""
WITH base AS (SELECT *, lower(text) AS low, {wide("text")} AS wide FROM documents),
mentioned AS (SELECT *, {', '.join(f'{entities(c)} AS e_{c}' for c in CATEGORIES)} FROM base)
SELECT doc_id, {', '.join(f'{boost(c)} AS {c}_boost' for c in CATEGORIES)} FROM mentioned""",
        "conversation_flags": scored("SELECT * FROM conversations") + f"SELECT conv_id, turn, {DECISION} FROM scored",
        "page_flags": scored("SELECT * FROM pages", text="html") + f"SELECT page_id, {DECISION} FROM scored",
        "benchmark_flags": scored("SELECT * FROM benchmark") + f"SELECT item_id, {DECISION} FROM scored",
        "verify_reasons": plain
        + "SELECT doc_id, alpha_verified, verification_reason FROM scored WHERE alpha_verified IS NOT NULL",
        "verify_reason_counts": plain
        + """SELECT regexp_extract(verification_reason, '^[a-z_]*') AS reason, count(*) AS documents
FROM scored GROUP BY 1""",
        "rescue_audit": plain
        + """SELECT doc_id, verification_reason AS reason, alpha_matches AS matches,
substr(text, 1, 100) AS text_start FROM scored WHERE alpha_verified = false""",
        "keep_split": plain
        + """SELECT lang, keep, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars
FROM scored GROUP BY lang, keep""",
        "skip_switches": _skip_switches(),
        "scored_decision": scored(_LABEL_SCORES, scores=True)
        + f"""SELECT doc_id, is_explicit, ml_label, ml_score, {flags}, alpha_score, beta_score, gamma_score,
alpha_verified, verification_reason, keep FROM scored""",
        "model_scores": scored(_LENGTH_SCORES, scores=True)
        + """SELECT doc_id, is_explicit, ml_label, ml_score, alpha_score, safe_score, alpha_flagged, keep
FROM scored""",
        "scorer_batches": scored(_LENGTH_SCORES, scores=True)
        + "SELECT doc_id, ml_label, ml_score, alpha_score, keep, true AS within_batch FROM scored",
        "score_ties": """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'TOXIC' ELSE 'NEUTRAL' END AS table_label,
  CASE WHEN doc_id % 3 = 0 THEN 'TOXIC' ELSE 'NEUTRAL' END AS scorer_label, 0.5::DOUBLE AS score,
  CAST(NULL AS VARCHAR) AS score_error FROM documents""",
        "flagged_report": plain + flagged,
        "flagged_timestamps": plain
        + """SELECT doc_id, strftime(make_timestamp(doc_id * 86413000000 + 250000), '%Y-%m-%dT%H:%M:%S.%f') AS timestamp
FROM scored WHERE NOT keep""",
        "flagged_csv_shape": plain + f"SELECT doc_id, {TABLE} FROM scored WHERE NOT keep",
        "issue_summary": plain + f"SELECT {COUNTERS} FROM scored",
        "issue_summary_by_source": plain + f"SELECT source, {COUNTERS} FROM scored GROUP BY source",
        "issue_tag_preview": plain
        + f"""SELECT doc_id,
concat_ws(' ', CASE WHEN is_explicit THEN 'PORN[' || upper(language) || ']' END,
  CASE WHEN alpha_flagged THEN '3R:ALPHA' END, CASE WHEN beta_flagged THEN '3R:BETA' END,
  CASE WHEN gamma_flagged THEN '3R:GAMMA' END) AS issues,
replace(substr(text, 1, 200), chr(10), ' ↵ ') AS preview,
CASE WHEN is_explicit THEN {_quoted("matched_list")} ELSE '' END AS porn_keywords,
{_quoted("m_alpha")} AS alpha_keywords, {_quoted("m_beta")} AS beta_keywords,
{_quoted("m_gamma")} AS gamma_keywords, CAST(NULL AS VARCHAR) AS ml_score
FROM scored WHERE NOT keep""",
        "rule_hit_stats": _rule_hit_stats(),
        "review_filter_category": plain + flagged + " AND beta_flagged",
        "review_filter_explicit": plain
        + "SELECT doc_id, language AS porn_language FROM scored WHERE is_explicit",
        "review_filter_sensitive": plain + "SELECT doc_id, categories FROM scored WHERE is_sensitive",
        "review_search": plain
        + """SELECT doc_id, substr(text, 1, 300) AS text_preview FROM scored
WHERE NOT keep AND contains(lower(substr(text, 1, 300)), 'worthless')""",
        "review_page": plain
        + """SELECT doc_id, is_explicit AS is_porn, is_sensitive AS is_sensitive_3r,
substr(text, 1, 300) AS text_preview FROM scored WHERE NOT keep ORDER BY doc_id LIMIT 7 OFFSET 14""",
        "review_totals": plain
        + """SELECT count(*) AS total, CAST(ceil(count(*) / 7) AS BIGINT) AS total_pages
FROM scored WHERE NOT keep""",
        "removed_documents": reviewed + "SELECT doc_id FROM removed",
        "reapply_custom_clean": reviewed + "SELECT doc_id, text" + not_removed,
        "reapply_from_scored": reviewed + "SELECT doc_id, text, keep" + not_removed,
        "reapply_counts": reviewed
        + """SELECT (SELECT count(*) FROM scored WHERE doc_id NOT IN (SELECT doc_id FROM removed)) AS records_written,
(SELECT count(*) FROM removed) AS records_removed""",
        "label_confusion": plain
        + """SELECT s.lang, l.toxic = 1 AS expected, NOT s.keep AS actual, count(*) AS documents
FROM scored s JOIN labels l ON s.doc_id = l.doc_id GROUP BY 1, 2, 3""",
        "label_pass_counts": plain
        + """, judged AS (SELECT (l.toxic = 1) = s.is_explicit AND (l.toxic <> 1 OR s.gamma_flagged) AS passed
  FROM scored s JOIN labels l ON s.doc_id = l.doc_id)
SELECT CAST(count_if(passed) AS BIGINT) AS passed, CAST(count_if(NOT passed) AS BIGINT) AS failed FROM judged""",
        "jsonl_round_trip": "SELECT doc_id, lang, text FROM documents",
        "stable_dataset_ids": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'a' ELSE 'b' END AS folder, true AS stable FROM documents",
        "any_shard_names": """
SELECT doc_id, text, CASE WHEN doc_id % 2 = 0 THEN 'compressed' ELSE 'plain' END AS part FROM documents""",
        "rule_files_combined": """
WITH kinds AS (SELECT DISTINCT lang, source, CASE WHEN CAST(regexp_extract(source, '[0-9]+$') AS BIGINT) % 2 = 1 THEN 0 ELSE 1 END AS part
  FROM documents),
rules AS (SELECT row_number() OVER (ORDER BY part, lang, source) - 1 AS ord,
  'part' || part || '-' || lang || '-' || source AS pattern FROM kinds)
SELECT list, ord, pattern FROM rules, (SELECT unnest(['en', 'kinds']) AS list)""",
        "run_accounting": scored("SELECT * FROM documents WHERE doc_id % 7 <> 0")
        + """, lost AS (SELECT count(*) AS n FROM documents WHERE doc_id % 7 = 0)
SELECT count(*) AS total_processed, CAST(count_if(NOT keep) AS BIGINT) AS total_flagged, any_value(n) AS total_rejected,
  true AS named, true AS known_device, CAST(count_if(keep) AS BIGINT) + any_value(n) AS distinct_keys,
  CAST(count_if(keep) AS BIGINT) + any_value(n) AS kept_and_rejected FROM scored, lost""",
        "raw_line_numbers": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents),
filled AS (
  SELECT doc_id, pos, doc_id || chr(9) || regexp_replace(line, '[\s\x{85}\x{A0}\p{Z}]+$', '') AS record
  FROM lines WHERE line <> ''),
trimmed AS (SELECT doc_id, pos, CASE WHEN record LIKE '%' || chr(9) THEN doc_id::VARCHAR ELSE record END AS record
  FROM filled)
SELECT doc_id, count(*) AS records, max(pos) - min(pos) + 1 AS span,
       CAST(sum(length(record)) AS BIGINT) AS chars FROM trimmed GROUP BY doc_id""",
        "rejected_lines": """
SELECT doc_id,
  CASE doc_id % 4 WHEN 0 THEN '{"text": null, "doc_id": ' || doc_id || '}'
    WHEN 1 THEN '{"text": ' || doc_id || ', "doc_id": ' || doc_id || '}'
    WHEN 2 THEN '{"doc_id": ' || doc_id || '}' ELSE doc_id::VARCHAR END AS text,
  CASE doc_id % 4 WHEN 0 THEN 'text is null' WHEN 1 THEN 'text is not a string: BIGINT' ELSE '' END AS reason
FROM labels""",
        "named_corpus_scan": """
SELECT 'prose/en/train' AS dataset_id, count(*) AS documents, CAST(sum(doc_id) AS BIGINT) AS ids,
  CAST(1 AS BIGINT) AS first_no, count(*) AS last_no, CAST(count(*) * (count(*) + 1) // 2 AS BIGINT) AS numbers
FROM documents WHERE lang = 'en' AND doc_id % 10 <> 0""",
        "rule_file_load": r"""
WITH kinds AS (SELECT DISTINCT lang, source, lang || '-' || source AS name FROM documents),
lines AS (
  SELECT lang, source, CASE source WHEN 'src2' THEN '(' || name WHEN 'src3' THEN '(?P<kind>' || name || ')'
    ELSE '\b' || name || '\b' END AS pattern
  FROM kinds WHERE source NOT IN ('src1', 'src4'))
SELECT 'en' AS lang, 'rule' AS kind, row_number() OVER (ORDER BY lines.lang, source) - 1 AS ord, pattern,
  CASE source WHEN 'src2' THEN 'invalid regex' WHEN 'src3' THEN 'not supported by the matching engine'
  ELSE '' END AS reason
FROM lines""",
        "cleaned_corpus_file": plain + "SELECT text FROM scored WHERE keep",
        "flagged_json_file": keyed + f"SELECT line_no, dataset_id, {DETAIL} FROM scored WHERE NOT keep",
        "flagged_csv_file": keyed + f"SELECT line_no, dataset_id, {TABLE} FROM scored WHERE NOT keep",
        "summary_file": plain + f"SELECT {COUNTERS}, count(*) AS total_processed FROM scored",
        "observed_accounting": plain + f"SELECT {COUNTERS}, count(*) AS total_processed FROM scored",
        "cleaned_per_file": plain + "SELECT doc_id, text, true AS in_order, true AS home FROM scored WHERE keep",
        "custom_cleaned_file": reviewed + "SELECT text" + not_removed,
        "stream_screening": plain + f"SELECT doc_id, {DECISION} FROM scored",
        "stream_counters": plain + f"SELECT count(*) AS total_processed, {COUNTERS} FROM scored",
        "stream_line_numbers": """
SELECT count(*) AS lines, count(*) AS distinct_numbers, count(*) AS last_numbers FROM documents""",
        "flagship": plain
        + f"""SELECT lang, count(*) AS total_processed, CAST(count_if(keep) AS BIGINT) AS kept, {COUNTERS}
FROM scored GROUP BY lang""",
    }
