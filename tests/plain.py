"""A plain, test-only statement of what screening means, on single strings."""

import re
from types import SimpleNamespace

ANY_CASE = re.IGNORECASE | re.UNICODE


def words(terms):
    return re.compile(r"\b(?:" + "|".join(terms) + r")\b", ANY_CASE) if terms else re.compile(r"(?!)")


def evidence(text, rules):
    found = (re.search(rule, text, ANY_CASE) for rule in rules)
    return [hit[0] for hit in found if hit]


def screened(text, pack, threshold=1, window=80, tight=40, label_scores=None, cutoff=0.7):
    amplifier = words(pack.amplifiers)
    lists = {lang: evidence(text, rules) for lang, rules in pack.explicit}
    hitting = [lang for lang, found in lists.items() if found]
    explicit = [match for found in lists.values() for match in found]
    result = SimpleNamespace(
        explicit=len(explicit) >= threshold,
        language="both" if len(hitting) > 1 else hitting[0] if hitting else "unknown",
        explicit_matches=explicit,
        flags={},
        matches={},
        verified=None,
        reason="",
    )
    for category in pack.categories:
        found = evidence(text, category.rules)
        raised = len(found) >= threshold
        if not raised:
            mentions = words(category.entities).findall(text)
            spots = ((text.lower().find(m.lower()), m) for m in mentions)
            if any(
                amplifier.search(text[max(0, at - window) : at + len(m) + window]) for at, m in spots if at >= 0
            ):
                raised, found = True, found + mentions[:3]
        if label_scores is not None:
            raised = raised or label_scores.get(category.score_label, 0) >= cutoff
        if raised and category.verified:
            result.verified, result.reason = second_look(
                text.lower(), pack, category, amplifier, tight, label_scores, cutoff
            )
            raised = result.verified
        result.flags[category.name], result.matches[category.name] = raised, found
    result.keep = not (result.explicit or any(result.flags.values()))
    return result


def second_look(low, pack, category, amplifier, tight, label_scores, cutoff):
    if words(category.hard).search(low):
        return True, "hard_slur"
    safe, insults = len(words(category.safe).findall(low)), len(amplifier.findall(low))
    if safe >= 2 and insults <= 1:
        return False, f"safe_context({safe}≥2,insults={insults}≤1)"
    if safe > 0 and safe > insults:
        return False, f"safe_dominates({safe}>{insults})"
    aimed = any(
        amplifier.search(low[max(0, m.start() - tight) : m.end() + tight])
        for m in words(category.verify_entities).finditer(low)
    )
    if safe and not aimed:
        return False, "insult_not_targeted_at_entity"
    if label_scores is not None:
        bad, good = label_scores.get(category.score_label, 0), label_scores.get(pack.safe_label, 0)
        if bad < cutoff and good > bad:
            return False, f"ml_safe({good:.2f}>{bad:.2f})"
        if bad >= cutoff:
            return True, f"ml_confirmed(racial={bad:.2f})"
    return True, "targeted_insult" if aimed else "keyword_match"
