"""Rules are written for Python's ``re``; Spark matches with Java's engine.

``jvm_pattern`` bridges the few constructs that mean something else there, and
``any_rule`` folds a whole rule list into one alternation that shares common
prefixes, so a document is read once instead of once per rule.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Case-insensitive, "." stops only at \n, Unicode character classes.
FLAGS = "(?idU)"

# A word character as Python sees it (str.isalnum or underscore).
WORD = r"[\p{L}\p{N}_]"
SEPARATOR = r"[^\p{L}\p{N}_]"
# Java looks behind by whole characters only if the lookbehind names one beyond
# the basic plane; this letter adds nothing to the class.
_BEHIND = "[\\p{L}\\p{N}_\U00010400]"
_NOT_AFTER_WORD = f"(?<!{_BEHIND})"
_NOT_BEFORE_WORD = f"(?!{WORD})"
_BOUNDARY = f"(?:(?<={_BEHIND})(?!{WORD})|(?<!{_BEHIND})(?={WORD}))"
_NON_BOUNDARY = f"(?:(?<={_BEHIND})(?={WORD})|(?<!{_BEHIND})(?!{WORD}))"

_OUTSIDE_CLASS = {
    r"\B": _NON_BOUNDARY,
    r"\w": WORD,
    r"\W": r"[^\p{L}\p{N}_]",
    r"\s": r"[\s\x1c-\x1f]",
    r"\S": r"[^\s\x1c-\x1f]",
    r"\v": r"\x0b",
    r"\Z": r"\z",
}
_INSIDE_CLASS = {r"\w": r"\p{L}\p{N}_", r"\s": r"\s\x1c-\x1f", r"\v": r"\x0b", "[": r"\[", "&": r"\&"}

_TOKEN = re.compile(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|.", re.S)
_CLASS_TOKEN = re.compile(r"\\.|.", re.S)
_ZERO_QUANTIFIERS = ("?", "*", "{")
# One character or class with its quantifier.
_ATOM = re.compile(
    r"(?:\\[^A-Za-z0-9]|\[\^?\]?(?:\\.|[^\]\\])*\]|[^\\\[\](){}|*+?^$])"
    r"(?:[?*+]\??|\{\d+(?:,\d*)?\}\??)?"
)
# A class of word characters only.
_WORD_CLASS = re.compile(r"\[[A-Za-z0-9_]+\]")


def _is_word_char(token: str | None) -> bool:
    return token is not None and len(token) == 1 and (token.isalnum() or token == "_")


def _translate_class(token: str) -> str:
    head = "[^" if token.startswith("[^") else "["
    body = token[len(head) : -1]
    if body.startswith("]"):
        body = "\\" + body
    return head + "".join(_INSIDE_CLASS.get(t, t) for t in _CLASS_TOKEN.findall(body)) + "]"


# --- repetition the engine cannot afford ------------------------------------------

# Java's engine recurses once per iteration of a repeated group whose body is not of
# fixed length: on a long text such a rule exhausts the thread's stack. Repeated groups
# of single-character alternatives mean a character class, which it loops over instead.
# Other repetitions above this bound are refused with a reason at load.
REPEAT_BOUND = 64
_SPECIAL = set("\\()|[]*+?{}.^$")
_BACKREF = re.compile(r"\\[1-9]|\\k|\(\?P=")
_REPEAT = re.compile(r"\{(\d+)(?:,(\d*))?\}")


def _closing(tokens: list[str], start: int) -> int:
    depth = 0
    for i in range(start, len(tokens)):
        depth += tokens[i] == "("
        depth -= tokens[i] == ")"
        if depth == 0:
            return i
    return len(tokens) - 1


def _class_part(token: str) -> str | None:
    """What one single-character alternative adds inside a class, else None."""
    if len(token) > 1 and token[0] == "[":
        return None if token.startswith("[^") else token[1:-1]
    if len(token) == 2 and token[0] == "\\":
        return None if token[1] in "bBAZzGk0123456789" else token
    if len(token) == 1 and token not in _SPECIAL:
        return "\\" + token if token in "-^&" else token
    return None


def _many(tokens: list[str], at: int) -> bool:
    """Whether the quantifier at ``at`` allows more than REPEAT_BOUND iterations."""
    if at >= len(tokens):
        return False
    if tokens[at] in ("*", "+"):
        return True
    if tokens[at] == "{":
        found = _REPEAT.match("".join(tokens[at : at + 12]))
        return bool(found) and (found.group(2) == "" or int(found.group(2) or found.group(1)) > REPEAT_BOUND)
    return False


def unrolled(rule: str) -> str:
    """The rule with repeated groups of single-character alternatives as classes.

    ``(?:a|b|[0-9])*`` and ``(a|\\d)+`` match what ``[ab0-9]*`` and ``[a\\d]+`` match; a
    capturing group is only unrolled when no back-reference counts groups.
    """
    tokens = _TOKEN.findall(rule)
    capturing_ok = not _BACKREF.search(rule)
    out, i = [], 0
    while i < len(tokens):
        if tokens[i] == "(":
            end = _closing(tokens, i)
            body = tokens[i + 1 : end]
            plain = body[:2] == ["?", ":"]
            if plain:
                body = body[2:]
            elif body[:1] == ["?"] or not capturing_ok:
                body = None
            if body and end + 1 < len(tokens) and tokens[end + 1] in ("*", "+", "{", "?"):
                alternatives = [body[j] for j in range(0, len(body), 2)]
                bars = [body[j] for j in range(1, len(body), 2)]
                parts = [_class_part(t) for t in alternatives]
                if len(body) % 2 == 1 and all(b == "|" for b in bars) and None not in parts:
                    out.append("[" + "".join(parts) + "]")
                    i = end + 1
                    continue
        out.append(tokens[i])
        i += 1
    return "".join(out)


def repetition_risk(rule: str) -> str | None:
    """Why the rule could exhaust the engine's stack on a long text, else None."""
    tokens = _TOKEN.findall(unrolled(rule))
    for i, token in enumerate(tokens):
        if token != "(":
            continue
        end = _closing(tokens, i)
        if not _many(tokens, end + 1):
            continue
        body = tokens[i + 1 : end]
        body = body[2:] if body[:1] == ["?"] else body
        if any(t in ("|", "*", "+", "?", "{", "(") for t in body):
            return f"a repeated group of varying length ({''.join(tokens[i : end + 2])}) recurses once per repeat"
    return None


def jvm_body(rule: str) -> str:
    """The rule in Java syntax, without flags."""
    tokens = _TOKEN.findall(unrolled(rule))
    out = []
    for i, token in enumerate(tokens):
        if token == r"\b":
            after = tokens[i + 1] if i + 1 < len(tokens) else None
            quantifier = tokens[i + 2] if i + 2 < len(tokens) else None
            if _is_word_char(after) and quantifier not in _ZERO_QUANTIFIERS:
                out.append(_NOT_AFTER_WORD)
            elif i and _is_word_char(tokens[i - 1]):
                out.append(_NOT_BEFORE_WORD)
            else:
                out.append(_BOUNDARY)
        elif len(token) > 1 and token[0] == "[":
            out.append(_translate_class(token))
        else:
            out.append(_OUTSIDE_CLASS.get(token, token))
    return "".join(out)


def jvm_pattern(rule: str) -> str:
    return FLAGS + jvm_body(rule)


def _certain_start(rule: str) -> list[str]:
    """The word characters, or classes of them, that every match of a rule with a leading
    ``\\b`` starts with: two at most."""
    start: list[str] = []
    at = 2
    while rule.startswith(r"\b") and len(start) < 2 and (found := _ATOM.match(rule, at)):
        if not (_is_word_char(found.group()) or _WORD_CLASS.fullmatch(found.group())):
            break
        start.append(found.group())
        at = found.end()
    return start


def never_empty(rule: str) -> bool:
    """Whether every match of the rule is known to cover text."""
    return bool(_certain_start(unrolled(rule))) and "|" not in rule


def scan_pattern(rule: str) -> str:
    """``jvm_pattern`` for a whole scan: looks behind only where the rule's first characters are."""
    rule = unrolled(rule)
    start = "".join(_certain_start(rule))
    if not start or "|" in rule:
        return jvm_pattern(rule)
    start_jvm, rest = jvm_body(start), jvm_body(rule[2:])
    return f"{FLAGS}{start_jvm}(?<!{_BEHIND}{start_jvm}){rest[len(start_jvm) :]}"


# ASCII letters with the characters that equal them when case is ignored.
_VARIANTS = {"s": "sSſ", "k": "kK\u212a", "i": "iIİı"}
_SIMPLE_ATOM = re.compile(r"(\\[^A-Za-z0-9]|\[[A-Za-z0-9_]+\]|[^\\\[])([?*+]\??|\{\d{1,2}(?:,\d{0,2})?\}\??)?")


def _variants(letters: str) -> str:
    return "[" + "".join(_VARIANTS.get(c.lower(), c.lower() + c.upper()) for c in letters) + "]"


def looser_pattern(rule: str) -> str | None:
    """A pattern in RE2 syntax found in every text that the rule is found in (and in some more),
    for a ``\\b…\\b`` rule of ASCII characters, ``.`` and plain classes, else None.

    Characters beyond ASCII never count as word characters: a boundary is found wherever
    the rule finds one, whichever characters the engines call letters.
    """
    body = rule[2:-2]
    atoms = _ATOM.findall(body)
    if not (rule.isascii() and rule.startswith(r"\b") and rule.endswith(r"\b") and "".join(atoms) == body):
        return None
    if not _certain_start(rule):
        return None
    out = ["(?:^|[^0-9A-Za-z_])"]
    for atom in atoms:
        found = _SIMPLE_ATOM.fullmatch(atom)
        if not found:
            return None
        one, times = found.groups(default="")
        if one == ".":
            one = r"[^\n]"
        elif one[0] == "[":
            one = _variants(one[1:-1])
        elif one.isalnum():
            one = _variants(one)
        elif one[0] != "\\":
            one = re.escape(one)
        out.append(one + times)
    if _is_word_char(atoms[-1]):
        out.append("(?:$|[^0-9A-Za-z_])")
    return "".join(out)


def word_list_rule(terms: Sequence[str]) -> str:
    """One rule for a lexicon: whole words, alternatives tried in list order."""
    return r"\b(?:" + "|".join(terms) + r")\b"


def word_hits(text: Column, terms: Sequence[str]) -> Column:
    """All non-overlapping hits of a word list, in text order."""
    atoms = [_ATOM.findall(t) for t in terms]
    simple = all("".join(a) == t and _is_word_char(a[0]) for a, t in zip(atoms, terms))
    # A term that ends in the separator its neighbour needs must not read separators.
    simple = simple and all(_is_word_char(_last_certain(a)) for a in atoms)
    body = "|".join(jvm_body(t) for t in terms)
    after = _NOT_BEFORE_WORD if simple and all(_is_word_char(a[-1]) for a in atoms) else _BOUNDARY
    if simple:
        # Reading the separator before a word is cheaper than looking behind.
        return F.regexp_extract_all(_spaced(text), F.lit(f"{FLAGS}{SEPARATOR}({body}){after}"), F.lit(1))
    return F.regexp_extract_all(text, F.lit(f"{FLAGS}{_BOUNDARY}(?:{body}){after}"), F.lit(0))


def word_list_body(terms: Sequence[str]) -> str:
    """A word list in Java syntax, for use inside larger patterns."""
    return jvm_body(word_list_rule(terms))


def _spaced(text: Column) -> Column:
    """The text behind a space, so that its first word too follows a separator."""
    return F.concat(F.lit(" "), text)


# --- unions ------------------------------------------------------------------

_NEEDS_OWN_SCAN = re.compile(r"\\[1-9]|\\k|\(\?P|\(\?\(")


def _last_certain(atoms: Sequence[str]) -> str:
    """The last atom that is not a quantified letter: optional letters at the end still
    leave a letter before the boundary."""
    return next((a for a in reversed(atoms) if not (len(a) > 1 and _is_word_char(a[0]))), "")


def _whole_word_atoms(rule: str) -> list[str] | None:
    """Atoms of a ``\\b…\\b`` rule without groups or alternatives, else None."""
    if not (rule.startswith(r"\b") and rule.endswith(r"\b") and len(rule) > 4):
        return None
    body = rule[2:-2]
    atoms = _ATOM.findall(body)
    if "".join(atoms) != body or not (_is_word_char(atoms[0]) or _WORD_CLASS.fullmatch(atoms[0])):
        return None
    if not _is_word_char(_last_certain(atoms)):
        return None
    return [a.lower() if a.isascii() and a.isalpha() else jvm_body(a) for a in atoms]


def _shared_prefixes(sequences: Iterable[Sequence[str]]) -> str:
    root: dict = {}
    for atoms in sequences:
        node = root
        for atom in atoms:
            node = node.setdefault(atom, {})
        node[None] = {}

    def render(node: dict) -> str:
        branches = [atom + render(child) for atom, child in node.items() if atom is not None]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        return f"(?:{body})?" if None in node else body

    return render(root)


def any_rule(text: Column, rules: Sequence[str]) -> Column:
    """True iff any rule is found in ``text``; null text gives null.

    Whole-word rules become one alternation with shared prefixes, tried only
    behind separators; other rules a second one. Only the yes/no answer is
    kept: not which rule hit, nor what it covered.
    """
    words, others, alone = [], [], []
    for rule in dict.fromkeys(rules):
        atoms = _whole_word_atoms(rule)
        if _NEEDS_OWN_SCAN.search(rule):
            alone.append(text.rlike(jvm_pattern(rule)))
        elif atoms is not None:
            words.append(atoms)
        else:
            others.append(f"(?:{jvm_body(rule)})")
    tests = []
    if words:
        pattern = f"{FLAGS}{SEPARATOR}{_shared_prefixes(words)}{_NOT_BEFORE_WORD}"
        tests.append(_spaced(text).rlike(pattern))
    if others:
        tests.append(text.rlike(FLAGS + "|".join(others)))
    tests += alone
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


# --- literal rules -------------------------------------------------------------

# The only characters beyond ASCII that equal an ASCII letter when
# case is ignored, and the letters they equal.
_FOLDED_FROM, _FOLDED_TO = "ſKİı", "skii"


def folded(col: Column) -> Column:
    """Case-folded form in which a hit of a literal rule equals its literal."""
    return F.lower(F.translate(col, _FOLDED_FROM, _FOLDED_TO))


def literal_of(rule: str) -> str | None:
    """The lower-case wording of a whole-word rule made of plain ASCII, else None."""
    atoms = _whole_word_atoms(rule)
    if atoms is None or not rule.isascii():
        return None
    letters = [a[1] if len(a) == 2 and a[0] == "\\" else a for a in atoms]
    if any(len(letter) != 1 or atom == "." for letter, atom in zip(letters, atoms)):
        return None
    return "".join(letters)


def begun_by(literals: Iterable[str]) -> dict[str, list[int]]:
    """For literals that start with another literal at a word end: those lengths."""
    known = set(literals)
    lengths = {
        literal: [
            i
            for i in range(1, len(literal))
            if literal[:i] in known and _is_word_char(literal[i - 1]) != _is_word_char(literal[i])
        ]
        for literal in known
    }
    return {literal: found for literal, found in lengths.items() if found}


def literal_hits(text: Column, literals: Sequence[str]) -> Column:
    """The longest literal at each place that has one, in text order."""
    escaped = [[c if c.isalnum() or c in " _" else "\\" + c for c in literal] for literal in literals]
    pattern = f"{FLAGS}{SEPARATOR}(?=({_shared_prefixes(escaped)}){_NOT_BEFORE_WORD})"
    return F.regexp_extract_all(_spaced(text), F.lit(pattern), F.lit(1))


def word_starts_inside(literal: str) -> list[str]:
    """What follows each later word start of a literal."""
    return [
        literal[i:]
        for i in range(1, len(literal))
        if _is_word_char(literal[i]) and not _is_word_char(literal[i - 1])
    ]


def independent_words(terms: Sequence[str]) -> list[str] | None:
    """The literals of a word list if no two of them can share text, else None.

    Only then is "found anywhere" the same as "found by reading the list's
    pattern from left to right".
    """
    literals = [literal_of(rf"\b{t}\b") for t in terms]
    if None in literals or begun_by(literals):
        return None
    for literal in literals:
        for rest in word_starts_inside(literal):
            if any(rest.startswith(other) or other.startswith(rest) for other in literals):
                return None
    return list(dict.fromkeys(literals))
