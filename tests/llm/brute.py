"""Plain restatements of what the operators compute, for small inputs."""

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def pii(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 13 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def pii_row(text):
    spans = pii(text)
    counts = [sum(s.startswith(k + ":") for s in spans) for k in KINDS]
    return (*counts, hashlib.sha256(",".join(spans).encode()).hexdigest())


def quality_row(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def shingles(text, width=3):
    words = WORD.findall(lowered(text))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(rows, percent=85, width=3):
    """doc_id -> (set size, component) over all linked pairs."""
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    common = {}
    for own in holders.values():
        for k, a in enumerate(own):
            for b in own[k + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return {i: (len(s), top(i)) for i, s in sets.items()}


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lowered(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def url_rule(url, rules):
    host, path = url_parts(url)
    best = None
    for action, rule in rules:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule) > len(best[1]):
                best = (action, rule)
    return best


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n
