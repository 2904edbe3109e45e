"""Plain one-machine versions of the operators' contracts, written from their definitions."""

from __future__ import annotations

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def crc_part(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


# -- personal data -------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [
        ("ip", m.start(), m.end())
        for m in IP.finditer(text)
        if all(int(p) <= 255 for p in m.group().split("."))
    ]
    out += [
        ("card", m.start(), m.end())
        for m in CARD.finditer(text)
        if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))
    ]
    out += [
        ("phone", m.start(), m.end())
        for m in PHONE.finditer(text)
        if 9 <= len(digits(m.group())) <= 15
    ]
    return out


def pii_row(text):
    spans = base_spans(text)
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    counts = [sum(k == kind for k, _, _ in spans) for kind in ("email", "ip", "card", "phone")]
    return (*counts, hashlib.sha256(joined.encode()).hexdigest())


# -- quality rules -------------------------------------------------------------------


def rule_row(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    n, repeated = len(words), len(covered)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        repeated,
        n < 20 or 100 * repeated > 30 * n,
    )


# -- mixing --------------------------------------------------------------------------


def size(text):
    return len(WORD.findall(text or ""))


def targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    free, left, out = set(order), float(sum(sizes.values())), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = 3.0 * sizes[s]
        left -= sum(out[s] for s in over)
        free -= set(over)
    return out


# -- near duplicates -----------------------------------------------------------------


def shingles(text):
    words = WORD.findall(text or "")
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def similar_pairs(texts):
    """Index pairs of texts with Jaccard similarity 0.8 or more, by an inverted index."""
    sets = [shingles(t) for t in texts]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    shared = {}
    for members in holders.values():
        for k, i in enumerate(members):
            for j in members[k + 1 :]:
                shared[i, j] = shared.get((i, j), 0) + 1
    return [
        (i, j) for (i, j), n in shared.items() if 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n)
    ]


def components(n, pairs):
    low = list(range(n))

    def find(x):
        while low[x] != x:
            low[x] = low[low[x]]
            x = low[x]
        return x

    for i, j in pairs:
        a, b = find(i), find(j)
        low[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# -- pages ---------------------------------------------------------------------------

RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def url_row(url):
    """host, path, rule, the rule's verdict."""
    url = url or ""
    at = url.find("://")
    if at < 0:
        return "", "", None, None
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [
        (len(h), len(p), v, h + p)
        for v, h, p in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fit:
        return host, path, None, None
    _, _, verdict, rule = max(fit)
    return host, path, rule, verdict
