"""Porter stemmer for English words (M. F. Porter, 1980).

Follows the published algorithm with the departures common in language tool
kits, which scoring libraries rely on: a short list of irregular forms, words of
one or two letters left alone, ``-ies``/``-ied`` kept as ``-ie`` after a single
letter, ``y`` turned to ``i`` only after a consonant that is not the first
letter, and the extra suffixes ``-alli`` re-reduced, ``-fulli`` and ``-logi``.
"""

from __future__ import annotations

# Irregular forms and suffix tables of the algorithm.
_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
_STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "fulli": "ful", "logi": "log",
}
_STEP3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
_STEP4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()
# The suffixes of each table, longest first.
_ENDS2, _ENDS3, _ENDS4 = (tuple(sorted(t, key=len, reverse=True)) for t in (_STEP2, _STEP3, _STEP4))


def _shape(word: str) -> str:
    """Letters as v(owel) / c(onsonant); y is a vowel after a consonant."""
    out: list[str] = []
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double_end(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    shape = _shape(word)
    if len(word) == 2:
        return shape == "vc"
    return shape[-3:] == "cvc" and word[-1] not in "wxy"


def _longest(word: str, suffixes: tuple[str, ...]) -> str | None:
    return next(filter(word.endswith, suffixes)) if word.endswith(suffixes) else None


def _plural(w: str) -> str:
    if w.endswith("ies"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith("s") and not w.endswith("ss"):
        return w[:-1]
    return w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        if w.endswith(suffix) and _has_vowel(w[: -len(suffix)]):
            stem = w[: -len(suffix)]
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double_end(stem):
                return stem if stem[-1] in "lsz" else stem[:-1]
            if _measure(stem) == 1 and _short_end(stem):
                return stem + "e"
            return stem
    return w


def _final_y(w: str) -> str:
    if w.endswith("y") and len(w) > 2 and _shape(w[:-1])[-1] == "c":
        return w[:-1] + "i"
    return w


def _step2(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _step2(w[:-4] + "al")
    suffix = _longest(w, _ENDS2)
    if suffix is None:
        return w
    stem = w[: -len(suffix)]
    measured = w[:-3] if suffix == "logi" else stem
    return stem + _STEP2[suffix] if _measure(measured) > 0 else w


def _step3(w: str) -> str:
    suffix = _longest(w, _ENDS3)
    if suffix and _measure(w[: -len(suffix)]) > 0:
        return w[: -len(suffix)] + _STEP3[suffix]
    return w


def _step4(w: str) -> str:
    suffix = _longest(w, _ENDS4)
    if suffix is None:
        return w
    stem = w[: -len(suffix)]
    if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
        return stem
    return w


def _step5(w: str) -> str:
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short_end(w[:-1])):
            w = w[:-1]
    if w.endswith("ll") and _measure(w[:-1]) > 1:
        w = w[:-1]
    return w


def porter(word: str) -> str:
    if word in _IRREGULAR:
        return _IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _step2, _step3, _step4, _step5):
        word = step(word)
    return word
