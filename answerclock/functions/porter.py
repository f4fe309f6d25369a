"""The suffix-stripping algorithm of M. F. Porter (1980), for one lower-case word.

Words of one or two letters stay as they are, as in the author's own release.
"""

from __future__ import annotations

# Suffix rules of the published algorithm.
PLURALS = {"sses": "ss", "ies": "i", "ss": "ss", "s": ""}
STEP_2 = {
    "ational": "ate",
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "izer": "ize",
    "abli": "able",
    "alli": "al",
    "entli": "ent",
    "eli": "e",
    "ousli": "ous",
    "ization": "ize",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "iveness": "ive",
    "fulness": "ful",
    "ousness": "ous",
    "aliti": "al",
    "iviti": "ive",
    "biliti": "ble",
}
STEP_3 = {
    "icate": "ic",
    "ative": "",
    "alize": "al",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


class _Kinds(dict):
    """Maps a character code to ``v``, ``c`` or ``y`` for ``str.translate``."""

    def __missing__(self, code: int) -> str:
        return "c"


_KINDS = _Kinds({ord(vowel): "v" for vowel in "aeiou"} | {ord("y"): "y"})


def _longest(word: str, suffixes) -> str | None:
    if not word.endswith(tuple(suffixes)):
        return None
    return max((s for s in suffixes if word.endswith(s)), key=len)


def _shape(word: str) -> str:
    """One letter per character: ``v`` for a vowel, ``c`` for a consonant.

    A ``y`` is a vowel after a consonant and a consonant elsewhere.
    """
    shape = word.translate(_KINDS)
    while "y" in shape:
        place = shape.index("y")
        kind = "v" if shape[:place].endswith("c") else "c"
        shape = shape[:place] + kind + shape[place + 1 :]
    return shape


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_syllable(word: str) -> bool:
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _past_and_progressive(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    suffix = _longest(word, ("ed", "ing"))
    if suffix is None or "v" not in _shape(word[: -len(suffix)]):
        return word
    word = word[: -len(suffix)]
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    if _double_consonant(word) and word[-1] not in "lsz":
        return word[:-1]
    if _measure(word) == 1 and _short_syllable(word):
        return word + "e"
    return word


def _replace(word: str, rules: dict[str, str], least: int) -> str:
    suffix = _longest(word, rules)
    if suffix is None or _measure(word[: -len(suffix)]) < least:
        return word
    return word[: -len(suffix)] + rules[suffix]


def _residual(word: str) -> str:
    suffix = _longest(word, STEP_4)
    if suffix is None:
        return word
    kept = word[: -len(suffix)]
    if suffix == "ion" and not kept.endswith(("s", "t")):
        return word
    return kept if _measure(kept) > 1 else word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        kept = word[:-1]
        measure = _measure(kept)
        if measure > 1 or (measure == 1 and not _short_syllable(kept)):
            word = kept
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


def stem(word: str) -> str:
    if len(word) < 3:
        return word
    word = _replace(word, PLURALS, 0)
    word = _past_and_progressive(word)
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _replace(word, STEP_2, 1)
    word = _replace(word, STEP_3, 1)
    return _tidy(_residual(word))
