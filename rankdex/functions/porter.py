"""The Porter stemmer (M. F. Porter, 1980, with the author's later changes:
``bli -> ble``, ``logi -> log``, and words of one or two letters kept)."""

from __future__ import annotations

# The suffix tables of the published algorithm.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)

_DERIVED = ((STEP_2, tuple(STEP_2)), (STEP_3, tuple(STEP_3)))


class _Letters(dict):
    """For ``str.translate``: vowels to ``v``, ``y`` kept, all else to ``c``."""

    def __missing__(self, letter: int) -> str:
        self[letter] = "c"
        return "c"


_LETTERS = _Letters({ord("y"): "y", **{ord(vowel): "v" for vowel in "aeiou"}})


def _shape(word: str) -> str:
    """``v`` or ``c`` per letter; ``y`` is a vowel only after a consonant."""
    shape = word.translate(_LETTERS)
    at = shape.find("y")
    while at >= 0:
        kind = "v" if at and shape[at - 1] == "c" else "c"
        shape = shape[:at] + kind + shape[at + 1 :]
        at = shape.find("y", at)
    return shape


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _short(word: str) -> bool:
    """One syllable that ends consonant, vowel, consonant other than w, x, y."""
    shape = _shape(word)
    return shape.endswith("cvc") and shape.count("vc") == 1 and word[-1] not in "wxy"


def _longest_suffix(word: str, suffixes: tuple[str, ...]) -> str | None:
    """The longest of ``suffixes`` that leaves at least one letter."""
    if not word.endswith(suffixes):
        return None
    fitting = [s for s in suffixes if len(s) < len(word) and word.endswith(s)]
    return max(fitting, key=len, default=None)


def stem(word: str) -> str:
    """The stem of one lowercase word."""
    if len(word) < 3:
        return word

    # Plurals.
    if word[-1] == "s":
        if (word.endswith("sses") and len(word) > 4) or (word.endswith("ies") and len(word) > 3):
            word = word[:-2]
        elif word[-2] != "s":
            word = word[:-1]

    # Past and continuous forms.
    if word.endswith("eed") and len(word) > 3:
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        ending = _longest_suffix(word, ("ed", "ing"))
        if ending and "v" in _shape(word[: -len(ending)]):
            word = word[: -len(ending)]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif word[-2:-1] == word[-1] and word[-1] not in "aeiouylsz":
                word = word[:-1]
            elif _short(word):
                word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"

    # Derivational suffixes.
    for table, suffixes in _DERIVED:
        ending = _longest_suffix(word, suffixes)
        if ending and _measure(word[: -len(ending)]) > 0:
            word = word[: -len(ending)] + table[ending]
    ending = _longest_suffix(word, STEP_4)
    if not ending and word.endswith(("sion", "tion")):
        ending = "ion"
    if ending and _measure(word[: -len(ending)]) > 1:
        word = word[: -len(ending)]

    # A final e, and a final double l.
    if word.endswith("e"):
        rest = word[:-1]
        measure = _measure(rest)
        if measure > 1 or (measure == 1 and not _short(rest)):
            word = rest
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word
