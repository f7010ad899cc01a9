"""Plain-Python statement of two text rules, for brute-force comparison."""

import re


def negated(sentence: str) -> bool:
    words = "not|never|no longer|isn't|can't|cannot|won't|false|incorrect|deprecated"
    return re.search(rf"\b({words})\b", sentence, re.IGNORECASE) is not None


def numbers(sentence: str) -> set[str]:
    pattern = r"\b\d+(?:\.\d+)?\s*(?:%|percent|million|billion|thousand)?\b"
    return {m.strip() for m in re.findall(pattern, sentence)}
