"""Rule texts that are plain conjunctions, as lists of comparisons of one field with one value."""

from __future__ import annotations

from dataclasses import dataclass

from txnsieve.operators.predicates import COMPARISONS, rule_words, unquoted
from txnsieve.schemas import FIELD_COLUMNS

AMOUNT = "amount"
#: A comparison with its sides exchanged.
_TURNED = {"<": ">", ">": "<", "<=": ">=", ">=": "<=", "==": "==", "!=": "!="}


@dataclass(frozen=True)
class Condition:
    """A field compared with a text or a number."""

    field: str
    sign: str
    text: str | None = None
    number: float | None = None


def _literal(words: list[tuple[str, str]]) -> tuple[str | None, float | None] | None:
    if len(words) == 1 and words[0][0] == "text":
        return unquoted(words[0][1]), None
    sign = -1.0 if len(words) == 2 and words[0] == ("sign", "-") else 1.0
    if words and words[-1][0] == "number" and (len(words) == 1 or sign < 0):
        return None, sign * float(words[-1][1])
    return None


def conditions(expression: str) -> list[Condition] | None:
    """The comparisons of a conjunction; None for any other rule text."""
    parts: list[list[tuple[str, str]]] = [[]]
    for kind, word in rule_words(expression):
        if (kind, word) == ("sign", "&&"):
            parts.append([])
        else:
            parts[-1].append((kind, word))
    found = []
    for part in parts:
        signs = [i for i, (kind, word) in enumerate(part) if kind == "sign" and word in COMPARISONS]
        if len(signs) != 1:
            return None
        left, sign, right = part[: signs[0]], part[signs[0]][1], part[signs[0] + 1 :]
        if len(right) == 1 and right[0][0] == "name":
            left, sign, right = right, _TURNED[sign], left
        value = _literal(right)
        if len(left) != 1 or left[0][0] != "name" or left[0][1] not in FIELD_COLUMNS or value is None:
            return None
        if (left[0][1] == AMOUNT) != (value[1] is not None):
            return None  # two kinds: the column form knows what that means
        found.append(Condition(left[0][1], sign, *value))
    return found
