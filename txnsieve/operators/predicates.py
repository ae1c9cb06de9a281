"""Rule text to typed columns.

Each part of a rule text becomes a column with its kind (number, text, boolean or null), so every
comparison knows what it compares:

- a text and a number are never equal and cannot be ordered, in whatever brackets or calls they stand;
- NaN is equal to nothing, below nothing and above nothing;
- ``!`` binds tighter than any comparison;
- division by zero and null give null, which counts as no match.

From loose to tight: ``? :`` and ``?:``, ``||``, ``&&``, comparisons (``matches`` and ``between``
included), ``+ -``, ``* / %``, ``! -``, and calls of the listed functions and methods. Anything else,
and any combination of kinds without a meaning, is a ``RuleError``.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnsieve.schemas import FIELD_COLUMNS

NUMBER, TEXT, BOOLEAN, NULL = "number", "text", "boolean", "null"

_TOKEN = re.compile(
    r"""(?P<text>'(?:[^']|'')*'|"(?:[^"]|"")*")
      | (?P<number>\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)
      | (?P<name>[A-Za-z_]\w*)
      | (?P<sign>==|!=|<=|>=|&&|\|\||\?:|[<>!()+\-*/%,.?:{}])
      | (?P<space>\s+)""",
    re.VERBOSE,
)
# The word forms of operators.
_SIGN_OF_WORD = {
    "eq": "==", "ne": "!=", "lt": "<", "gt": ">", "le": "<=", "ge": ">=", "and": "&&", "or": "||", "not": "!", "div": "/", "mod": "%",
}
COMPARISONS = {"==", "!=", "<", ">", "<=", ">="}


class RuleError(ValueError):
    """Rule text that cannot become a predicate."""


@dataclass(frozen=True)
class Value:
    kind: str
    column: Column


def _text_function(function: Callable[..., Column], result: str, arguments: int) -> Callable[..., Value]:
    def call(*values: Value) -> Value:
        if len(values) != arguments or any(v.kind != TEXT for v in values):
            raise RuleError(f"needs {arguments} texts")
        column = function(*[v.column for v in values])
        return Value(result, column.cast("double") if result == NUMBER else column)

    return call


def _equals(left: Value, right: Value) -> Value:
    return Value(BOOLEAN, _same(left, right))


_STARTS = _text_function(lambda a, b: a.startswith(b), BOOLEAN, 2)
_ENDS = _text_function(lambda a, b: a.endswith(b), BOOLEAN, 2)
_CONTAINS = _text_function(lambda a, b: a.contains(b), BOOLEAN, 2)
_LENGTH = _text_function(F.length, NUMBER, 1)
_LOWER = _text_function(F.lower, TEXT, 1)
_UPPER = _text_function(F.upper, TEXT, 1)
_FUNCTIONS = {
    "startswith": _STARTS, "endswith": _ENDS, "contains": _CONTAINS, "length": _LENGTH, "lower": _LOWER, "upper": _UPPER,
}
# Methods of a text in the rule language.
_METHODS = {
    "startsWith": _STARTS, "endsWith": _ENDS, "contains": _CONTAINS, "length": _LENGTH, "toLowerCase": _LOWER, "toUpperCase": _UPPER,
    "trim": _text_function(F.trim, TEXT, 1), "isEmpty": _text_function(lambda a: a == "", BOOLEAN, 1),
    "equals": _equals, "equalsIgnoreCase": _text_function(lambda a, b: F.lower(a) == F.lower(b), BOOLEAN, 2),
}


def _same(left: Value, right: Value) -> Column:
    if NULL in (left.kind, right.kind):
        return left.column.isNull() & right.column.isNull()
    if left.kind != right.kind:
        return F.lit(False)
    if left.kind == NUMBER:
        return left.column.eqNullSafe(right.column) & ~F.coalesce(F.isnan(left.column), F.lit(False))
    return left.column.eqNullSafe(right.column)


def _ordered(sign: str, left: Value, right: Value) -> Column:
    if left.kind != right.kind or left.kind not in (NUMBER, TEXT):
        raise RuleError(f"cannot order {left.kind} and {right.kind}")
    a, b = left.column, right.column
    column = {"<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b}[sign]
    return column & ~F.isnan(a) & ~F.isnan(b) if left.kind == NUMBER else column


def _compare(sign: str, left: Value, right: Value) -> Value:
    if sign == "==":
        return _equals(left, right)
    return Value(BOOLEAN, ~_same(left, right) if sign == "!=" else _ordered(sign, left, right))


def _calculate(sign: str, left: Value, right: Value) -> Value:
    if sign == "+" and left.kind == right.kind == TEXT:
        return Value(TEXT, F.concat(left.column, right.column))
    if left.kind != NUMBER or right.kind != NUMBER:
        raise RuleError(f"{sign} needs numbers")
    a, b = left.column, right.column
    return Value(NUMBER, {"+": F.try_add, "-": F.try_subtract, "*": F.try_multiply, "/": F.try_divide, "%": F.try_mod}[sign](a, b))


def _boolean(value: Value) -> Column:
    if value.kind != BOOLEAN:
        raise RuleError(f"{value.kind} is no condition")
    return value.column


class _Reader:
    """Reads one rule text by descending from loose to tight operators."""

    def __init__(self, expression: str) -> None:
        self.words: list[tuple[str, str]] = []
        at = 0
        while at < len(expression):
            match = _TOKEN.match(expression, at)
            if match is None:
                raise RuleError(f"unexpected character {expression[at]!r}")
            at = match.end()
            if match.lastgroup != "space":
                self.words.append((match.lastgroup, match.group()))
        self.at = 0

    def sign(self) -> str:
        """The sign at the current place, word forms included; empty where there is none."""
        if self.at >= len(self.words):
            return ""
        kind, word = self.words[self.at]
        return word if kind == "sign" else _SIGN_OF_WORD.get(word.lower(), "") if kind == "name" else ""

    def take(self, *signs: str) -> str:
        found = self.sign()
        if found not in signs:
            return ""
        self.at += 1
        return found

    def need(self, sign: str) -> None:
        if not self.take(sign):
            raise RuleError(f"{sign} expected")

    def word(self, name: str) -> bool:
        found = self.at < len(self.words) and self.words[self.at] == ("name", name)
        self.at += found
        return found

    def whole(self) -> Value:
        value = self.choice()
        if self.at < len(self.words):
            raise RuleError(f"unexpected {self.words[self.at][1]!r}")
        return value

    def choice(self) -> Value:
        value = self.either()
        if self.take("?:"):
            other = self.choice()
            if value.kind != other.kind:
                raise RuleError("both choices need one kind")
            missing = value.column.isNull() | (value.column == "") if value.kind == TEXT else value.column.isNull()
            return Value(value.kind, F.when(missing, other.column).otherwise(value.column))
        if not self.take("?"):
            return value
        first = self.choice()
        self.need(":")
        second = self.choice()
        if first.kind != second.kind:
            raise RuleError("both choices need one kind")
        return Value(first.kind, F.when(_boolean(value), first.column).otherwise(second.column))

    def either(self) -> Value:
        value = self.both()
        while self.take("||"):
            value = Value(BOOLEAN, _boolean(value) | _boolean(self.both()))
        return value

    def both(self) -> Value:
        value = self.comparison()
        while self.take("&&"):
            value = Value(BOOLEAN, _boolean(value) & _boolean(self.comparison()))
        return value

    def comparison(self) -> Value:
        value = self.sum()
        if sign := self.take(*COMPARISONS):
            return _compare(sign, value, self.sum())
        if self.word("matches"):
            return self.pattern(value)
        if self.word("between"):
            self.need("{")
            low = self.sum()
            self.need(",")
            high = self.sum()
            self.need("}")
            return Value(BOOLEAN, _ordered(">=", value, low) & _ordered("<=", value, high))
        return value

    def pattern(self, value: Value) -> Value:
        kind, word = self.words[self.at] if self.at < len(self.words) else ("", "")
        if kind != "text" or value.kind != TEXT:
            raise RuleError("matches needs a text and a pattern in quotes")
        self.at += 1
        body = unquoted(word)
        try:
            re.compile(body)
        except re.error as error:
            raise RuleError(f"no pattern: {error}") from error
        return Value(BOOLEAN, value.column.rlike(rf"\A(?:{body})\z"))

    def sum(self) -> Value:
        value = self.product()
        while sign := self.take("+", "-"):
            value = _calculate(sign, value, self.product())
        return value

    def product(self) -> Value:
        value = self.prefix()
        while sign := self.take("*", "/", "%"):
            value = _calculate(sign, value, self.prefix())
        return value

    def prefix(self) -> Value:
        sign = self.take("!", "-", "+")
        if not sign:
            return self.calls()
        value = self.prefix()
        if sign == "!":
            return Value(BOOLEAN, ~_boolean(value))
        if value.kind != NUMBER:
            raise RuleError(f"{sign} needs a number")
        return Value(NUMBER, -value.column) if sign == "-" else value

    def calls(self) -> Value:
        value = self.atom()
        while self.take("."):
            kind, name = self.words[self.at] if self.at < len(self.words) else ("", "")
            if kind != "name" or name not in _METHODS or value.kind != TEXT:
                raise RuleError(f"unknown method {name!r}")
            self.at += 1
            value = _called(_METHODS[name], value, *self.arguments())
        return value

    def arguments(self) -> list[Value]:
        self.need("(")
        values: list[Value] = []
        if self.take(")"):
            return values
        values.append(self.choice())
        while self.take(","):
            values.append(self.choice())
        self.need(")")
        return values

    def atom(self) -> Value:
        if self.take("("):
            value = self.choice()
            self.need(")")
            return value
        if self.at >= len(self.words):
            raise RuleError("the text ends too early")
        kind, word = self.words[self.at]
        self.at += 1
        if kind == "text":
            return Value(TEXT, F.lit(unquoted(word)))
        if kind == "number":
            return Value(NUMBER, F.lit(float(word)))
        if kind == "name" and word in FIELD_COLUMNS:
            return Value(NUMBER if word == "amount" else TEXT, F.col(FIELD_COLUMNS[word]))
        if kind == "name" and word.lower() in ("true", "false"):
            return Value(BOOLEAN, F.lit(word.lower() == "true"))
        if kind == "name" and word.lower() == "null":
            return Value(NULL, F.lit(None))
        if kind == "name" and word.lower() in _FUNCTIONS and self.sign() == "(":
            return _called(_FUNCTIONS[word.lower()], *self.arguments())
        raise RuleError(f"unknown name {word!r}" if kind == "name" else f"unexpected {word!r}")


def _called(function: Callable[..., Value], *values: Value) -> Value:
    try:
        return function(*values)
    except TypeError as error:
        raise RuleError("wrong number of arguments") from error


def unquoted(literal: str) -> str:
    return literal[1:-1].replace(literal[0] * 2, literal[0])


def rule_words(expression: str) -> list[tuple[str, str]]:
    """The words of a rule text with their kinds; word forms of operators are signs."""
    words = _Reader(expression).words
    return [("sign", _SIGN_OF_WORD[w.lower()]) if k == "name" and w.lower() in _SIGN_OF_WORD else (k, w) for k, w in words]


def predicate(expression: str) -> Column:
    """The condition of a rule text, over the event columns; null counts as no match."""
    return _boolean(_Reader(expression).whole())
