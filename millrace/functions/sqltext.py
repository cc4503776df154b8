"""Small building blocks for Spark SQL text."""

from __future__ import annotations

from collections.abc import Iterable


def lit(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lits(texts: Iterable[str]) -> str:
    return ", ".join(lit(t) for t in texts)


def let(value: str, name: str, body: str) -> str:
    """Evaluate ``value`` once and refer to it as ``name`` inside ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def first_not_null(array: str) -> str:
    return f"try_element_at(filter({array}, z -> z IS NOT NULL), 1)"


def if_chain(branches: Iterable[tuple[str, str]], otherwise: str = "NULL") -> str:
    """Nested ``IF``: the value of the first condition that holds.

    Inside a lambda a ``CASE`` looks its branches up by position in a linked list, so its cost grows with the
    square of their number; nested ``IF`` does not.
    """
    text = otherwise
    for condition, value in reversed(list(branches)):
        text = f"IF({condition}, {value}, {text})"
    return text


def case_of(subject: str, branches: dict[str, str], otherwise: str = "NULL") -> str:
    return if_chain([(f"{subject} = {lit(k)}", v) for k, v in branches.items()], otherwise)
