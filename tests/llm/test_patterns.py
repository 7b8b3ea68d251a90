"""Trees of expressions, and the trigrams every match must hold."""

import random
import re

import pytest

from vitalmart.llm import patterns, secrets


def test_trees():
    a, b = ("set", {"a"}), ("set", {"b"})
    assert patterns.parse("ab") == [a, b]
    assert patterns.parse("a|b") == [("either", [[a], [b]])]
    assert patterns.parse("(?:a)+?b{2,}a{3}b{1,2}a?") == [
        ("repeat", 1, None, [("group", [a])]), ("repeat", 2, None, [b]), ("repeat", 3, 3, [a]), ("repeat", 1, 2, [b]), ("repeat", 0, 1, [a]),
    ]
    assert patterns.parse(r"[ab][a-z][^a]\x41\.\d.") == [
        ("set", {"a", "b"}), ("set", None), ("set", None), ("set", {"A"}), ("set", {"."}), ("set", None), ("set", None),
    ]
    assert patterns.parse(r"^(?=a)\b(?<!b)\1$") == [("free",)] * 6
    assert patterns.parse(r"[]a][a-][\]\-x]") == [("set", {"]", "a"}), ("set", {"a", "-"}), ("set", {"]", "-", "x"})]
    assert patterns.parse("a{x}") == [a, ("set", {"{"}), ("set", {"x"}), ("set", {"}"})]


@pytest.mark.parametrize("pattern", ["(a", "a)", "[a", "a\\", "[a[b]]", "[a&&b]", "(?<a"])
def test_unreadable_expressions_are_refused(pattern):
    with pytest.raises(ValueError):
        patterns.parse(pattern)


def test_every_match_fulfils_the_query():
    rng = random.Random(7)

    def expression(depth=0):
        kind = rng.randint(0, 7 if depth < 3 else 2)
        if kind <= 1:
            return "".join(rng.choice("abcA") for _ in range(rng.randint(1, 5)))
        if kind == 2:
            return rng.choice(["[ab]", "[a-c]", "[^a]", ".", r"\x62", r"[abcA]"])
        if kind == 3:
            return "(?:" + "|".join(expression(depth + 1) for _ in range(rng.randint(1, 3))) + ")"
        if kind == 4:
            return "(" + expression(depth + 1) + ")" + rng.choice(["*", "+", "?", "{2}", "{1,3}", "{2,}"])
        return expression(depth + 1) + expression(depth + 1)

    found = 0
    for _ in range(1500):
        pattern = expression()
        query = secrets.trigram_query(pattern)
        text = "".join(rng.choice("abcA") for _ in range(60))
        for m in re.finditer(pattern, text):
            low = m[0].lower()
            found += query is not None
            assert query is None or any(all(t in low for t in clause) for clause in query), (pattern, m[0])
    assert found > 150
