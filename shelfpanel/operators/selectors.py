"""Selector texts of the settings file as lists of steps.

A step names a tag and tests that it must pass. Forms: ``#id``, ``.class``, ``tag.class[attr='v']``, ``a > b``, ``a b``;
``//tag[@attr='v']``, ``/tag[2]``, ``contains(@attr, 'v')``, ``contains(text(), 'v')``, ``contains(., 'v')``, ``and``,
``/following-sibling::tag``, and a row found by its header cell, ``//tr[th[contains(text(), 'v')]]/td``. A child step is taken as any
element inside the step before it.
"""

import re
from dataclasses import dataclass

INSIDE, AFTER = "inside", "after"


@dataclass(frozen=True)
class Step:
    """An element inside the one found before, or the cell after it. ``tests``: (kind, name, value) with the kinds ``is``, ``has``
    and ``word`` of an attribute, ``own`` and ``text`` of what the element shows; ``nth`` counts from 1."""

    tag: str = "*"
    tests: tuple[tuple[str, str, str], ...] = ()
    nth: int = 1
    axis: str = INSIDE


@dataclass(frozen=True)
class Rule:
    """Where a field may be found: its text, or the value of ``attribute``; only in ``countries`` if any are given."""

    name: str
    steps: tuple[Step, ...]
    attribute: str | None = None
    countries: frozenset[str] | None = None


_QUOTED = r"""(?:'([^']*)'|"([^"]*)")"""
_CSS_PART = re.compile(rf"#([\w-]+)|\.([\w-]+)|\[([\w-]+)(\*?=){_QUOTED}\]|\[([\w-]+)\]")
_CSS_SIMPLE = re.compile(r"\s*>?\s*((?:\[[^\]]*\]|[^\s>\[])+)")
_PATH_STEP = re.compile(r"\.?(//?)(following-sibling::)?([\w*]+)((?:\[(?:[^\[\]]|\[[^\[\]]*\])*\])*)")
_PREDICATES = re.compile(r"\[((?:[^\[\]]|\[[^\[\]]*\])*)\]")
_IS = re.compile(rf"@([\w-]+)\s*=\s*{_QUOTED}$")
_CONTAINS = re.compile(rf"contains\(\s*(?:@([\w-]+)|(text\(\))|(\.))\s*,\s*{_QUOTED}\s*\)$")
_HEADER = re.compile(r"(\w+)\[(.*)\]$")


def css_steps(value: str) -> tuple[Step, ...]:
    steps, at = [], 0
    while at < len(value.rstrip()):
        found = _CSS_SIMPLE.match(value, at)
        if not found:
            raise ValueError(f"unknown selector: {value}")
        part, at = found[1], found.end()
        tag = re.match(r"[\w*]*", part)[0]
        tests, inner = [], len(tag)
        while inner < len(part):
            t = _CSS_PART.match(part, inner)
            if not t:
                raise ValueError(f"unknown selector: {value}")
            inner = t.end()
            if t[1]:
                tests.append(("is", "id", t[1]))
            elif t[2]:
                tests.append(("word", "class", t[2]))
            elif t[3]:
                tests.append(("is" if t[4] == "=" else "has", t[3], t[5] if t[5] is not None else t[6]))
            else:
                tests.append(("has", t[7], ""))
        steps.append(Step(tag or "*", tuple(tests)))
    return tuple(steps)


def _tests(predicate: str) -> tuple[list[tuple[str, str, str]], int]:
    tests, nth = [], 1
    for part in re.split(r"\s+and\s+", predicate.strip()):
        if part.isdigit():
            nth = int(part)
        elif found := _IS.match(part):
            tests.append(("is", found[1], found[2] if found[2] is not None else found[3]))
        elif found := _CONTAINS.match(part):
            value = found[4] if found[4] is not None else found[5]
            tests.append(("has", found[1], value) if found[1] else ("own" if found[2] else "text", "", value))
        elif re.fullmatch(r"@[\w-]+", part):
            tests.append(("has", part[1:], ""))
        else:
            raise ValueError(f"unknown test: {predicate}")
    return tests, nth


def path_steps(value: str) -> tuple[Step, ...]:
    steps, at, after = [], 0, False
    while at < len(value):
        found = _PATH_STEP.match(value, at)
        if not found:
            raise ValueError(f"unknown selector: {value}")
        at = found.end()
        tests, nth, header = [], 1, None
        for predicate in _PREDICATES.findall(found[4]):
            if child := _HEADER.match(predicate.strip()):
                header = Step(child[1], tuple(_tests(child[2])[0]))
            else:
                more, place = _tests(predicate)
                tests, nth = tests + more, max(nth, place)
        axis = AFTER if found[2] or after else INSIDE
        after = header is not None
        steps.append(header or Step(found[3], tuple(tests), nth, axis))
    return tuple(steps)


def steps_of(by: str, value: str) -> tuple[Step, ...]:
    """Steps of a selector as the settings write it."""
    if by == "XPATH":
        return path_steps(value)
    if by == "CSS_SELECTOR":
        return css_steps(value)
    names = {"ID": ("is", "id"), "NAME": ("is", "name"), "CLASS_NAME": ("word", "class")}
    if by in names:
        return (Step(tests=((*names[by], value),)),)
    raise ValueError(f"unknown kind of selector: {by}")


def rule(selector: str, name: str | None = None, attribute: str | None = None, countries=None) -> Rule:
    """A rule from one selector text: a path if it begins with a slash, else CSS."""
    steps = path_steps(selector) if selector.lstrip(".").startswith("/") else css_steps(selector)
    return Rule(name or selector, steps, attribute, frozenset(countries) if countries else None)


def settings_rules(settings: dict[str, dict], key: str, default: list[Rule], attribute: str | None = None) -> list[Rule]:
    """Rules of a field from the settings of all countries, in the order each country lists them.

    ``settings``: country to its merged rules. Countries with the same list share rules; a country without the key has the default.
    """
    lists: dict[tuple, set[str]] = {}
    for country, rules in settings.items():
        listed = tuple((s["by"], s["value"]) for s in (rules or {}).get(key) or [] if s and s["by"])
        lists.setdefault(listed, set()).add(country)
    if set(lists) <= {()}:
        return default
    out: list[Rule] = []
    for listed, countries in lists.items():
        if listed:
            out += [Rule(value, steps_of(by, value), attribute, frozenset(countries)) for by, value in listed]
        else:
            out += [Rule(r.name, r.steps, r.attribute, frozenset(countries)) for r in default if not r.countries or r.countries & countries]
    return out
