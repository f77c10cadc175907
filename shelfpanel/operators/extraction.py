"""Fields from stored pages by tables of rules.

A page is cut once into its tags (``page_tags``). All rules are lookups in that array: an element is found by its start tag,
ends where the depth of its tag name returns to zero, and shows the texts of the tags between. Every intermediate value is a column
of a projection of its own, so none is computed twice; see ``found_elements``.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpanel.functions.text import BLANK_CHARS, or_not_found, strip
from shelfpanel.operators.selectors import AFTER, Rule, Step

# The character references that page text is decoded from.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}
# Elements without content or end tag.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]

_QUOTES = r"""(?:"[^"]*+"|'[^']*+')"""
#: A comment, a whole script or style element, or a tag; a ``>`` in quotes does not end a tag. It is the first group of ``TOKEN``.
HEAD = rf"""(?:<!--.*?-->|<(script|style)\b[^>]*+>.*?</\2\s*+>|</?[a-z!?][^>"']*+(?:{_QUOTES}[^>"']*+)*+>|<[a-z/!?][^>]*+>)"""
TOKEN = rf"(?is)({HEAD})([^<]*+(?:<(?![a-z/!?])[^<]*+)*+)"
TAGS, FIRST = "_tags", "_first"


def quoted(value: str) -> str:
    """A text as a literal of SQL."""
    plain = value.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + "".join(c if c.isprintable() else f"\\u{ord(c):04x}" for c in plain) + "'"


def _calls(function: str, first: str, *others: str) -> str:
    return f"{function}({', '.join([first, *map(quoted, others)])})"


# The expressions below are SQL texts: a rule table makes thousands of small expressions, and a text is one call to the JVM.
# ``hit`` is a column or lambda variable that holds a start tag, ``tags`` an array of tags.


def page_tags(html: str) -> str:
    """The tags of a page in order: place ``at``, tag ``name`` in lower case (blank for comments and declarations), ``step`` in depth (1,
    -1, 0 without content), ``head`` (the tag itself, scripts and comments whole) and the ``text`` up to the next tag."""
    parts = [f"regexp_extract_all({html}, {quoted(TOKEN)}, {group}) AS {name}" for group, name in ((1, "head"), (3, "text"))]
    word = _calls("translate", "substring(t.head, 2, 40)", "/>\t\r\n\f", " " * 6)
    name = f"CASE WHEN startswith(t.head, '<!') OR startswith(t.head, '<?') THEN '' ELSE lower(substring_index(ltrim({word}), ' ', 1)) END"
    void = ", ".join(map(quoted, ["", "script", "style", *VOID]))
    named = f"transform(zipped, (t, i) -> struct(i AS at, {name} AS name, t.head AS head, t.text AS text))"
    step = f"CASE WHEN t.name IN ({void}) THEN 0 WHEN startswith(t.head, '</') THEN -1 ELSE 1 END"
    zipped = "arrays_zip(" + ", ".join(p.split(" AS ")[0] for p in parts) + ")"
    named = named.replace("zipped", f"transform({zipped}, z -> struct(z.`0` AS head, z.`1` AS text))", 1)
    return f"transform({named}, t -> struct(t.at AS at, t.name AS name, {step} AS step, t.head AS head, t.text AS text))"


def with_tags(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with their tags instead of their markup."""
    return pages.withColumns({TAGS: F.expr(page_tags(f"`{html}`")), FIRST: F.lit(0)}).drop(html)


def decoded(text: str) -> str:
    for entity, char in ENTITIES.items():
        text = _calls("replace", text, entity, char)
    return text


def attribute_of(head: str, name: str) -> str:
    """Value of an attribute of a tag, blank where it has none."""
    pattern = rf"""(?is)(?<![\w-]){name}\s*=\s*(["'])(.*?)\1"""
    return decoded(f"regexp_extract({head}, {quoted(pattern)}, 2)")


def _from(hit: str, skip: int = 0) -> str:
    """Tags from a found start tag on."""
    return f"slice({TAGS}, {hit}.at - {FIRST} + {1 + skip}, size({TAGS}))"


def element_tags(hit: str) -> str:
    """Tags of an element without its end tag; an element that never ends runs to the end of the page."""
    depth = f"a.depth + CASE WHEN n.name = {hit}.name THEN n.step ELSE 0 END"
    size = f"CASE WHEN a.size >= 0 THEN a.size WHEN {depth} <= 0 THEN a.passed ELSE -1 END"
    size = (
        f"aggregate({_from(hit)}, struct(0 AS depth, 0 AS passed, -1 AS size),"
        f" (a, n) -> struct({depth} AS depth, a.passed + 1 AS passed, {size} AS size),"
        " a -> CASE WHEN a.size < 0 THEN a.passed ELSE greatest(a.size, 1) END)"
    )
    after = f"get({TAGS}, {hit}.at - {FIRST} + 1)"
    # most elements hold a text only: the next tag ends them
    return (
        f"slice({TAGS}, {hit}.at - {FIRST} + 1, "
        f"CASE WHEN {after}.name = {hit}.name AND {after}.step = -1 AND {hit}.step = 1 THEN 1 ELSE {size} END)"
    )


def shown(tags: str) -> str:
    """Visible text of the tags of an element, on one line."""
    joined = decoded(f"array_join(transform({tags}, s -> s.text), '')")
    return f"trim(regexp_replace({_calls('translate', joined, BLANK_CHARS, ' ' * len(BLANK_CHARS))}, ' {{2,}}', ' '))"


def element_text(hit: str) -> str:
    """Visible text of a found element; an element without content has none."""
    return f"CASE WHEN {hit}.step = 0 THEN '' WHEN {hit} IS NOT NULL THEN {shown(element_tags(hit))} END"


def _literal(value: str) -> str:
    return "".join("\\" + c if c in r"\.^$|?*+()[]{}" else c for c in value)


def _passes(step: Step, t: str) -> str:
    """Whether a tag begins an element that fits the step; cheap tests come first."""
    fits, late = [f"{t}.name = {quoted(step.tag.lower())}"] if step.tag != "*" else [], [f"{t}.step >= 0"]
    if step.tag == "*":
        late.append(f"{t}.name <> ''")
    for kind, name, value in step.tests:
        if kind in ("own", "text"):
            said = decoded(f"{t}.text") if kind == "own" else shown(element_tags(t))
            late.append(f"contains({said}, {quoted(value)})")
            continue
        one = _literal(value)
        inner = {"is": one, "has": rf"[^\"']*{one}[^\"']*", "word": rf"(?:[^\"']*\s)?{one}(?:\s[^\"']*)?"}[kind]
        pattern = rf"""(?s)(?<![\w-]){name}\s*=\s*["']{inner}["']""" if value or kind != "has" else rf"(?is)(?<![\w-]){name}\b"
        fits += [f"contains({t}.head, {quoted(value or name)})", f"rlike({t}.head, {quoted(pattern)})"]
    return " AND ".join(fits + late)


def _hit(step: Step, before: str | None, countries: frozenset[str] | None) -> str:
    """First (or ``nth``) tag that fits the step: inside the element ``before``, in the cell after it, or in the whole page."""
    if step.axis == AFTER:
        # the next cell of the row
        cells = f"filter({_from(before, 1)}, t -> t.step = 1 AND t.name IN ({quoted(step.tag)}, 'tr'))"
        return f"CASE WHEN {before} IS NOT NULL THEN get(filter(slice({cells}, 1, 1), t -> t.name = {quoted(step.tag)}), 0) END"
    tags = f"slice({before}_in, 2, size({TAGS}))" if before else TAGS
    found = f"get(filter({tags}, t -> {_passes(step, 't')}), {step.nth - 1})"
    conditions = []
    if countries:
        conditions.append(f"Country IN ({', '.join(map(quoted, sorted(countries)))})")
    # looking into every element costs much: only on pages that have the longest word at all
    words = [max(re.findall(r"\w+", value), key=len, default="") for kind, _, value in step.tests if kind == "text"]
    conditions += [f"contains(array_join(transform({TAGS}, s -> s.text), ''), {quoted(word)})" for word in words if word]
    return f"CASE WHEN {' AND '.join(conditions)} THEN {found} END" if conditions else found


def _with(pages: DataFrame, columns: dict[str, str]) -> DataFrame:
    return pages.withColumns({name: F.expr(sql) for name, sql in columns.items()}) if columns else pages


def found_elements(pages: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """``pages`` (with tags) with a column per rule: the start tag of the element that it finds, null where it finds none.

    Rules that begin alike share their first steps. The elements of each step are columns of one projection, and the ranges that the
    next step looks into are columns of another, since Spark would copy an expression into each place that uses it.
    """
    done: dict[tuple, str] = {}
    own = len(pages.columns)
    for depth in range(max((len(r.steps) for r in rules.values()), default=0)):
        new, ranges = {}, {}
        for r in rules.values():
            key, parent = (r.countries, r.steps[: depth + 1]), (r.countries, r.steps[:depth])
            if len(r.steps) <= depth or key in done:
                continue
            step, before = r.steps[depth], done[parent] if depth else None
            if before and step.axis != AFTER:
                ranges[f"{before}_in"] = f"CASE WHEN {before} IS NOT NULL THEN {element_tags(before)} END"
            done[key] = f"_e{len(done)}"
            new[done[key]] = _hit(step, before, None if depth else r.countries)
        pages = _with(_with(pages, ranges), new)
    return pages.select(*[F.col(f"`{c}`") for c in pages.columns[:own]], *[F.col(done[r.countries, r.steps]).alias(name) for name, r in rules.items()])


def extract_fields(pages: DataFrame, fields: dict[str, list[Rule]], elements: dict[str, Rule] | None = None) -> DataFrame:
    """``pages`` (with tags) with a column per field: what the first rule finds that finds an element, else not found.

    ``elements``: rules whose start tags are kept as columns for the caller.
    """
    rules = {f"_f{i}_{j}": r for i, listed in enumerate(fields.values()) for j, r in enumerate(listed)}
    located = found_elements(pages, rules | (elements or {}))
    chosen, values = {}, {}
    for i, (name, listed) in enumerate(fields.items()):
        if len({r.attribute for r in listed}) > 1:
            raise ValueError(f"the rules of {name} read different attributes")
        hit, value = f"_f{i}", "CAST(NULL AS STRING)"
        if listed:
            chosen[hit] = f"coalesce({', '.join(f'_f{i}_{j}' for j in range(len(listed)))})"
            attribute = listed[0].attribute
            value = f"CASE WHEN {hit} IS NOT NULL THEN {attribute_of(f'{hit}.head', attribute)} END" if attribute else element_text(hit)
        values[name] = or_not_found(strip(F.expr(value)))
    located = _with(located, chosen).withColumns(values)
    return located.drop(*rules, *chosen)


def inner_items(tags: str, parent: str, child: str) -> str:
    """Texts of the ``child`` elements that begin a ``parent`` element, among the tags of a block."""
    before = f"get({tags}, i - 1)"
    blank = _calls("translate", f"{before}.text", BLANK_CHARS, "")
    begins = f"t.step = 1 AND t.name = {quoted(child)} AND {before}.name = {quoted(parent)} AND {before}.step = 1 AND {blank} = ''"
    return f"transform(filter({tags}, (t, i) -> {begins}), t -> {shown(element_tags('t'))})"


def tiles(pages: DataFrame, start: Rule, keep: list[str]) -> DataFrame:
    """One row per element that fits ``start``, with its 1-based place among them; ``pages`` need their tags."""
    cut = _with(pages, {"_starts": f"transform(filter({TAGS}, t -> {_passes(start.steps[0], 't')}), t -> t.at)"})
    # from each start to the next: short arrays for the search of the end
    parts = F.expr(f"transform(_starts, (s, i) -> slice({TAGS}, s + 1, coalesce(get(_starts, i + 1), size({TAGS})) - s))")
    kept = [F.col(f"`{k}`") for k in keep]
    each = cut.select(*kept, F.posexplode(parts).alias("_place", TAGS))
    each = _with(each, {FIRST: f"get({TAGS}, 0).at", "_start": f"get({TAGS}, 0)"})
    return each.select(*kept, (F.col("_place") + 1).alias("Rank"), F.expr(element_tags("_start")).alias(TAGS), FIRST)


def before_suffix(text: Column, suffix: Column) -> Column:
    """Text before the coupon wording, null where the wording is absent."""
    return F.when(text.contains(suffix), strip(F.left(text, F.instr(text, suffix) - 1)))


#: The rungs of the deal of a tile, the first found decides; the last two need the coupon wording.
DEAL_RUNGS = ["top_badge", "deal_badge", "save_deal_badge", "coupon_badge"]


def deal_badge(found: dict[str, Column], suffix: Column) -> Column:
    """Deal shown on a tile, from the texts of the rungs that are configured (null where an element is absent).

    The first element found decides, also when its text yields nothing.
    """
    picked = F.lit(None).cast("string")
    for name in reversed(DEAL_RUNGS):
        if name in found:
            text = found[name]
            picked = F.when(text.isNotNull(), before_suffix(text, suffix) if name in DEAL_RUNGS[2:] else text).otherwise(picked)
    return or_not_found(picked)


def rule_coverage(pages: DataFrame, candidates: dict[str, list[Rule]]) -> DataFrame:
    """How each candidate rule does over ``pages`` (with tags): pages with text, with an empty element, without it.

    ``best`` counts the pages for which it would be picked: the first rule with text, else the first that finds anything.
    """
    rules = {f"_c{i}_{j}": r for i, listed in enumerate(candidates.values()) for j, r in enumerate(listed)}
    texts = found_elements(pages, rules).select(*[F.expr(element_text(c)).alias(c) for c in rules])
    rows = [
        F.array(*[
            F.struct(F.lit(name).alias("field"), F.lit(j + 1).alias("priority"), F.lit(r.name).alias("rule"), F.col(f"_c{i}_{j}").alias("value"))
            for j, r in enumerate(listed)
        ])
        for i, (name, listed) in enumerate(candidates.items())
    ]
    per_field = texts.select(F.explode(F.array(*rows)).alias("found"))
    with_text = F.filter(F.col("found"), lambda x: x["value"] != "")
    present = F.filter(F.col("found"), lambda x: x["value"].isNotNull())
    best = F.coalesce(F.get(with_text, F.lit(0))["priority"], F.get(present, F.lit(0))["priority"])
    long = per_field.select(best.alias("best"), F.inline("found"))
    return long.groupBy("field", "priority", "rule").agg(
        F.count_if(F.col("value") != "").alias("found"),
        F.count_if(F.col("value") == "").alias("found_empty"),
        F.count_if(F.col("value").isNull()).alias("absent"),
        F.count_if(F.col("best") == F.col("priority")).alias("best"),
    )
