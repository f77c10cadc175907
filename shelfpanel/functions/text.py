"""Text cleaning and field splitting."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfpanel.schemas import NOT_FOUND

# The code points that count as blank space, and the invisible ones that pages carry.
BLANK_CHARS = (
    "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
INVISIBLE_CHARS = "\ufffd\ufeff\u200b\u200c\u200d\u200e\u200f\u00ad"
LOCATION_INVISIBLE_CHARS = (
    "\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\ufeff"
)
CATEGORY_SEPARATOR = "›"
FEATURE_SEPARATOR = " | "


def strip(c: Column) -> Column:
    """Trim every kind of blank (``trim`` alone takes plain spaces only)."""
    return F.trim(c, F.lit(BLANK_CHARS))


def is_only(c: Column, *texts: str) -> Column:
    """Whether a text is blank or one of ``texts`` with blanks around it; null if it is null.

    One pattern that names ``c`` once: it gives up at the first other character, and stays
    small when the optimizer puts a long expression in the place of ``c``.
    """
    words = "|".join(texts)
    return c.rlike(f"^[{BLANK_CHARS}]*(?:{words})?[{BLANK_CHARS}]*$")


def trimmed(c: Column) -> Column:
    """``strip`` that leaves a text alone where its first and last characters are plain, as most are."""

    def plain(end: Column) -> Column:
        return (end >= "!") & (end <= "~")

    return F.when(plain(F.substring(c, 1, 1)) & plain(F.substring(c, -1, 1)), c).otherwise(strip(c))


def single_spaced(c: Column) -> Column:
    """Every run of blanks as one space, none at the ends.

    Mapping the blanks first leaves a search for plain double spaces, which is several times
    faster on long texts than a search for the class of all blanks.
    """
    plain = F.translate(c, BLANK_CHARS, " " * len(BLANK_CHARS))
    return F.trim(F.regexp_replace(plain, " {2,}", " "))


def one_line(c: Column, drop: str = "") -> Column:
    """Single-spaced text with single quotes; carriage returns and ``drop`` are removed."""
    blanks = BLANK_CHARS.replace("\r", "")
    plain = F.translate(c, blanks + '"\r' + drop, " " * len(blanks) + "'")
    return F.trim(F.regexp_replace(plain, " {2,}", " "))


def is_text(c: Column, text: str) -> Column:
    """Whether a text is ``text`` with nothing but blanks around it; null if it is null."""
    return c.rlike(f"^[{BLANK_CHARS}]*{text}[{BLANK_CHARS}]*$")


def is_missing(c: Column) -> Column:
    """Null, blank, the sentinel, or the text 'nan' that an untyped export leaves behind."""
    return F.coalesce(is_only(c, NOT_FOUND, "nan"), F.lit(True))


def null_if_missing(c: Column) -> Column:
    return F.when(~is_missing(c), c)


def clean_text(c: Column) -> Column:
    """One line of visible text: no invisible marks, single spaces, single quotes."""
    return one_line(c, INVISIBLE_CHARS)


def collapse_backslashes(c: Column) -> Column:
    """A run of two or more backslashes becomes one."""
    return F.regexp_replace(c, r"\\{2,}", r"\\")


def final_clean(c: Column) -> Column:
    """Last pass over every text column before a row is stored."""
    single = collapse_backslashes(c)
    return strip(F.replace(F.replace(single, F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" ")))


def lookup(values: dict[str, str | float], key: Column) -> Column:
    """Fixed small table as an expression: the value for ``key``, null where there is none."""
    entries = [F.lit(x) for pair in values.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def or_not_found(c: Column) -> Column:
    return F.coalesce(c, F.lit(NOT_FOUND))


def root_category(c: Column, separator: str = CATEGORY_SEPARATOR) -> Column:
    return strip(F.substring_index(c, separator, 1))


def spaced_category(c: Column, separator: str = CATEGORY_SEPARATOR) -> Column:
    return F.replace(c, F.lit(separator), F.lit(f" {separator} "))


def display_name(c: Column) -> Column:
    """Display-group code to a title: each run of letters starts with a capital."""
    words = F.replace(F.replace(c, F.lit("_display_on_website"), F.lit("")), F.lit("_"), F.lit(" "))
    runs = F.regexp_extract_all(words, F.lit(r"(\p{L}+|[^\p{L}]+)"))
    return or_not_found(F.array_join(F.transform(runs, F.initcap), ""))


def rank_line(c: Column) -> Column:
    """Best-seller text without the trailing remark in brackets."""
    return strip(F.substring_index(c, " (", 1))


def rank_lines(c: Column, n: int = 3) -> list[Column]:
    """First ``n`` lines of a best-seller block, one column per line."""
    lines = F.split(c, "\n")
    return [or_not_found(strip(F.get(lines, F.lit(i)))) for i in range(n)]


def coupon_text(c: Column) -> Column:
    """Text before the first bar and after the last colon of it; blank means not found."""
    offer = strip(F.substring_index(F.substring_index(c, "|", 1), ":", -1))
    one_line = strip(F.regexp_replace(offer, r"[\r\n]+", " "))
    return or_not_found(F.nullif(one_line, F.lit("")))


def size_name(c: Column, max_chars: int = 100) -> Column:
    return F.substring(c, 1, max_chars)


def strip_brand(c: Column, prefix: Column, suffix: Column) -> Column:
    """Remove the store wording of the country around a brand; an empty text removes nothing."""

    def without(value: Column, part: Column) -> Column:
        usable = part.isNotNull() & (part != "")
        return F.when(usable & (value != NOT_FOUND), F.replace(value, part, F.lit(""))).otherwise(value)

    return without(without(c, prefix), suffix)


def category_code(c: Column) -> Column:
    return F.replace(c, F.lit("gl_"), F.lit(""))


def feature_list(features: Column) -> Column:
    """Array of feature texts to one joined text, en dash written as a hyphen."""
    cleaned = F.transform(features, lambda x: one_line(x))
    kept = F.filter(cleaned, lambda x: x.isNotNull() & (x != ""))
    joined = F.replace(F.array_join(kept, FEATURE_SEPARATOR), F.lit("–"), F.lit("-"))
    return or_not_found(F.nullif(joined, F.lit("")))


def location_text(c: Column) -> Column:
    """Delivery-location text with single spaces and without direction marks."""
    return F.translate(single_spaced(c), LOCATION_INVISIBLE_CHARS, "")
