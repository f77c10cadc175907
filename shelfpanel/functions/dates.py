"""Date parsing and formatting."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfpanel.functions.text import lookup, or_not_found

PANEL_FORMAT = "MM/dd/yyyy"
EVENT_FORMAT = "yyyy-MM-dd"
# Month names of the languages of the marketplaces.
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "it": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
}
# A day, a month by name and a year in either order: "March 5, 2021", "5. März 2021", "5 de marzo de 2021".
MONTH_FIRST = r"^\s*(\p{L}+)\.?\s+(\d{1,2}),?\s+(\d{4})\s*$"
DAY_FIRST = r"^\s*(\d{1,2})(?:\.|er|º|°)?\s+(?:de\s+)?(\p{L}+)\.?,?\s+(?:de\s+|del\s+)?(\d{4})\s*$"


def month_numbers() -> dict[str, int]:
    """Number of every month name and of its short forms of three letters or more, of all languages; a form that could
    be two months is left out."""
    found: dict[str, set[int]] = {}
    for names in MONTHS.values():
        for i, name in enumerate(names.split(), 1):
            for size in range(3, len(name) + 1):
                found.setdefault(name[:size], set()).add(i)
    return {form: numbers.pop() for form, numbers in found.items() if len(numbers) == 1}


def panel_date(c: Column) -> Column:
    """``MM/dd/yyyy`` text (one or two digits) to a date; null if it is not one."""
    return F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(c, "M/d/yyyy"))


def iso_date(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(c, "yyyy-M-d"))


def panel_text(d: Column) -> Column:
    return F.date_format(d, PANEL_FORMAT)


def event_text(d: Column) -> Column:
    return F.date_format(d, EVENT_FORMAT)


def named_date(c: Column) -> Column:
    """A date with a month name in any of the languages; null if it is not one, or no day of the calendar."""
    first = c.rlike(MONTH_FIRST)

    def part(in_first: int, in_day: int) -> Column:
        return F.when(first, F.regexp_extract(c, MONTH_FIRST, in_first)).otherwise(F.regexp_extract(c, DAY_FIRST, in_day))

    month = lookup(month_numbers(), F.lower(part(1, 2))).cast("string")
    return F.try_to_date(F.concat_ws("-", part(3, 3), F.coalesce(month, F.lit("none")), part(2, 1)), "yyyy-M-d")


def date_created(c: Column) -> Column:
    """Date text with a month name in any language of the marketplaces, ``yyyy-MM-dd`` or ``M/d/yyyy``, in panel form, else not found."""
    return or_not_found(panel_text(F.coalesce(panel_date(c), iso_date(c), named_date(c))))
