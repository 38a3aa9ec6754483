"""Timestamps by a pattern, parsed leniently: fields roll over and trailing text is ignored.

``Lenient("yyyy-MM-dd")`` in the place of a ``date_format`` reads texts as the JVM's
lenient calendar does: ``2017-02-31`` is 3 March, ``25:00:00`` one o'clock on the next
day, month 13 the next January, and whatever follows the last field is not looked at.
A field takes all digits it finds, whatever its pattern's width, unless another field
follows at once (``yyyyMMdd``): then it takes its own width at most.  Blanks before a
field are skipped.  ``S`` counts milliseconds (``.5`` is five of them).

It is a column expression: the pattern becomes one anchored regular expression, and
the value is the first of the month plus a day-time interval.  Years have up to five
digits, milliseconds nine, other fields six; longer ones, signs and text fields
(``MMM``, ``a``, ``z``) do not parse.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pattern letters that are numbers, and their most digits.
FIELDS = {"y": 5, "M": 6, "d": 6, "H": 6, "m": 6, "s": 6, "S": 9}


class Lenient(str):
    """A pattern that is parsed leniently."""

    def __new__(cls, pattern: str) -> Lenient:
        out = super().__new__(cls, pattern)
        out.regex, out.order = _compiled(pattern)
        return out


def _compiled(pattern: str) -> tuple[str, list[str]]:
    pieces = [m.group(0) for m in re.finditer(r"'(?:[^']|'')*'|([A-Za-z])\1*|[^A-Za-z']", pattern)]
    if "".join(pieces) != pattern:
        raise ValueError(f"unclosed quote in pattern {pattern!r}")
    regex, order = "^", []
    for k, piece in enumerate(pieces):
        letter = piece[0]
        if letter == "'":
            text = "'" if piece == "''" else piece[1:-1].replace("''", "'")
            regex += re.escape(text)
        elif not letter.isalpha():
            regex += re.escape(letter)
        elif letter not in FIELDS or (letter == "y" and len(piece) < 3) or (letter == "M" and len(piece) > 2):
            raise ValueError(f"{piece!r} in pattern {pattern!r} cannot be parsed leniently")
        elif letter in order:
            raise ValueError(f"{letter!r} comes twice in pattern {pattern!r}")
        else:
            joined = k + 1 < len(pieces) and pieces[k + 1][0].isalpha()
            regex += "[ \\t]*([0-9]{1,%d})" % len(piece) if joined else "[ \\t]*([0-9]{1,%d})(?![0-9])" % FIELDS[letter]
            order.append(letter)
    if "y" not in order:
        raise ValueError(f"pattern {pattern!r} has no year")
    return regex, order


def lenient_matches(v: Column, pattern: Lenient) -> Column:
    return v.rlike(pattern.regex)


def lenient_timestamp(v: Column, pattern: Lenient) -> Column:
    """The local timestamp of a text that matches, else null.

    One replacement takes all fields out of the text, so the pattern is matched once."""
    fields = F.split(F.regexp_replace(v, f"(?s){pattern.regex}.*$", ",".join(f"${i + 1}" for i in range(len(pattern.order)))), ",")

    def value(of: Column) -> Column:
        def field(letter: str, missing: int) -> Column:
            return F.get(of, pattern.order.index(letter)).cast("int") if letter in pattern.order else F.lit(missing)

        months = field("y", 1970) * 12 + field("M", 1) - 1
        month = F.pmod(months, F.lit(12))
        first = F.make_date(((months - month) / 12).cast("int"), month + 1, F.lit(1)).cast("timestamp_ntz")
        seconds = (field("s", 0) + field("S", 0).cast("decimal(12,3)") / 1000).cast("decimal(18,6)")
        return first + F.make_dt_interval(field("d", 1) - 1, field("H", 0), field("m", 0), seconds)

    return F.when(lenient_matches(v, pattern), F.get(F.transform(F.array(fields), value), F.lit(0)))
