"""String and line helpers. All are Column functions and run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Unicode calls White_Space, i.e. what a
# Unicode-aware \s matches.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

Pattern = str | Column
UNICODE = "(?U)"  # fixed value: character classes by Unicode


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once a row, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def compiled(pattern: Column) -> Column:
    """A pattern held in a column, ready for ``found``; NULL where it does not compile.

    A pattern is data, and a broken one would stop the job at its row. So it is compiled
    once on an empty text in a call that gives NULL in place of an error.
    """
    whole = F.concat(F.lit(UNICODE), pattern)
    tried = F.call_function(
        "try_reflect", F.lit("java.util.regex.Pattern"), F.lit("matches"), whole, F.lit("")
    )
    return F.when(tried.isNotNull(), whole)


def broken(pattern: Column) -> Column:
    """True for a pattern that is there and does not compile."""
    return pattern.isNotNull() & compiled(pattern).isNull()


def found(line: Column, ready: Column) -> Column:
    """True where a ``compiled`` pattern occurs; NULL for one that did not compile.

    ``regexp_instr`` keeps the last compiled pattern, while ``rlike`` compiles it again
    for every line.
    """
    return F.regexp_instr(line, ready) > 0


def matches(line: Column, pattern: Pattern) -> Column:
    r"""True where the pattern occurs in the line.

    Classes such as ``\s`` and ``\d`` hold what Unicode puts there, so a no-break space
    is a blank. A pattern in a column that does not compile is unknown, like a NULL one.
    """
    if isinstance(pattern, str):
        return line.rlike(UNICODE + pattern)
    return found(line, compiled(pattern))


def _with_pattern(pattern: Pattern, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``body`` of the test of a line, with a pattern from a column compiled once a row."""
    if isinstance(pattern, str):
        return body(lambda line: matches(line, pattern))
    return let(compiled(pattern), lambda ready: body(lambda line: found(line, ready)))


def trim_space(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(line: Column) -> Column:
    return line.rlike(r"(?U)^\s*$")


def split_lines(text: Column) -> Column:
    """Lines of a text; line ``i`` of the text is element ``i - 1``."""
    return F.split(text, "\n")


def last_match(lines: Column, pattern: Pattern) -> Column:
    """1-based number of the last line with the pattern, NULL when there is none."""
    return _with_pattern(pattern, lambda hit: last_hit(lines, hit))


def last_hit(lines: Column, hit: Callable[[Column], Column]) -> Column:
    return F.array_max(F.transform(lines, lambda e, i: F.when(hit(e), i + 1)))


def first_match(lines: Column, pattern: Pattern) -> Column:
    return _with_pattern(
        pattern, lambda hit: F.array_min(F.transform(lines, lambda e, i: F.when(hit(e), i + 1)))
    )


def matching(lines: Column, pattern: Pattern) -> Column:
    """The lines with the pattern, in order; none for a pattern that does not compile."""
    return _with_pattern(pattern, lambda hit: F.filter(lines, lambda e: F.coalesce(hit(e), F.lit(False))))


def numbered(lines: Column, before: Column | int = 0) -> Column:
    """``array<struct<line_no bigint, line string>>``, numbered from ``before + 1``."""
    start = F.lit(before) if isinstance(before, int) else before
    return F.transform(
        lines,
        lambda e, i: F.struct(
            (start + i + 1).cast("bigint").alias("line_no"), e.alias("line")
        ),
    )


def drop_matching(rows: Column, pattern: Pattern) -> Column:
    """Numbered rows without those that match; an empty pattern, and one that does not
    compile, keep all."""
    if isinstance(pattern, str):
        return rows if pattern == "" else F.filter(rows, lambda r: ~matches(r["line"], pattern))
    empty = F.coalesce(pattern, F.lit("")) == ""
    return F.when(empty, rows).otherwise(let(compiled(pattern), lambda ready: drop_hits(rows, ready)))


def drop_hits(rows: Column, ready: Column) -> Column:
    """``drop_matching`` with a ``compiled`` pattern."""
    return F.when(ready.isNull(), rows).otherwise(F.filter(rows, lambda r: ~found(r["line"], ready)))


def drop_blank(rows: Column) -> Column:
    return F.filter(rows, lambda r: ~is_blank(r["line"]))
