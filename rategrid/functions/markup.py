"""Links and tables out of HTML.

Both are regular-expression chains that run in the JVM. They are used on markup
that is plain beyond doubt: every ``<`` begins a tag of regular form, no quoted value
holds ``<`` or ``>``, entities are common ones with their ``;``, comments and scripts
don't begin inside a tag; for tables also no spans, nesting or left-out end tags, for
links no ``href`` that was not understood. All other markup, and only that, is handed
as it is to a small parser in an Arrow function; the other rows pass NULL to it.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rategrid.functions.text import trim_space

# Comments, scripts and styles hold no elements; an unclosed one runs to the end.
# Declarations run to the next ">".
_NOT_MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script\b.*?(?:</script\s*>|\z)"
    r"|<style\b.*?(?:</style\s*>|\z)"
    r"|<[!?][^>]*>"
)
_ANCHOR_START = r"(?i)<a(?=[\s>/])"
_ANCHOR = r"""(?i)<a(?=[\s>/])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_OTHER_ATTRIBUTE = (
    r"""\s+(?!href[\s=>])[^\s=>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?"""
)
_HREF = (
    rf"""(?is)^<a(?:{_OTHER_ATTRIBUTE})*+\s+href\s*=\s*"""
    r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
)

# Entities decoded in the JVM; "&amp;" must come last.
COMMON_ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", "\u00a0"), ("&#160;", "\u00a0"), ("&amp;", "&"),
]
# Any other reference, with its semicolon or without.
_RARE_ENTITY = r"&(?!(?:lt|gt|quot|#39|apos|nbsp|#160|amp);)#?[A-Za-z0-9]"
# A tag of regular form.
_TAG = (
    r"""</?[A-Za-z][A-Za-z0-9:-]*+"""
    r"""(?:\s++[A-Za-z_:][A-Za-z0-9_:.-]*+(?:\s*+=\s*+(?:"[^"<>]*+"|'[^'<>]*+'|[^\s"'<>=`/]++(?=[\s>])))?)*+"""
    r"""\s*+/?>"""
)
# What is no markup for the parser, begun inside a tag or a quoted value.
_HIDDEN = r"""(?is)=\s*["'][^"'<>]*<(?:[!?]|script\b|style\b)|<[a-z/][^<>]*<(?:[!?]|script\b|style\b)"""


def element_text(html: Column) -> Column:
    """Markup without comments, scripts and styles."""
    return F.regexp_replace(html, _NOT_MARKUP, "")


def _regular(html: Column, markup: Column) -> Column:
    """True where every ``<`` of the markup is a tag that the expressions here can read."""
    opened = F.length(markup) - F.length(F.replace(markup, F.lit("<"), F.lit("")))
    regular = F.regexp_count(markup, F.lit(_TAG)) == opened
    return regular & ~markup.rlike(_RARE_ENTITY) & ~html.rlike(_HIDDEN)


def _decode_common(text: Column) -> Column:
    for entity, char in COMMON_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


# --- links --------------------------------------------------------------------

_LINKS = T.ArrayType(T.StringType())


class _Reader(HTMLParser):
    def parse_marked_section(self, i, report=1):
        # Sections of unknown kinds are skipped like comments.
        return self.parse_bogus_comment(i, 0)


class _LinkReader(_Reader):
    """``href`` of every anchor."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[str | None] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            given = [value or "" for name, value in attrs if name == "href"]
            self.links.append(given[0] if given else None)


def read_links(html: str) -> list[str | None]:
    reader = _LinkReader()
    reader.feed(html)
    reader.close()
    return reader.links


@F.pandas_udf(_LINKS)
def _read_links(html: pd.Series) -> pd.Series:
    return html.map(lambda text: None if text is None else read_links(text))


def with_links(df: DataFrame, html: str, out: str) -> DataFrame:
    """Add the ``href`` of every anchor in document order; NULL for one without it."""
    raw = F.transform(
        F.regexp_extract_all(F.col("__markup"), F.lit(_ANCHOR), 0),
        lambda a: F.when(
            a.rlike(_HREF),
            F.concat(*[F.regexp_extract(a, _HREF, group) for group in (1, 2, 3)]),
        ),
    )
    links = F.col("__hrefs")
    unseen = F.regexp_count(F.col("__markup"), F.lit(_ANCHOR_START)) != F.size(links)
    parsed = _read_links(F.when(~F.col("__plain"), F.col(html)))
    return (
        df.withColumn("__markup", element_text(F.col(html)))
        .withColumn("__hrefs", raw)
        .withColumn("__plain", _regular(F.col(html), F.col("__markup")) & ~unseen)
        .withColumn(
            out, F.when(F.col("__plain"), F.transform(links, _decode_common)).otherwise(parsed)
        )
        .drop("__markup", "__hrefs", "__plain")
    )


# --- tables -------------------------------------------------------------------

_TABLE_ROWS = T.ArrayType(T.ArrayType(_LINKS))


class _TableReader(_Reader):
    """Rows and cells of every table.

    A row counts for each table around it and a cell for each row around it, so
    an outer table also lists the rows of the tables nested in it.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list]] = []
        self._open: list[dict] = []  # open tables, outermost first

    def _end_row(self) -> None:
        self._open[-1].update(row=None, cell=None)

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
            self._open.append({"rows": self.tables[-1], "row": None, "cell": None})
        elif tag == "tr" and self._open:
            self._end_row()
            row: list = []
            for table in self._open:
                table["rows"].append(row)
            self._open[-1]["row"] = row
        elif tag in ("td", "th") and self._open:
            if self._open[-1]["row"] is None:
                self.handle_starttag("tr", [])
            named = dict(attrs)
            cell = {
                "parts": [],
                "columns": _span(named.get("colspan")),
                "rows": _span(named.get("rowspan")),
                "head": tag == "th",
            }
            for table in self._open:
                if table["row"] is not None:
                    table["row"].append(cell)
            self._open[-1]["cell"] = cell

    def handle_endtag(self, tag):
        if not self._open:
            return
        if tag in ("td", "th"):
            self._open[-1]["cell"] = None
        elif tag == "tr":
            self._end_row()
        elif tag == "table":
            self._open.pop()

    def handle_data(self, data):
        if self.cdata_elem is not None:  # inside a script or style
            return
        for table in self._open:
            if table["cell"] is not None:
                table["cell"]["parts"].append(data)


def _span(value: str | None) -> int:
    try:
        return max(int(value), 1)
    except (TypeError, ValueError):
        return 1


def _fill_spans(rows: list[list[dict]], most: int | None = None) -> list[list[str]]:
    """Repeat a cell over the columns and the existing rows it spans, ``most`` at most."""
    filled: list[list[str]] = []
    hanging: dict[int, tuple[int, str]] = {}  # column -> rows still to fill, text
    for row in rows:
        out: list[str] = []
        later: dict[int, tuple[int, str]] = {}

        def put(text: str, depth: int) -> None:
            if depth > 1:
                later[len(out)] = (depth - 1, text)
            out.append(text)

        for cell in row:
            while len(out) in hanging:
                depth, text = hanging.pop(len(out))
                put(text, depth)
            text = "".join(cell["parts"]).strip()
            for _ in range(cell["columns"] if most is None else min(cell["columns"], most)):
                put(text, cell["rows"] if most is None else min(cell["rows"], most))
        while len(out) in hanging:
            depth, text = hanging.pop(len(out))
            put(text, depth)
        hanging = later
        filled.append(out)
    return filled


def read_tables(html: str, most: int | None = None) -> list[list[list[str]]]:
    reader = _TableReader()
    reader.feed(html)
    reader.close()
    return [_fill_spans(rows, most) for rows in reader.tables]


def read_headed(html: str) -> list[bool]:
    """Per table whether its first row is of header cells."""
    reader = _TableReader()
    reader.feed(html)
    reader.close()
    return [bool(rows and rows[0]) and all(c["head"] for c in rows[0]) for rows in reader.tables]


def _table_reader(most: int | None):
    @F.pandas_udf(_TABLE_ROWS)
    def read(html: pd.Series) -> pd.Series:
        return html.map(lambda text: None if text is None else read_tables(text, most))

    return read


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def _read_headed(html: pd.Series) -> pd.Series:
    return html.map(lambda text: None if text is None else read_headed(text))


# A document's table tags, each followed by a blank: tables one after another, every
# row and cell closed, nothing nested.
_TABLE_TAG = r"(?i)<(/?(?:table|tr|td|th))(?=[\s>/])"
_FLAT_TABLES = r"(?i)^(?:table (?:tr (?:t[dh] /t[dh] )*+/tr )*+/table )*+$"


def _plain_tables(html: Column, markup: Column) -> Column:
    """True where the quick reading of tables is exact."""
    tags = F.array_join(F.regexp_extract_all(markup, F.lit(_TABLE_TAG), 1), " ")
    flat = (tags == "") | F.concat(tags, F.lit(" ")).rlike(_FLAT_TABLES)
    spans = markup.rlike(r"(?i)\b(?:colspan|rowspan)\b")
    return flat & ~spans & _regular(html, markup)


def _inner(text: Column, tag: str) -> Column:
    return F.regexp_extract_all(
        text, F.lit(rf"(?is)<{tag}(?=[\s>/])[^>]*>(.*?)</{tag}\s*>"), 1
    )


def _cell_text(cell: Column) -> Column:
    return trim_space(_decode_common(F.regexp_replace(cell, r"(?s)<[^>]*>", "")))


def _quick_tables(markup: Column) -> Column:
    return F.transform(
        _inner(markup, "table"),
        lambda t: F.transform(
            _inner(t, "tr"), lambda r: F.transform(_inner(r, "t[dh]"), _cell_text)
        ),
    )


def with_table_rows(df: DataFrame, html: str, out: str, most_span: int | None = None) -> DataFrame:
    """Add the cell texts of all tables, ``tables[rows[cells]]``, in document order.

    A cell is repeated over all columns and existing rows that it says it spans. For
    documents that may claim absurd spans ``most_span`` bounds them.
    """
    quick = _quick_tables(F.col("__markup"))
    parsed = _table_reader(most_span)(F.when(~F.col("__plain"), F.col(html)))
    return (
        df.withColumn("__markup", element_text(F.col(html)))
        .withColumn("__plain", _plain_tables(F.col(html), F.col("__markup")))
        .withColumn(out, F.when(F.col("__plain"), quick).otherwise(parsed))
        .drop("__markup", "__plain")
    )


def _headed_rows(markup: Column) -> Column:
    return F.transform(
        _inner(markup, "table"),
        lambda t: F.coalesce(
            F.get(F.transform(_inner(t, "tr"), lambda r: r.rlike(r"(?i)<th(?=[\s>/])") & ~r.rlike(r"(?i)<td(?=[\s>/])")), F.lit(0)),
            F.lit(False),
        ),
    )


def with_headed(df: DataFrame, html: str, out: str) -> DataFrame:
    """Add, for each table in document order, whether its first row is of ``<th>`` cells."""
    parsed = _read_headed(F.when(~F.col("__plain"), F.col(html)))
    return (
        df.withColumn("__markup", element_text(F.col(html)))
        .withColumn("__plain", _plain_tables(F.col(html), F.col("__markup")))
        .withColumn(out, F.when(F.col("__plain"), _headed_rows(F.col("__markup"))).otherwise(parsed))
        .drop("__markup", "__plain")
    )


@F.pandas_udf(T.StructType([T.StructField("tables", _TABLE_ROWS), T.StructField("headed", T.ArrayType(T.BooleanType()))]))
def _read_both(html: pd.Series) -> pd.DataFrame:
    read = [(None, None) if text is None else (read_tables(text), read_headed(text)) for text in html]
    return pd.DataFrame({"tables": [t for t, _ in read], "headed": [h for _, h in read]})


def with_tables(df: DataFrame, html: str, tables: str, headed: str) -> DataFrame:
    """``with_table_rows`` and ``with_headed`` in one reading of the document."""
    return (
        df.withColumn("__markup", element_text(F.col(html)))
        .withColumn("__plain", _plain_tables(F.col(html), F.col("__markup")))
        .withColumn("__read", _read_both(F.when(~F.col("__plain"), F.col(html))))
        .withColumn(tables, F.when(F.col("__plain"), _quick_tables(F.col("__markup"))).otherwise(F.col("__read.tables")))
        .withColumn(headed, F.when(F.col("__plain"), _headed_rows(F.col("__markup"))).otherwise(F.col("__read.headed")))
        .drop("__markup", "__plain", "__read")
    )
