"""Text out of the bytes of a file, by the charset it names itself. All inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rategrid.functions.text import let

# What bytes 0x80 to 0x9F stand for in windows-1252, in order, with the five
# that it leaves open as themselves. Pages that say ISO-8859-1 or ASCII mean windows-1252.
_WESTERN_HIGH = (
    "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f"
    "\x90‘’“”•–—˜™š›œ\x9džŸ"
)
_LATIN_HIGH = "".join(map(chr, range(0x80, 0xA0)))
_WESTERN = ["iso-8859-1", "iso8859-1", "iso_8859-1", "latin1", "latin-1", "l1", "cp1252", "windows-1252", "us-ascii", "ascii"]
#: Bytes in which a meta element is looked for.
HEAD = 4096
_META = r"""(?is)<meta\b[^>]*?\bcharset\s*=\s*["']?\s*([A-Za-z0-9][A-Za-z0-9._:+-]*)"""


def named_charset(content: Column, default: str) -> Column:
    """Charset of a file by its byte order mark, a meta element near its start, or ``default``; lower case."""
    mark = F.hex(F.substring(content, 1, 3))
    # Every byte is a character of Latin-1, so the tag can be read before the charset is known.
    start = F.decode(F.substring(content, 1, HEAD), "ISO-8859-1")
    meta = F.lower(F.regexp_extract(start, _META, 1))
    return (
        F.when(mark == "EFBBBF", "utf-8")
        .when(mark.startswith("FEFF"), "utf-16be")
        .when(mark.startswith("FFFE"), "utf-16le")
        # A tag that could be read is not in UTF-16, whatever it says.
        .when(meta.startswith("utf-16"), "utf-8")
        .when(meta != "", meta)
        .otherwise(default.lower())
    )


def _by_name(content: Column, charset: Column) -> Column:
    """Bytes by any charset the JVM knows, NULL for one it does not."""
    escaped = F.regexp_replace(F.hex(content), "(..)", "%$1")
    return F.call_function(
        "try_reflect", F.lit("java.net.URLDecoder"), F.lit("decode"), escaped, charset
    )


def _text(content: Column, charset: Column) -> Column:
    western = F.translate(F.decode(content, "ISO-8859-1"), _LATIN_HIGH, _WESTERN_HIGH)
    return (
        F.when(charset.isin("utf-8", "utf8"), F.make_valid_utf8(content.cast("string")))
        .when(charset.isin(*_WESTERN), western)
        .otherwise(_by_name(content, charset))
    )


def decoded(content: Column, default: str = "UTF-8") -> Column:
    """``struct<text, charset>`` of a file's bytes, without its byte order mark.

    Bytes that are no text of the charset become replacement characters; a charset that
    is not known counts as ``default``. NULL bytes give NULL.
    """
    def read(charset: Column) -> Column:
        text = _text(content, charset)
        known = F.when(text.isNotNull(), charset).otherwise(default.lower())
        whole = F.coalesce(text, _text(content, F.lit(default.lower())))
        return F.struct(F.regexp_replace(whole, r"^\x{FEFF}", "").alias("text"), known.alias("charset"))

    return F.when(content.isNotNull(), let(named_charset(content, default), read))
