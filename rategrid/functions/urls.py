"""Resolving a link against the page it stands on, and comparing addresses (RFC 3986)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*:"


def _without_dots(path: Column) -> Column:
    """Path with its ``.`` and ``..`` segments worked out; starts with ``/``."""
    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    folder = path.rlike(r"/\.\.?$")
    kept = F.when(folder, F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def absolute_url(base: Column, link: Column) -> Column:
    """Absolute form of ``link`` found on the page ``base``; NULL if either is NULL."""
    scheme = F.regexp_extract(base, f"^({_SCHEME})", 1)
    origin = F.regexp_extract(base, f"^({_SCHEME}//[^/?#]*)", 1)
    base_path = F.regexp_extract(base, f"^{_SCHEME}//[^/?#]*([^?#]*)", 1)
    folder = F.when(base_path == "", F.lit("/")).otherwise(
        F.regexp_extract(base_path, "^(.*/)", 1)
    )
    link_path = F.regexp_extract(link, "^([^?#]*)", 1)
    tail = F.regexp_extract(link, "^[^?#]*(.*)$", 1)
    path = F.when(link.startswith("/"), link_path).otherwise(F.concat(folder, link_path))
    path = F.when(path.rlike(r"/\.\.?(/|$)"), _without_dots(path)).otherwise(path)
    return (
        F.when(link.rlike(f"^{_SCHEME}"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when((link == "") | link.startswith("#"),
              F.concat(F.regexp_extract(base, "^([^#]*)", 1), link))
        .when(link.startswith("?"), F.concat(F.regexp_extract(base, "^([^?#]*)", 1), link))
        .otherwise(F.concat(origin, path, tail))
    )


_AUTHORITY = f"^{_SCHEME}//([^/?#]*)"


def _decoded(text: Column) -> Column:
    """Escapes of letters, digits and ``-._~`` written out, the others in upper case."""

    def escape(piece: Column, i: Column) -> Column:
        code = F.upper(F.substring(piece, 1, 2))
        char = F.chr(F.conv(code, 16, 10).cast("int"))
        plain = code.rlike("^[2-7]") & char.rlike("^[A-Za-z0-9._~-]$")
        rest = F.substring(piece, F.lit(3), F.length(piece))
        return (
            F.when(i == 0, piece)
            .when(~piece.rlike("^[0-9A-Fa-f]{2}"), F.concat(F.lit("%"), piece))
            .when(plain, F.concat(char, rest))
            .otherwise(F.concat(F.lit("%"), code, rest))
        )

    pieces = F.transform(F.split(text, "%"), escape)
    return F.when(text.contains("%"), F.array_join(pieces, "")).otherwise(text)


def url_key(url: Column) -> Column:
    """Normal form of an address, for comparing (RFC 3986, section 6.2); NULL for NULL.

    Scheme and host in lower case, no default port, no fragment, ``/`` for an empty path,
    no ``.`` and ``..`` segments, no escapes that need not be. What is no address of a
    host only loses its fragment and outer blanks.
    """
    bare = F.regexp_extract(F.trim(url), "^([^#]*)", 1)
    scheme = F.lower(F.regexp_extract(bare, f"^({_SCHEME})", 1))
    authority = F.regexp_extract(bare, _AUTHORITY, 1)
    user = F.regexp_extract(authority, "^(.*@)", 1)
    host = F.lower(F.regexp_replace(authority, "^.*@", ""))
    default = F.when(scheme == "http:", ":80").when(scheme == "https:", ":443").otherwise(":")
    port = F.regexp_extract(host, "(:[0-9]*)$", 1)
    host = F.when((port == default) | (port == ":"), F.regexp_replace(host, ":[0-9]*$", "")).otherwise(host)
    path = _decoded(F.regexp_extract(bare, f"^{_SCHEME}//[^/?#]*([^?]*)", 1))
    path = F.when(path == "", "/").when(path.rlike(r"/\.\.?(/|$)"), _without_dots(path)).otherwise(path)
    query = _decoded(F.regexp_extract(bare, r"^[^?]*(\?.*)$", 1))
    return F.when(bare.rlike(_AUTHORITY), F.concat(scheme, F.lit("//"), user, host, path, query)).otherwise(bare)
