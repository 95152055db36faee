"""Column expressions on paths, file names and web addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from archivolt.functions.text import host


def bare_host(url: Column) -> Column:
    """Host without a leading 'www.' (F7)."""
    return F.regexp_replace(host(url), r"^www\.", "")


def host_label(url: Column) -> Column:
    """Bare host with dots as dashes."""
    return F.translate(bare_host(url), ".", "-")


def token_after(url: Column, name: str) -> Column:
    """Path segment after ``/name/``, null without one (F8)."""
    return F.nullif(F.regexp_extract(url, f"/{name}/([^/]*)", 1), F.lit(""))


def leading_tokens(name: Column, n: int = 2, separator: str = "_") -> Column:
    """The first n tokens of a name, null where there are fewer."""
    parts = F.split(name, separator)
    return F.when(F.size(parts) >= n, F.array_join(F.slice(parts, 1, n), separator))


def replay_url(base: str, timestamp: Column, url: Column, flag: str = "") -> Column:
    """Address of a capture in a replay service."""
    return F.concat(F.lit(base.rstrip("/") + "/"), timestamp, F.lit(flag + "/"), url)


def from_template(template: str, mark: str, value: Column) -> Column:
    """A template with its mark replaced by a value."""
    return F.replace(F.lit(template), F.lit(mark), value)


def path_to_url(path: Column, root: str, base: str, extension: str | None = None, lower: bool = True, strip_extension: bool = False) -> Column:
    """A file path as a web address: new root, '%20' as '-', slashes, case, extension."""
    p = F.replace(F.replace(F.replace(path, F.lit(root), F.lit(base)), F.lit("\\"), F.lit("/")), F.lit("%20"), F.lit("-"))
    p = F.replace(p, F.lit(" "), F.lit("-"))
    if lower:
        p = F.lower(p)
    if strip_extension:
        p = F.regexp_replace(p, r"\.[^./]*$", "")
    elif extension:
        p = F.regexp_replace(p, r"\.[^./]*$", "." + extension)
    return p


def safe_file_name(name: Column, most: int = 200) -> Column:
    """A name without characters that file systems refuse, at most so long."""
    clean = F.regexp_replace(F.translate(name, '<>:"/\\|?*', "_________"), r"^[ .]+|[ .]+$", "")
    return F.substring(clean, 1, most)


def plain_name(name: Column) -> Column:
    """Letters, digits, '_' and '-' only, blanks as '_' (F16)."""
    return F.replace(F.rtrim(F.regexp_replace(name, r"[^\p{L}\p{N} _-]", "")), F.lit(" "), F.lit("_"))


def caption_extension(kind: Column) -> Column:
    """Extension of a caption format."""
    k = F.lower(kind)
    return F.when(F.contains(k, F.lit("vtt")), "vtt").when(F.contains(k, F.lit("srt")), "srt").when(F.contains(k, F.lit("xml")) | F.contains(k, F.lit("dfxp")), "xml").otherwise("txt")


def local_name(tag: Column) -> Column:
    """A tag without its namespace."""
    return F.substring_index(tag, "}", -1)


def parent_segment(path: Column) -> Column:
    """The last folder of a path, '' at the top."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2)).otherwise(F.lit(""))


def capture_time(text: Column) -> Column:
    """Time of a capture in either usual layout; null where neither fits."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX")), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))


def without_controls(text: Column) -> Column:
    """Text without control characters; replacement characters as '?' (F50)."""
    return F.regexp_replace(F.replace(text, F.lit("�"), F.lit("?")), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def display_name(name: Column, title: Column) -> Column:
    """Name, else title, else 'Unknown' (F51)."""
    return F.coalesce(F.nullif(name, F.lit("")), F.nullif(title, F.lit("")), F.lit("Unknown"))


def digest_kind(header: str) -> str:
    """Digest type that a checksum column's header names; SHA-1 unless it says otherwise."""
    h = header.lower()
    return "MD5" if "md5" in h else "SHA-256" if "sha256" in h.replace("-", "") else "SHA-1"
