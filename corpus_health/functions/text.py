"""File names, paths and literal lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpus_health import constants as c


def strings(values: Iterable[str]) -> Column:
    """A configuration list as an array literal."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def starts_with_any(value: Column, prefixes: Iterable[str]) -> Column:
    """Case-insensitive literal prefix test; false for NULL and for no prefixes."""
    prefixes = strings(p.lower() for p in prefixes)
    hit = F.exists(prefixes, lambda p: F.lower(value).startswith(p))
    return F.coalesce(hit, F.lit(False))


def contains_any(value: Column, parts: Iterable[str]) -> Column:
    """Case-insensitive literal substring test; false for NULL and for no parts."""
    parts = strings(p.lower() for p in parts)
    hit = F.exists(parts, lambda p: F.lower(value).contains(p))
    return F.coalesce(hit, F.lit(False))


def same_text(a: Column, b: Column | str) -> Column:
    """Case-insensitive equality; false for NULL."""
    b = F.lit(b) if isinstance(b, str) else b
    return F.coalesce(F.lower(a) == F.lower(b), F.lit(False))


def file_ext(file_name: Column) -> Column:
    """Lower-case text after the last dot, empty when there is none."""
    after_dot = F.lower(F.substring_index(file_name, ".", -1))
    return F.when(F.instr(file_name, ".") > 0, after_dot).otherwise(F.lit(""))


def file_stem(file_name: Column) -> Column:
    """File name without its last extension, lower case."""
    after_dot = F.substring_index(file_name, ".", -1)
    stem = F.substring(file_name, F.lit(1), F.length(file_name) - F.length(after_dot) - 1)
    return F.lower(F.when(F.instr(file_name, ".") > 0, stem).otherwise(file_name))


def category(ext: Column) -> Column:
    """Category of a lower-case extension."""
    out = None
    for name, exts in c.CATEGORIES.items():
        hit = ext.isin(exts)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out.otherwise(F.lit(c.OTHER_CATEGORY))


def special_format(ext: Column) -> Column:
    """struct(label, note) of a special format, NULL for any other extension."""
    entries = []
    for name, (label, note) in c.SPECIAL_FORMATS.items():
        entries += [F.lit(name), F.struct(F.lit(label).alias("label"), F.lit(note).alias("note"))]
    return F.try_element_at(F.create_map(*entries), ext)


def site_path(site_url: Column) -> Column:
    """Server-relative path of a site: no scheme, host or trailing slash."""
    scheme = F.locate("://", site_url)
    slash = F.call_function("locate", F.lit("/"), site_url, scheme + 3)
    path = F.when(slash > 0, F.substring(site_url, slash, F.length(site_url))).otherwise(F.lit(""))
    return F.rtrim(F.when(scheme > 0, path).otherwise(site_url), F.lit("/"))


def relative_path(path: Column, site_url: Column) -> Column:
    """Path below the site; unchanged when the path lies elsewhere."""
    base = F.concat(site_path(site_url), F.lit("/"))
    below = F.lower(path).startswith(F.lower(base))
    return F.when(below, F.substring(path, F.length(base) + 1, F.length(path))).otherwise(path)


def folder_of(rel_path: Column, file_name: Column) -> Column:
    """Relative path without the file name; empty for a file directly under the site."""
    tail = F.concat(F.lit("/"), file_name)
    cut = F.substring(rel_path, F.lit(1), F.length(rel_path) - F.length(tail))
    return (
        F.when(F.lower(rel_path).endswith(F.lower(tail)), cut)
        .when(same_text(rel_path, file_name), F.lit(""))
        .otherwise(rel_path)
    )


def depth_of(rel_path: Column) -> Column:
    """Number of folders above the file, 0 when the path is unknown."""
    slashes = F.length(rel_path) - F.length(F.replace(rel_path, F.lit("/")))
    return F.coalesce(slashes, F.lit(0))


def top_folder(folder: Column) -> Column:
    """First folder below the default library; files above it get a common name."""
    parts = F.array_except(F.split(folder, "/"), strings(c.ROOT_FOLDERS))
    return F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(c.NO_FOLDER))


def folder_parts(folder: Column) -> Column:
    """Folder names of a path, upper case."""
    return F.split(F.upper(F.coalesce(folder, F.lit(""))), "/")


def in_folder_named(folder: Column, names: Iterable[str]) -> Column:
    """True when any folder of the path carries one of the names."""
    return F.arrays_overlap(folder_parts(folder), strings(n.upper() for n in names))


def slug(name: Column, maxlen: int) -> Column:
    """Name usable in a file name; for display, never a key."""
    safe = F.regexp_replace(F.regexp_replace(name, "[^a-zA-Z0-9_-]", "_"), "_+", "_")
    return F.substring(safe, 1, maxlen)


def client_prefix(name: str) -> str:
    """A client's name as it stands in file names."""
    return name.replace(" ", "_").replace(".", "_")
