"""Photo paths and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens.functions.text import _col, canonical_username


def media_path(has_photo: Column, username: Column | str, id_: Column | str, folder: str) -> Column:
    """``<folder>/<username without @>_<id>.jpg`` for a message with a photo, else NULL."""
    name = F.concat(canonical_username(username), F.lit("_"), _col(id_).cast("string"), F.lit(".jpg"))
    return F.when(has_photo, F.concat(F.lit(folder.rstrip("/") + "/"), name))


def file_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def image_channel(name: Column | str, compat: bool = False) -> Column:
    """Channel of a photo name; ``compat`` cuts at the first underscore. A name without a
    message number is a channel as it stands, without its ending."""
    name = _col(name)
    if compat:
        return F.substring_index(name, "_", 1)
    return F.regexp_replace(F.regexp_replace(name, r"\.jpg$", ""), r"_\d+$", "")
