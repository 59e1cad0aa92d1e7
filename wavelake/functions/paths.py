"""Audio paths written by several tools, brought to one spelling."""

from __future__ import annotations

import re
import unicodedata
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART = r"[A-Za-z0-9_\- ]+(?:\.[A-Za-z0-9_\- ]+)*"
#: Paths that are in their one spelling already.
PLAIN = rf"{_PART}(?:/{_PART})*"
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]*://[^/]*/|[A-Za-z]:/")

# The layout of paths below each dataset's root.
LAYOUT = {
    "fsd50k": r"(?i)(?:^|/)(FSD50K\.\w+_audio/[^/]+)$",
    "urbansound8k": r"(?i)(?:^|/)(audio/fold\d+/[^/]+)$",
    "audioset_strong": r"(?i)(?:^|/)(audio/(?:train|eval)/[^/]+)$",
    "hyenaset": r"(?i)(?:^|/)(wav/[^/]+/[^/]+)$",
    "datased": r"(?i)(?:^|/)(sed/[^/]+)$",
}


def normal_path(path: str | None) -> str | None:
    """``path`` in one spelling, case kept; null for a null or blank path.

    Outer blanks, percent codes, backslashes, empty, ``.`` and ``..`` parts, schemes, drive letters and Unicode forms make no difference.
    """
    if path is None or path != path:
        return None
    p = unicodedata.normalize("NFC", unquote(path.strip())).replace("\\", "/").strip()
    m = _SCHEME.match(p)
    if m:
        p = p[m.end() :]
    parts: list[str] = []
    for x in p.split("/"):
        if x in ("", "."):
            continue
        if x == "..":
            if parts:
                parts.pop()
            continue
        parts.append(x)
    return "/".join(parts) or None


@F.pandas_udf(T.StringType())
def _normal_udf(path: pd.Series) -> pd.Series:
    return pd.Series([None if p is None else normal_path(p) for p in path], dtype=object)


def normal(path: Column) -> Column:
    """``normal_path`` of a column: plain paths stay in the JVM, only others are looked at in Python."""
    bare = F.trim(path)
    plain = bare.rlike(rf"^(?:{PLAIN})\z")
    return F.when(plain, bare).otherwise(_normal_udf(F.when(~plain, path)))


def root_part(normal: Column, dataset: Column) -> Column:
    """What a normal path is below its dataset's root, by the dataset's layout; null where that does not show."""
    out = F.lit(None).cast("string")
    for name, rule in LAYOUT.items():
        out = F.when(dataset == name, F.nullif(F.regexp_extract(normal, rule, 1), F.lit(""))).otherwise(out)
    return out


def below_root(normal: Column, dataset: Column) -> Column:
    """The path below its dataset's root; whole where the layout does not show."""
    return F.coalesce(root_part(normal, dataset), normal)


def recording_key(dataset: Column, clean: Column) -> Column:
    """The file on a disk that ignores case; one key per dataset and file."""
    return F.when(clean.isNotNull(), F.concat(F.coalesce(dataset, F.lit("")), F.lit("\x1f"), F.lower(clean)))
