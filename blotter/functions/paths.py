"""File names as Spark's metadata columns write them."""

from __future__ import annotations

import re
from urllib.parse import unquote


def path_of(file_path: str) -> str:
    """The path to read the file that ``_metadata.file_path`` names: that is an
    encoded URI, while readers take plain paths and patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(file_path))
