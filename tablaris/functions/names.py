"""Header normalization. Runs once per column at schema time, never per row."""

from __future__ import annotations

import re
import unicodedata

_WORD = re.compile(r"[a-z0-9]+")


def normalize_name(name: str) -> str:
    """Lower-case ASCII words of ``name`` joined by single underscores.

    Accents are decomposed and dropped, so ``"Precio del dólar!"`` becomes
    ``"precio_del_dolar"``.
    """
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode("ascii")
    return "_".join(_WORD.findall(plain.lower()))
