"""Numbers as the text formats write them."""

from __future__ import annotations

import struct


def short(x: float) -> str:
    """The shortest text that gives the same 32-bit number, without an exponent; whole numbers without a point."""
    for digits in range(1, 10):
        text = f"{x:.{digits}g}"
        if struct.pack("<f", float(text)) == struct.pack("<f", x):
            return text if "e" not in text else f"{float(text):f}".rstrip("0").rstrip(".") if abs(x) > 1e-6 else text
    return str(x)
