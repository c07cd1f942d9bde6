"""Plain Python versions of the digest queries, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digest(labels: list[str]) -> str:
    return hashlib.sha256(",".join(labels).encode()).hexdigest()


def secrets(text: str | None) -> tuple[int, int, int, str]:
    text = text or ""
    assign = [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    access = [m.span() for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    hexes = [m.span() for m in HEX.finditer(text) if len(m[0]) >= 16]
    every = sorted((s, no, kind, e) for no, (kind, found) in enumerate(
        (("assign", assign), ("access", access), ("hex", hexes))) for s, e in found)
    return len(assign), len(access), len(hexes), digest([f"{kind}:{s}:{e}" for s, _, kind, e in every])


def pii(text: str | None) -> tuple[int, int, int, int, str]:
    text = text or ""
    count = lambda m: len(re.sub("[^0-9]", "", m[0]))
    found = [
        ("email", [m.span() for m in EMAIL.finditer(text)]),
        ("ip", [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]),
        ("card", [m.span() for m in CARD.finditer(text) if 13 <= count(m) <= 19 and luhn(re.sub("[^0-9]", "", m[0]))]),
        ("phone", [m.span() for m in PHONE.finditer(text) if 9 <= count(m) <= 15]),
    ]
    return (*[len(s) for _, s in found], digest([f"{kind}:{s}:{e}" for kind, spans in found for s, e in spans]))
