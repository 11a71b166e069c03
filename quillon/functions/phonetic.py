"""NYSIIS phonetic keys, after the algorithm's publication."""

from __future__ import annotations

import re


def nysiis(name: str | None) -> str:
    """Key of a name; '' for null or a name without Latin letters."""
    w = re.sub(r"[^A-Z]", "", (name or "").upper())
    if not w:
        return ""
    for a, b in (("MAC", "MCC"), ("KN", "NN"), ("PH", "FF"), ("PF", "FF"), ("SCH", "SSS"), ("K", "C")):
        if w.startswith(a):
            w = b + w[len(a) :]
            break
    for ends, b in ((("EE", "IE"), "Y"), (("DT", "RT", "RD", "NT", "ND"), "D")):
        if w.endswith(ends):
            w = w[:-2] + b
            break
    key, prev, i = w[0], w[0], 1
    while i < len(w):
        c, rest, step = w[i], w[i:], 1
        if rest.startswith("EV"):
            new, step = "AF", 2
        elif c in "AEIOU":
            new = "A"
        elif c == "Q":
            new = "G"
        elif c == "Z":
            new = "S"
        elif c == "M":
            new = "N"
        elif rest.startswith("KN"):
            new, step = "NN", 2
        elif c == "K":
            new = "C"
        elif rest.startswith("SCH"):
            new, step = "SSS", 3
        elif rest.startswith("PH"):
            new, step = "FF", 2
        elif c == "H" and (prev not in "AEIOU" or (i + 1 < len(w) and w[i + 1] not in "AEIOU") or i + 1 == len(w)):
            new = prev if prev in "AEIOU" else prev
        elif c == "W" and prev in "AEIOU":
            new = prev
        else:
            new = c
        for x in new:
            if x != key[-1]:
                key += x
        prev = new[-1]
        i += step
    if len(key) > 1 and key.endswith("S"):
        key = key[:-1]
    if key.endswith("AY"):
        key = key[:-2] + "Y"
    if len(key) > 1 and key.endswith("A"):
        key = key[:-1]
    return key
