"""Plain Python versions of the operators' contracts, for small tables."""

import hashlib
import re

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def pii_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = [
        ("email", EMAIL, lambda m: True), ("ip", IP, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", CARD, lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))), ("phone", PHONE, lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return base(text, rules)


def secret_base(text):
    return base(text, [
        ("assign", ASSIGN, lambda m: len(m[1]) >= 12), ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
    ])


def base(text, rules):
    found = [(m.start(), rank, m.end(), kind) for rank, (kind, p, ok) in enumerate(rules) for m in re.finditer(p, text or "") if ok(m)]
    text = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))
    return {k: sum(f[3] == k for f in found) for k, _, _ in rules}, hashlib.sha256(text.encode()).hexdigest(), text
