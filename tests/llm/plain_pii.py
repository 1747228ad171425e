"""Pseudonyms in plain Python: the same formats, written a second time without Spark."""

from __future__ import annotations

import datetime
import hashlib

import regex
from helpers import luhn

ROUNDS = 8


def draw(key, tweak, step, value):
    return int(hashlib.sha256(f"{key}:{tweak}:{step}:{value}".encode()).hexdigest()[:15], 16)


def feistel(left, right, first, second, key, tweak):
    for step in range(ROUNDS):
        if step % 2:
            right = (right + draw(key, tweak, step, left)) % second
        else:
            left = (left + draw(key, tweak, step, right)) % first
    return left, right


def digits_of(value):
    return "".join(c for c in value if c in "0123456789")


def permuted(digits, key, tweak):
    size, cut = len(digits), len(digits) // 2
    left, right = feistel(
        int(digits[:cut]), int(digits[cut:]), 10**cut, 10 ** (size - cut), key, f"{tweak}:{size}"
    )
    return f"{left:0{cut}}{right:0{size - cut}}"


def filled(shape, digits):
    left = iter(digits)
    return "".join(next(left) if c in "0123456789" else c for c in shape)


def stand_in(value, size, key, tweak):
    block = hashlib.sha256(f"{key}:{tweak}:{value}".encode()).hexdigest()
    return (block * (size // 64 + 1))[:size]


def letters(value, size, key, tweak):
    return stand_in(value, size, key, tweak).translate(str.maketrans("0123456789", "ghijklmnop"))


def email(value, key):
    lower = value.lower()
    host = lower.split("@", 1)[1]
    return f"{letters(lower, 10, key, 'email')}@{letters(host, 8, key, 'host')}.{host.rsplit('.', 1)[1]}"


def credential(value, key):
    head, secret, tail = regex.fullmatch(r'([^=:]*[=:] ?"?)([A-Za-z0-9+/_-]+)("?)', value).groups()
    return head + stand_in(secret, len(secret), key, "secret") + tail


def ip(value, key):
    a, b, c, d = map(int, value.split("."))
    left, right = feistel(a * 256 + b, c * 256 + d, 65536, 65536, key, "ip")
    return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"


FIRST_DAY = datetime.date(1700, 1, 1)


def date(value, key):
    a, b, c = regex.split("[./-]", value)
    month_first = "/" in value and int(a) <= 12
    if "-" in value:
        parts = a, b, c
    else:
        parts = (c, a, b) if month_first else (c, b, a)
    try:
        day = (datetime.date(*map(int, parts)) - FIRST_DAY).days
    except ValueError:
        return value
    if not 0 <= day < 189 * 773:
        return value
    left, right = feistel(day // 773, day % 773, 189, 773, key, "date")
    new = FIRST_DAY + datetime.timedelta(left * 773 + right)
    if "-" in value:
        return new.isoformat()
    width = 2 if regex.match(r"[0-9]{2}[./][0-9]{2}[./]", value) else 1
    d, m = f"{new.day:0{width}}", f"{new.month:0{width}}"
    sign = "." if "." in value else "/"
    return sign.join([m, d, str(new.year)] if month_first else [d, m, str(new.year)])


def ssn(value, key):
    area, group, serial = map(int, value.split("-"))
    if not (1 <= area <= 899 and area != 666 and group and serial):
        return value
    place = area - 1 - (area > 666)
    left, right = feistel(place * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn")
    slot = left // 99
    return f"{slot + 1 + (slot >= 665):03}-{left % 99 + 1:02}-{right + 1:04}"


def phone(value, key):
    digits = digits_of(value)
    return filled(value, digits[:-10] + permuted(digits[-10:], key, "phone"))


def world_phone(value, key):
    digits = digits_of(value)
    if not 8 <= len(digits) <= 15:
        return value
    return filled(value, digits[:2] + permuted(digits[2:], key, "world-phone"))


def card(value, key):
    digits = digits_of(value)
    if not luhn(digits):
        return value
    payload = permuted(digits[:-1], key, "card")
    return filled(value, payload + next(c for c in "0123456789" if luhn(payload + c)))


def pseudonym(value, key):
    if "@" in value:
        return email(value, key)
    if value.startswith("AKIA"):
        return "AKIA" + stand_in(value, 16, key, "access-key").upper()
    if value[0].isalpha():
        return credential(value, key)
    forms = [
        (r"[0-9]+(\.[0-9]+){3}", ip),
        (r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}", date),
        (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", ssn),
        (r"(\+?1[ .-]?)?(\([0-9]{3}\) ?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})", phone),
        (r"\+1[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}", phone),
        (r"\+.*", world_phone),
    ]
    for form, kind in forms:
        if regex.fullmatch(form, value):
            return kind(value, key)
    return card(value, key)


def pseudonymised(text, key, pattern):
    """(text, number of values replaced)."""
    if text is None:
        return None, 0
    count = 0

    def replace(match):
        nonlocal count
        other = pseudonym(match[0], key)
        count += other != match[0]
        return other

    done = regex.sub(pattern, replace, text, flags=regex.ASCII)
    return done, count
