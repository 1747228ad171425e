"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Matches of one pattern are validated by kind. Numbers and dates are permuted
inside their format: a card number becomes another one with a right check
digit, a date another date, a network address another address. Addresses and
credentials without a fixed numeric domain get keyed one-way stand-ins of the
same shape. A value has one pseudonym under a key, so it stays linked across
documents. All of it is SQL expressions on the text; nothing is shuffled.

A text is cut at its matches, the matches are replaced and the parts joined,
so the rest of the text is kept to the last character.

Defined results: null stays null and empty text empty, with 0 found; numbers
that fail validation stay as they are; repeated rows each have their result;
an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import let

ROUNDS = 8
# Days from 1700-01-01 to 2099-12-31: a whole Gregorian cycle, 189 * 773.
FIRST_DAY = "DATE'1700-01-01'"
DATE_MODULI = (189, 773)

OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# The formats that are recognised, tried in this order.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "credential": r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|token|secret|api[_-]?key) ?[=:] ?\"?[A-Za-z0-9+/_-]{8,256}+\"?",
    "ip": rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![0-9]|[/.-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?[0-9]{3}[ .-]?[0-9]{4}|(?<=\+1[ .-]|\+1)[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9])",
    "world_phone": r"\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}(?![0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
}
PATTERN = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())
# Nothing above matches a text without one of these.
HINT = "[0-9@=:]"


def number(digits: Column) -> Column:
    return digits.cast("bigint")


def draw(key: str, tweak: Column | str, step: Column, value: Column) -> Column:
    """A keyed number below 2^60 for a round and half."""
    tweak = F.lit(tweak) if isinstance(tweak, str) else tweak
    seed = F.concat_ws(":", F.lit(key), tweak, step.cast("string"), value.cast("string"))
    return number(F.conv(F.substring(F.sha2(seed, 256), 1, 15), 16, 10))


def feistel(left: Column, right: Column, moduli: tuple, key: str, tweak) -> Column:
    """A permutation of pairs below the two moduli: each half in turn is moved by the other."""
    first, second = (m if isinstance(m, Column) else F.lit(m).cast("bigint") for m in moduli)
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def step(pair: Column, i: Column) -> Column:
        moved_left = (pair["l"] + draw(key, tweak, i, pair["r"])) % first
        moved_right = (pair["r"] + draw(key, tweak, i, pair["l"])) % second
        return F.struct(
            F.when(i % 2 == 0, moved_left).otherwise(pair["l"]).alias("l"),
            F.when(i % 2 == 1, moved_right).otherwise(pair["r"]).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def permuted_digits(digits: Column, key: str, tweak: str) -> Column:
    """Another string of as many digits (two or more)."""
    size = F.char_length(digits)
    cut = F.floor(size / 2).cast("int")
    power = lambda n: F.pow(F.lit(10.0), n).cast("bigint")
    pair = feistel(
        number(F.substring(digits, F.lit(1), cut)),
        number(F.substring(digits, cut + 1, size)),
        (power(cut), power(size - cut)),
        key,
        F.concat(F.lit(f"{tweak}:"), size.cast("string")),
    )
    return let(
        pair,
        lambda p: F.concat(
            F.lpad(p["l"].cast("string"), cut, "0"),
            F.lpad(p["r"].cast("string"), size - cut, "0"),
        ),
    )


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def filled(shape: Column, digits: Column) -> Column:
    """The digits in the places that `shape` has digits in."""
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))

    def place(done: Column, character: Column) -> Column:
        is_digit = character.rlike("^[0-9]$")
        return F.struct(
            F.concat(
                done["text"],
                F.when(is_digit, F.substring(digits, done["at"], F.lit(1))).otherwise(character),
            ).alias("text"),
            (done["at"] + is_digit.cast("int")).alias("at"),
        )

    return F.aggregate(F.split(shape, ""), start, place, lambda done: done["text"])


def check_digit(payload: Column) -> Column:
    """The Luhn digit that completes a string of digits."""

    def add(total: Column, i: Column) -> Column:
        digit = number(F.substring(payload, F.char_length(payload) + 1 - i, F.lit(1)))
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.char_length(payload)), F.lit(0).cast("bigint"), add)
    return ((10 - total % 10) % 10).cast("string")


def card(value: Column, key: str) -> Column:
    """A card number with its check digit right becomes another such number."""

    def replaced(digits: Column) -> Column:
        size = F.char_length(digits)
        payload = F.substring(digits, F.lit(1), size - 1)
        valid = check_digit(payload) == F.substring(digits, size, F.lit(1))
        other = let(permuted_digits(payload, key, "card"), lambda p: F.concat(p, check_digit(p)))
        return F.when(valid, filled(value, other)).otherwise(value)

    return let(only_digits(value), replaced)


def ip(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), number)
    part = lambda i: F.get(parts, F.lit(i))
    pair = feistel(part(0) * 256 + part(1), part(2) * 256 + part(3), (65536, 65536), key, "ip")
    halves = lambda n: (F.floor(n / 256).cast("bigint").cast("string"), (n % 256).cast("string"))
    return let(pair, lambda p: F.concat_ws(".", *halves(p["l"]), *halves(p["r"])))


def date(value: Column, key: str) -> Column:
    """A real date from 1700 to 2099 in ISO, D.M.Y, M/D/Y or D/M/Y form becomes another."""
    parts = F.split(value, "[./-]")
    a, b, c = (F.get(parts, F.lit(i)) for i in range(3))
    iso = value.contains("-")
    month_first = value.contains("/") & (number(a) <= 12)
    year = F.when(iso, a).otherwise(c)
    month = F.when(iso | ~month_first, b).otherwise(a)
    day = F.when(iso, c).when(month_first, b).otherwise(a)
    padded = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    valid = F.try_to_date(padded, "yyyy-MM-dd")
    number_of_day = F.date_diff(valid, F.expr(FIRST_DAY)).cast("bigint")
    inside = number_of_day.between(0, DATE_MODULI[0] * DATE_MODULI[1] - 1)
    pair = feistel(
        F.floor(number_of_day / DATE_MODULI[1]), number_of_day % DATE_MODULI[1], DATE_MODULI, key, "date"
    )
    other = let(
        pair, lambda p: F.date_add(F.expr(FIRST_DAY), (p["l"] * DATE_MODULI[1] + p["r"]).cast("int"))
    )
    wide = value.rlike("^[0-9]{2}[./][0-9]{2}[./]")
    separator = F.when(value.contains("."), ".").otherwise("/")

    def written(day_of: Column) -> Column:
        two = lambda unit: F.when(wide, F.lpad(unit.cast("string"), 2, "0")).otherwise(unit.cast("string"))
        d, m = two(F.dayofmonth(day_of)), two(F.month(day_of))
        other_forms = F.when(month_first, F.concat_ws("/", m, d, F.year(day_of).cast("string"))).otherwise(
            F.concat(d, separator, m, separator, F.year(day_of).cast("string"))
        )
        return F.when(iso, F.date_format(day_of, "yyyy-MM-dd")).otherwise(other_forms)

    return F.when(inside, let(other, written)).otherwise(value)


def ssn(value: Column, key: str) -> Column:
    """Areas 001-665 and 667-899, groups 01-99, serials 0001-9999 are permuted."""
    parts = F.transform(F.split(value, "-"), number)
    area, group, serial = (F.get(parts, F.lit(i)) for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    pair = feistel(place * 99 + group - 1, serial - 1, (898 * 99, 9999), key, "ssn")

    def written(p: Column) -> Column:
        slot = F.floor(p["l"] / 99).cast("bigint")
        number_of_area = slot + 1 + F.when(slot >= 665, 1).otherwise(0)
        pad = lambda n, width: F.lpad(n.cast("string"), width, "0")
        return F.concat_ws("-", pad(number_of_area, 3), pad(p["l"] % 99 + 1, 2), pad(p["r"] + 1, 4))

    return F.when(valid, let(pair, written)).otherwise(value)


def phone(value: Column, key: str) -> Column:
    """The last ten digits are permuted; a country code 1 before them stays."""

    def replaced(digits: Column) -> Column:
        cut = F.char_length(digits) - 10
        national = F.substring(digits, cut + 1, F.lit(10))
        return filled(
            value,
            F.concat(F.substring(digits, F.lit(1), cut), permuted_digits(national, key, "phone")),
        )

    return let(only_digits(value), replaced)


def world_phone(value: Column, key: str) -> Column:
    """Numbers of 8 to 15 digits: all but the first two are permuted."""

    def replaced(digits: Column) -> Column:
        size = F.char_length(digits)
        other = F.concat(
            F.substring(digits, F.lit(1), F.lit(2)),
            permuted_digits(F.substring(digits, F.lit(3), size), key, "world-phone"),
        )
        return F.when(size.between(8, 15), filled(value, other)).otherwise(value)

    return let(only_digits(value), replaced)


def stand_in(value: Column, size, key: str, tweak: str) -> Column:
    """So many keyed hexadecimal digits for a value."""
    block = F.sha2(F.concat_ws(":", F.lit(key), F.lit(tweak), value), 256)
    size = F.lit(size) if isinstance(size, int) else size
    return F.substring(F.repeat(block, F.ceil(size / 64).cast("int")), F.lit(1), size)


def email(value: Column, key: str) -> Column:
    """Keyed letters for name and host, case ignored; the last host label stays."""
    lower = F.lower(value)
    host = F.regexp_extract(lower, "@(.*)$", 1)
    letters = lambda v, n, tweak: F.translate(stand_in(v, n, key, tweak), "0123456789", "ghijklmnop")
    return F.concat(
        letters(lower, 10, "email"),
        F.lit("@"),
        letters(host, 8, "host"),
        F.lit("."),
        F.regexp_extract(host, r"\.([a-z]+)$", 1),
    )


def credential(value: Column, key: str) -> Column:
    """The secret after the name and sign, as long as it was."""
    head = F.regexp_extract(value, r"^[^=:]*[=:] ?\"?", 0)
    secret = F.regexp_extract(value, r"[=:] ?\"?([A-Za-z0-9+/_-]+)\"?$", 1)
    tail = F.regexp_extract(value, r"\"?$", 0)
    return F.concat(head, stand_in(secret, F.char_length(secret), key, "secret"), tail)


def access_key(value: Column, key: str) -> Column:
    return F.concat(F.lit("AKIA"), F.upper(stand_in(value, 16, key, "access-key")))


KINDS = {
    "email": email,
    "key": access_key,
    "credential": credential,
    "ip": ip,
    "date": date,
    "ssn": ssn,
    "phone": phone,
    "world_phone": world_phone,
    "card": card,
}


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one match, by the first kind whose whole form it has."""
    # What stands around a match is not in it, so only the forms are asked here.
    forms = {
        "email": value.contains("@"),
        "key": value.startswith("AKIA"),
        "credential": value.rlike("^[A-Za-z]"),
        "ip": value.rlike(r"^[0-9]+(\.[0-9]+){3}$"),
        "date": value.rlike("^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})$"),
        "ssn": value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
        "phone": value.rlike(
            r"^(\+?1[ .-]?)?(\([0-9]{3}\) ?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})$"
            r"|^\+1[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}$"
        ),
        "world_phone": value.startswith("+"),
    }
    chosen = card(value, key)
    for kind in reversed(list(forms)):
        chosen = F.when(forms[kind], KINDS[kind](value, key)).otherwise(chosen)
    return chosen


def replaced(text: Column, key: str) -> Column:
    """Struct of the text with pseudonyms and the number of values replaced."""
    untouched = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n_pii"))

    def rebuilt(found: Column) -> Column:
        others = F.transform(found, lambda value: pseudonym(value, key))
        between = F.split(text, PATTERN, -1)

        def joined(new: Column) -> Column:
            pieces = F.transform(between, lambda piece, i: F.concat(piece, F.coalesce(F.get(new, i), F.lit(""))))
            changed = F.size(F.filter(F.arrays_zip(found.alias("o"), new.alias("n")), lambda z: z["o"] != z["n"]))
            return F.struct(F.array_join(pieces, "").alias("text"), changed.cast("long").alias("n_pii"))

        return let(others, joined)

    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    some = let(found, lambda f: F.when(F.size(f) > 0, rebuilt(f)).otherwise(untouched))
    return F.when(text.rlike(HINT), some).otherwise(untouched)


def pseudonymised(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """All columns, with the text's personal data replaced, and n_pii, the number replaced."""
    fields = [
        F.col("_done.text").alias(name) if name == column else F.col(f"_row.`{name}`")
        for name in docs.columns
    ]
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("_row")
    return docs.select(row, replaced(F.col(f"`{column}`"), key).alias("_done")).select(
        *fields, F.col("_done.n_pii").alias("_n_pii")
    )
