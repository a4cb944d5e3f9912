"""PII: format-preserving Feistel pseudonyms, in DataFrame expressions only.

Patterns find candidates, validation keeps real ones, and a keyed Feistel
network permutes each value within its own format: a card stays a card with a
right check digit, a date a date of the same century, a host address a host
address, a letter a letter.  Equal values get equal pseudonyms whatever their
separators, so documents stay linked; different values of one format never
share one, because each step is a permutation.

A number beside a card or a capital word after an IBAN looks like a part of it, so
these two are not cut out by pattern alone: candidates of every usual length are
taken at every group, valid ones become the row's own pattern, and a failed one
hides nothing (a text with very many different cards costs their product with
its digit groups).  Phones, the loosest pattern, are looked for in what is left.

A value is an array of digits with a radix each (10 for a decimal digit, 26 for
a letter, 256 for an octet, 1 for what stays).  It is cut in two halves; a
round adds to one half, digit by digit and modulo each radix, numbers drawn
from SHA-512 of the key, the kind, the round and the other half.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY_SETTING = "spark.rebuy.pii.key"
ROUNDS = 10

# Patterns of the kinds, tried in this order at each place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}+",
    "secret": r"(?<![A-Za-z0-9])(?:(?i:password|passwd|pwd|secret|token|api[_-]?key)[\"']?[ \t]{0,3}[=:][ \t]{0,3}"
              r"[\"']?[A-Za-z0-9+/_-]{8,}+|AKIA[0-9A-Z]{16}(?![0-9A-Za-z]))",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}"
            r"|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    # area code in brackets; unbracketed with a country code; E.164; country code
    # and a solid number; pairs; other groups; 10 or 11 digits; pairs at home
    "phone": r"(?<![0-9A-Za-z])(?:(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}"
             r"|\+[0-9]{1,3}[ .-]?[0-9]{2,4}[ .-][0-9]{3,4}[ .-]?[0-9]{3,4}"
             r"|\+[0-9]{8,15}|\+[0-9]{1,3}[ .-][0-9]{6,12}"
             r"|\+[0-9]{1,3}[ .-]?(?:\(0\)[ .-]?)?[0-9]{1,4}(?:[ .-][0-9]{2}){3,5}|\+[0-9](?:[ .-]?[0-9]){7,14}"
             r"|[0-9]{2}[ .-][0-9]{4}[ .-]?[0-9]{4}"
             r"|[0-9]{3}[ .-](?:[0-9]{3,4}[ .-]?[0-9]{4}|[0-9]{4}[ .-]?[0-9]{3})"
             r"|[0-9]{4}[ .-](?:[0-9]{3}[ .-]?[0-9]{3,4}|[0-9]{4}[ .-]?[0-9]{3})"
             r"|(?<![0-9][ .-])0[0-9](?:[ .-][0-9]{2}){4}(?![ .-][0-9]))(?![0-9])",
}
FIXED = "|".join(f"(?:{PATTERNS[k]})" for k in ("email", "secret", "ip", "date", "ssn"))

# Length of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban_of(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    tail = f"[ ]?[A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[ ]?[A-Z0-9]{{4}}){{{groups}}}{tail}"


# Candidates for validation; group 1 of a look-ahead is tried at every place.
IBAN_FORMS = [r"(?<![A-Za-z0-9])(?=((?:" + "|".join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items())
              + r")(?![A-Za-z0-9])))[A-Z]", f"({PATTERNS['iban']})"]
CARD_FORMS = [r"(?<![0-9+])(?<!\+[0-9]{1,3}[ .-])([0-9](?:[ -]?[0-9]){12,18})(?![0-9])",        # any groups, longest
              r"(?<![0-9+])([0-9]{13,19})(?![0-9])",                                            # no groups
              r"(?<![0-9])(?=([0-9]{4}(?:[ -]?[0-9]{4}){3})(?![0-9]))[0-9]",                    # 4-4-4-4
              r"(?<![0-9])(?=([0-9]{4}[ -](?:[0-9]{6}[ -][0-9]{4,5}|[0-9]{3}[ -][0-9]{3}[ -][0-9]{3}"
              r"|(?:[0-9]{4}[ -]){3}[0-9]{1,3}))(?![0-9]))[0-9]"]                               # 4-6-4/5, 4-3-3-3, 4-4-4-4-n


def _draw(h: Column, i: Column) -> Column:
    """The i-th number in a SHA-512 hex string: 16 bits, 32 of them, round and round."""
    return F.conv(F.substring(h, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def feistel(kind: str, left: Column, right: Column, left_radix: Column, right_radix: Column,
            key: str, rounds: int = ROUNDS) -> Column:
    """Permute (left, right), arrays of ints below their radices -> one array."""
    start = F.struct(left.alias("a"), right.alias("b"), left_radix.alias("ra"), right_radix.alias("rb"))

    def step(s: Column, r: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"),
                                    F.array_join(s["b"].cast("array<string>"), ",")), 512)
        # an array of one digest, so that the digest is computed once
        moved = F.transform(F.array(digest), lambda h: F.transform(
            s["a"], lambda x, i: (x + _draw(h, i)) % F.get(s["ra"], i)))
        return F.struct(s["b"].alias("a"), F.get(moved, F.lit(0)).alias("b"), s["rb"].alias("ra"), s["ra"].alias("rb"))

    if rounds % 2:
        raise ValueError("an even number of rounds returns the halves to their sides")
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step, lambda s: F.concat(s["a"], s["b"]))


def _halves(values: Column, radices: Column, kind: str, key: str) -> Column:
    n = F.size(values)
    cut = F.floor(n / 2).cast("int")
    return feistel(kind, F.slice(values, 1, cut), F.slice(values, cut + 1, n - cut),
                   F.slice(radices, 1, cut), F.slice(radices, cut + 1, n - cut), key)


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _letters(s: Column, kind: str, key: str) -> Column:
    """Permute a string within its classes: digits, a-z, A-Z; the rest stays."""
    chars = _chars(s)
    radix = lambda c: F.when(c.rlike("^[0-9]$"), 10).when(c.rlike("^[a-zA-Z]$"), 26).otherwise(1)
    base = lambda c: F.when(c.rlike("^[0-9]$"), 48).when(c.rlike("^[a-z]$"), 97).otherwise(65)     # noqa: E731
    value = lambda c: F.when(radix(c) == 1, 0).otherwise(F.ascii(c) - base(c))                     # noqa: E731
    moved = _halves(F.transform(chars, value), F.transform(chars, radix), kind, key)
    return F.array_join(F.zip_with(moved, chars, lambda v, c: F.when(radix(c) == 1, c).otherwise(
        F.char((v + base(c)).cast("long")))), "")


def _hex(s: Column, kind: str, key: str) -> Column:
    values = F.transform(_chars(s), lambda c: F.conv(c, 16, 10).cast("int"))
    moved = _halves(values, F.transform(values, lambda v: F.lit(16)), kind, key)
    return F.array_join(F.transform(moved, lambda v: F.lower(F.hex(v))), "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _ints(digits: Column) -> Column:
    return F.transform(_chars(digits), lambda c: c.cast("int"))


def _laid_out(like: Column, digits: Column) -> Column:
    """Put ``digits`` in the places of the digits of ``like``."""
    def put(c: Column, i: Column) -> Column:
        nth = F.length(_digits(F.substring(like, F.lit(1), i + 1)))
        return F.when(c.rlike("^[0-9]$"), F.substring(digits, nth, F.lit(1))).otherwise(c)
    return F.array_join(F.transform(_chars(like), put), "")


def _luhn_sum(values: Column, doubled: int) -> Column:
    """Digit sum with every second digit doubled; ``doubled``: 0 or 1, the
    place counted from the right of the first doubled one."""
    n = F.size(values)
    weigh = lambda v, i: F.when((n - 1 - i) % 2 == doubled, v * 2 - F.when(v > 4, 9).otherwise(0)).otherwise(v)
    return F.aggregate(F.transform(values, weigh), F.lit(0), lambda a, x: a + x)


def _is_card(m: Column) -> Column:
    return _luhn_sum(_ints(_digits(m)), 1) % 10 == 0


def _card(m: Column, key: str) -> Column:
    """Keep the first digit, permute the rest, set the check digit anew."""
    d = _digits(m)
    body = _ints(F.substring(d, F.lit(2), F.length(d) - 2))
    moved = _halves(body, F.transform(body, lambda v: F.lit(10)), "card", key)
    values = F.concat(F.array(F.substring(d, 1, 1).cast("int")), moved)
    whole = F.transform(F.array(F.array_join(values.cast("array<string>"), "")), lambda s: F.concat(
        s, ((F.lit(10) - _luhn_sum(_ints(s), 0) % 10) % 10).cast("string")))
    return _laid_out(m, F.get(whole, F.lit(0)))


def _octets(m: Column) -> Column:
    return F.transform(F.split(m, r"\."), lambda o: o.cast("int"))


def _is_ip(m: Column) -> Column:
    return F.forall(_octets(m), lambda o: o <= 255)


def _ip(m: Column, key: str) -> Column:
    o = _octets(m)
    return F.array_join(_halves(o, F.transform(o, lambda v: F.lit(256)), "ip", key).cast("array<string>"), ".")


def _ymd(m: Column) -> Column:
    """A written date as DATE; null when there is no such day.  With slashes
    the month comes first, unless that is no date and day first is."""
    p = lambda k: F.regexp_extract(m, r"([0-9]+)[-./]([0-9]+)[-./]([0-9]+)", k)
    made = lambda y, mo, d: F.try_to_date(F.concat_ws("-", y, mo, d), "yyyy-MM-dd")
    return (F.when(m.rlike("^[0-9]{4}"), made(p(1), p(2), p(3)))
            .when(m.contains("."), made(p(3), p(2), p(1)))
            .otherwise(F.coalesce(made(p(3), p(1), p(2)), made(p(3), p(2), p(1)))))


def _is_date(m: Column) -> Column:
    return F.coalesce(F.year(_ymd(m)) >= 1, F.lit(False))


def _late_day(day: Column, key: str) -> Column:
    """Permute a day after the 12th of its month among those of its century: 221 a
    year and one more in leap years, 22,125 = 125 * 177 or 22,124 = 4 * 5,531."""
    century = F.floor(F.year(day) / 100).cast("int")
    leap = century % 4 == 0
    nth = lambda d: F.dayofyear(d) - 12 * F.month(d) - 1                                    # noqa: E731  of its year, from 0
    first = lambda k: k * 221 + F.floor((k + 3) / 4).cast("int") - F.when(~leap & (k > 0), 1).otherwise(0)  # noqa: E731  of year k
    x = first(F.year(day) - century * 100) + nth(day)
    minor = F.when(leap, 177).otherwise(5531)
    v = feistel("late", F.array(F.floor(x / minor).cast("int")), F.array((x % minor).cast("int")),
                F.array(F.when(leap, 125).otherwise(4)), F.array(minor), key)

    def back(w: Column) -> Column:
        near = F.least(F.floor(w / 221).cast("int"), F.lit(99))
        k = F.when(first(near) > w, near - 1).otherwise(near)
        return F.struct((century * 100 + k).alias("y"), (w - first(k)).alias("r"))

    def of_year(s: Column) -> Column:
        starts = lambda mo: nth(F.make_date(s["y"], mo, F.lit(13)))                         # noqa: E731
        mo = F.size(F.filter(F.sequence(F.lit(1), F.lit(12)), lambda i: starts(i) <= s["r"]))
        return F.make_date(s["y"], mo, 13 + s["r"] - starts(mo))
    whole = F.transform(F.array(v), lambda w: (F.get(w, F.lit(0)) * minor + F.get(w, F.lit(1))).cast("int"))
    return F.when(century == 0, day).otherwise(F.get(F.transform(F.transform(whole, back), of_year), F.lit(0)))


def _date(m: Column, key: str) -> Column:
    """Permute the day within its century: 36,525 days = 75 * 487 when the
    century's first year is a leap year, else 36,524 = 92 * 397.  A date written
    day first with slashes can only name days after the 12th of a month (others
    read month first), so it is permuted among those and shares no text."""
    def moved(day: Column) -> Column:
        century = F.floor(F.year(day) / 100).cast("int")
        first = F.make_date(F.greatest(century * 100, F.lit(1)), F.lit(1), F.lit(1))
        # the first century lacks year 0 and its 366 days
        x = F.date_diff(day, first) + F.when(century == 0, 366).otherwise(0)
        leap = century % 4 == 0
        minor = F.when(leap, 487).otherwise(397)
        v = feistel("date", F.array(F.floor(x / minor).cast("int")), F.array((x % minor).cast("int")),
                    F.array(F.when(leap, 75).otherwise(92)), F.array(minor), key)
        y = F.transform(F.array(v), lambda w: F.get(w, F.lit(0)) * minor + F.get(w, F.lit(1)))
        return F.when(century == 0, day).otherwise(F.date_add(first, F.get(y, F.lit(0))))
    new = F.get(F.transform(F.array(_ymd(m)), moved), F.lit(0))
    month_first = F.try_to_date(m, "MM/dd/yyyy").isNotNull()
    return (F.when(m.rlike("^[0-9]{4}-"), F.date_format(new, "yyyy-MM-dd"))
            .when(m.rlike("^[0-9]{4}/"), F.date_format(new, "yyyy/MM/dd"))
            .when(m.contains("."), F.date_format(new, "dd.MM.yyyy"))
            .when(month_first, F.date_format(new, "MM/dd/yyyy"))
            .otherwise(F.date_format(F.get(F.transform(F.array(_ymd(m)), lambda d: _late_day(d, key)), F.lit(0)), "dd/MM/yyyy")))


def _is_ssn(m: Column) -> Column:
    return m.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.regexp_extract(m, r"^([0-9]+)-([0-9]+)-([0-9]+)$", k).cast("int") for k in (1, 2, 3))
    v = feistel("ssn", F.array(area - 1 - F.when(area > 666, 1).otherwise(0)), F.array(group - 1, serial - 1),
                F.array(F.lit(898)), F.array(F.lit(99), F.lit(9999)), key)
    put = lambda w: F.format_string("%03d-%02d-%04d", F.get(w, F.lit(0)) + 1 + F.when(F.get(w, F.lit(0)) >= 665, 1).otherwise(0),
                                    F.get(w, F.lit(1)) + 1, F.get(w, F.lit(2)) + 1)
    return F.get(F.transform(F.array(v), put), F.lit(0))


def _mod97(s: Column) -> Column:
    """A string of digits and A-Z (10 to 35) as a number modulo 97."""
    def step(a: Column, c: Column) -> Column:
        v = F.when(c.rlike("^[0-9]$"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (a * F.when(v > 9, 100).otherwise(10) + v) % 97
    return F.aggregate(_chars(s), F.lit(0), step)


def _is_iban(m: Column) -> Column:
    s = F.regexp_replace(m, " ", "")
    return _mod97(F.concat(F.substring(s, F.lit(5), F.length(s) - 4), F.substring(s, 1, 4))) == 1


def _iban(m: Column, key: str) -> Column:
    """Permute the account part within its classes, set the check digits anew."""
    s = F.regexp_replace(m, " ", "")
    country = F.substring(s, 1, 2)
    body = F.transform(F.array(_letters(F.substring(s, F.lit(5), F.length(s) - 4), "iban", key)), lambda b: F.concat(
        country, F.lpad((F.lit(98) - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b))
    new = F.get(body, F.lit(0))
    place = lambda c, i: F.when(c == " ", c).otherwise(F.substring(
        new, F.length(F.regexp_replace(F.substring(m, F.lit(1), i + 1), " ", "")), F.lit(1)))
    return F.array_join(F.transform(_chars(m), place), "")


def _is_phone(m: Column) -> Column:
    n = F.length(_digits(m))
    return F.when(m.rlike(r"^\+"), n.between(8, 15)).when(m.rlike(r"^\("), n.between(9, 15)).otherwise(n.between(10, 11))


def _phone(m: Column, key: str) -> Column:
    """Keep the country code and permute the rest; a first digit from 2 to 9
    stays one (0 and 1 have meanings of their own)."""
    # without a separator the code is the one of the international plan (prefix-free)
    code = F.length(_digits(F.regexp_extract(m, r"^(\+(?:[0-9]{1,3}(?=[ .(-])|[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]"
                                                r"|8[1246]|9[0-58]|[0-9]{3}))", 1)))
    d = _digits(m)
    v = _ints(F.substring(d, code + 1, F.length(d) - code))
    big = F.get(v, F.lit(0)) >= 2
    values = F.transform(v, lambda x, i: F.when((i == 0) & big, x - 2).otherwise(x))
    radices = F.transform(v, lambda x, i: F.when(i > 0, 10).when(big, 8).otherwise(2))
    moved = F.transform(_halves(values, radices, "phone", key), lambda x, i: F.when((i == 0) & big, x + 2).otherwise(x))
    return _laid_out(m, F.concat(F.substring(d, F.lit(1), code), F.array_join(moved.cast("array<string>"), "")))


def _email(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.concat(_letters(local, "email", key), F.substring(m, F.length(local) + 1, F.length(m)))


def _secret(m: Column, key: str) -> Column:
    value = F.regexp_extract(m, r"^(?:AKIA|.*?[=:][ \t]*[\"']?)([A-Za-z0-9+/_-]+)$", 1)
    head = F.substring(m, F.lit(1), F.length(m) - F.length(value))
    return F.concat(head, F.when(value.rlike("^[0-9a-f]+$"), _hex(value, "secret", key))
                    .otherwise(_letters(value, "secret", key)))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one candidate, or null when it is not valid."""
    whole = {k: f"^(?:{p})$" for k, p in PATTERNS.items()}
    valid = {"ip": _is_ip, "iban": _is_iban, "date": _is_date, "ssn": _is_ssn, "card": _is_card}
    new = {"email": _email, "secret": _secret, "ip": _ip, "iban": _iban, "date": _date, "ssn": _ssn, "card": _card}
    out = None
    for kind, fn in new.items():
        is_it = m.rlike(whole[kind])
        if kind in valid:
            is_it = is_it & valid[kind](m)
        out = F.when(is_it, fn(m, key)) if out is None else out.when(is_it, fn(m, key))
    return out


def _pattern(text: Column) -> Column:
    """What to cut out of one text: the fixed patterns and its own valid cards
    and IBANs, the longest first."""
    def own(forms: list[str], valid, edge: str) -> Column:
        found = F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in forms])
        longest = F.array_sort(F.filter(F.array_distinct(found), valid), lambda a, b: F.length(b) - F.length(a))
        return F.transform(longest, lambda v: F.concat(F.lit(f"(?<!{edge})"), v, F.lit(f"(?!{edge})")))
    return F.array_join(F.concat(F.array(F.lit(FIXED)), own(IBAN_FORMS, _is_iban, "[A-Za-z0-9]"),
                                 own(CARD_FORMS, _is_card, "[0-9]")), "|")


def _joined(between: Column, hits: Column, new: Column) -> Column:
    said = F.concat(F.zip_with(hits, new, lambda m, p: F.coalesce(p, m)), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, said, lambda a, b: F.concat(a, b)), "")


def _count(new: Column) -> Column:
    return F.size(F.filter(new, lambda p: p.isNotNull()))


def _phones(piece: Column, key: str) -> Column:
    """(text, n): a stretch of text with its n phones replaced."""
    pattern = F.lit(PATTERNS["phone"])

    def replaced(hits: Column) -> Column:
        new = F.transform(F.array(F.transform(hits, lambda m: F.when(_is_phone(m), _phone(m, key)))), lambda x: F.struct(
            _joined(F.split(piece, pattern, -1), hits, x).alias("text"), _count(x).alias("n")))
        return F.when(F.size(hits) > 0, F.get(new, F.lit(0))).otherwise(F.struct(piece.alias("text"), F.lit(0).alias("n")))
    # arrays of one, so that each is computed once
    return F.get(F.transform(F.array(F.regexp_extract_all(piece, pattern, F.lit(0))), replaced), F.lit(0))


def key_of(spark: SparkSession) -> str:
    """The session's key, a secret: the setting ``spark.rebuy.pii.key``.  Where it
    is unset, a random one is put there, so that an application's pseudonyms agree
    with each other; those of several applications do only with a key of your own."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def pseudonymise(docs: DataFrame, key: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` pseudonymised and ``n_pseudonyms``, how many
    values were replaced; all other columns stay as they are.

    Null and empty texts stay, with 0.  Repeated rows each return a row; an
    empty table returns none.  A column n_pseudonyms of the input is replaced."""
    key = key or key_of(docs.sparkSession)
    cols = [c for c in docs.columns if c != "n_pseudonyms"]
    pattern, hits, new, rest = "__pii_pattern", "__pii_hits", "__pii_new", "__pii_rest"
    found = docs.select(*cols, _pattern(F.col(text)).alias(pattern))
    found = found.select(*cols, F.regexp_extract_all(F.col(text), F.col(pattern), F.lit(0)).alias(hits),
                         F.split(F.col(text), F.col(pattern), -1).alias(rest))
    made = found.select(*cols, hits, F.transform(hits, lambda m: pseudonym(m, key)).alias(new),
                        F.transform(rest, lambda p: _phones(p, key)).alias(rest))
    n = _count(F.col(new)) + F.aggregate(rest, F.lit(0), lambda a, p: a + p["n"])
    changed = F.when(F.col(text).isNotNull(), _joined(F.col(f"{rest}.text"), F.col(hits), F.col(new)))
    return made.select(*[changed.alias(c) if c == text else F.col(c) for c in cols],
                       F.when(F.col(text).isNull(), 0).otherwise(n).alias("n_pseudonyms"))
