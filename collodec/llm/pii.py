r"""Personal data replaced by format-preserving Feistel pseudonyms, in DataFrame functions only.

Found and validated are e-mail addresses, IBANs (check digits), IPv4 addresses (octets),
calendar dates, US social security numbers (ranges), payment cards (check digit) and
telephone numbers (number of digits). A value is cut in two halves; in each of ``ROUNDS``
rounds one half is shifted by a keyed SHA-256 of the other. That is a permutation of all
values of the format, so equal values stay equal across documents, different ones stay
different, and whoever has the key can undo it. What a format fixes stays or is computed
anew: separators, country codes, a card's first digit, check digits. The pseudonym of a
valid value is valid, but that a telephone number may get an area code nobody uses.

* e-mail: the local part, each plain or Western letter in its own alphabet, each digit as a
  digit, any other letter or number among those of its group of ``GROUP`` code points.
* IBAN: the digits of the account; letters and country stay, check digits follow.
* IPv4: the 32 bits. * date: the day in its block of 40,000 days from 1920-01-01 on.
* social security number: area, group and serial within their ranges.
* card: all digits but the first and the check digit, which follows.
* telephone: the digits behind the country code.

A date with slashes is month/day/year if that is a date, else day/month/year.

Rules: a NULL text stays NULL, an empty one empty. What looks like a value but is not valid
stays. Other columns, also such with NULLs or odd names, stay as they are. Equal texts get
equal results. Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Letters that are no plain or Western ones change places within groups of code points.
GROUP = 64
#: The key of the registered queries. A real run passes its own secret.
DEFAULT_KEY = "not-a-secret"

_EDGE, _END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
# The kinds' patterns, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "iban": r"(?=[A-Z]{2}\d)" + _EDGE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END,
    "ip": r"(?=\d)(?<![\p{L}\p{N}_.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\p{L}\p{N}_]|\.\d)",
    "date": r"(?=\d)" + _EDGE + r"(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})" + _END,
    "ssn": r"(?=\d)" + _EDGE + r"\d{3}-\d{2}-\d{4}" + _END,
    "card": r"(?=\d)" + _EDGE + r"(?:\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}|\d{4}[ -]?\d{6}[ -]?\d{5}|\d{13,19})" + _END,
    "phone": r"(?=[+(\d])(?<![\p{L}\p{N}_])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})" + _END,
}
_ALL = "|".join(PATTERNS.values())


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where it is used in a lambda."""
    return F.transform(F.array(value), use)[0]


def _hash(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *parts), 256)


def _number(digest: Column, below: Column | int) -> Column:
    """A number in [0, below) from a hexadecimal digest."""
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), below)


def feistel(left: Column, right: Column, n_left, n_right, key: str, kind: str, use) -> Column:
    """Permute the pairs of [0, n_left) x [0, n_right); ``use`` gets the two halves."""

    def turn(half: Column, other: Column, size, i: Column) -> Column:
        shift = _number(_hash(key, F.lit(kind), i, F.lit(size) if isinstance(size, int) else size, other), size)
        return F.pmod(half + shift, size)

    def step(state: Column, i: Column) -> Column:
        low = turn(state.l, state.r, n_left, i)
        return F.when(i % 2 == 0, F.struct(low.alias("l"), state.r.alias("r"))).otherwise(
            F.struct(state.l.alias("l"), turn(state.r, state.l, n_right, i).alias("r"))
        )

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return _let(done, lambda d: use(d.l, d.r))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _power10(n: Column) -> Column:
    return F.expr("bigint(1)") * F.rpad(F.lit("1"), n + 1, "0").cast("bigint")


def _permute_digits(digits: Column, key: str, kind: str, use) -> Column:
    """Permute a string of 0 to 30 digits among those of its length; ``use`` gets the result."""

    def permute(digits: Column) -> Column:
        n = F.length(digits)
        cut = F.floor(n / 2).cast("int")
        zero = F.lit(0).cast("bigint")

        def whole(left: Column, right: Column) -> Column:
            low = F.when(cut > 0, F.lpad(left.cast("string"), cut, "0")).otherwise("")
            return F.when(n == 0, "").otherwise(F.concat(low, F.lpad(right.cast("string"), n - cut, "0")))

        def halves(size_left: Column, size_right: Column) -> Column:
            low, high = F.substring(digits, F.lit(1), cut), F.substring(digits, cut + 1, n)
            return feistel(
                F.coalesce(F.nullif(low, F.lit("")).cast("bigint"), zero),
                F.coalesce(F.nullif(high, F.lit("")).cast("bigint"), zero),
                size_left, size_right, key, kind, whole,
            )

        return _let(F.struct(_power10(cut).alias("l"), _power10(n - cut).alias("r")), lambda p: halves(p.l, p.r))

    return _let(_let(digits, permute), use)


def _refill(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, one after the other, by those of ``digits``."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    is_digit = lambda c: (c >= "0") & (c <= "9")
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def put(s: Column, c: Column) -> Column:
        return F.when(
            is_digit(c),
            F.struct(F.concat(s.out, F.substring(digits, s.at + 1, F.lit(1))).alias("out"), (s.at + 1).alias("at")),
        ).otherwise(F.struct(F.concat(s.out, c).alias("out"), s.at.alias("at")))

    return F.aggregate(chars, state, put).out


def _luhn(digits: Column) -> Column:
    """The weighted sum of the digits, whose last counts once."""

    def total(d: Column) -> Column:
        def weigh(i: Column) -> Column:
            return _let(
                F.substring(d, i, F.lit(1)).cast("int"),
                lambda x: F.when((F.length(d) - i) % 2 == 0, x).otherwise(2 * x - F.when(x > 4, 9).otherwise(0)),
            )

        return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda s, i: s + F.coalesce(weigh(i), F.lit(0)))

    return F.when(F.length(digits) > 0, _let(digits, total)).otherwise(0)


def _mod97(value: Column) -> Column:
    """Letters count as two digits, from A = 10 on."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")

    def step(s: Column, c: Column) -> Column:
        return F.when(c >= "A", (s * 100 + F.ascii(c) - 55) % 97).otherwise((s * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(chars, F.lit(0), step)


def _card(v: Column, key: str) -> Column:
    def card(d: Column) -> Column:
        n = F.length(d)
        valid = n.between(13, 19) & (_luhn(d) % 10 == 0) & ~d.rlike("^0+$")

        def with_check(body: Column) -> Column:
            check = F.pmod(10 - _luhn(F.concat(body, F.lit("0"))) % 10, F.lit(10))
            return _let(F.concat(body, check.cast("string")), lambda new: _refill(v, new))

        middle = F.substring(d, F.lit(2), n - 2)
        new = _permute_digits(
            middle, key, "card", lambda m: _let(F.concat(F.substring(d, 1, 1), m), with_check)
        )
        return F.when(valid, new)

    return _let(_digits(v), card)


def _phone(v: Column, key: str) -> Column:
    def phone(country: Column) -> Column:
        rest = F.substring(v, F.length(country) + 1, F.length(v))
        new = _permute_digits(_digits(rest), key, "phone", lambda d: _refill(rest, d))
        return F.when(F.length(_digits(v)).between(10, 15), F.concat(country, new))

    return _let(F.regexp_extract(v, r"^\+\d{1,3}(?=[ .(-])", 0), phone)


def _iban(v: Column, key: str) -> Column:
    def iban(bare: Column) -> Column:
        country, account = F.substring(bare, 1, 2), F.substring(bare, F.lit(5), F.length(bare))
        valid = F.length(bare).between(15, 34) & (_mod97(F.concat(account, F.substring(bare, 1, 4))) == 1)

        def refilled(digits: Column) -> Column:
            new = _refill(account, digits)
            check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
            return _let(F.concat(check, digits), lambda d: _refill(v, d))

        return F.when(valid, _permute_digits(_digits(account), key, "iban", refilled))

    return _let(F.regexp_replace(v, " ", ""), iban)


def _ip(v: Column, key: str) -> Column:
    def ip(o: Column) -> Column:
        def dotted(left: Column, right: Column) -> Column:
            parts = [F.floor(left / 256), left % 256, F.floor(right / 256), right % 256]
            return F.concat_ws(".", *[p.cast("bigint").cast("string") for p in parts])

        new = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip", dotted)
        return F.when(F.forall(o, lambda x: x <= 255), new)

    return _let(F.transform(F.split(v, r"\."), lambda x: x.cast("bigint")), ip)


def _ssn(v: Column, key: str) -> Column:
    area, group, serial = [F.substring(v, a, n).cast("bigint") for a, n in ((1, 3), (5, 2), (8, 4))]
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)

    def dashed(left: Column, right: Column) -> Column:
        new = F.floor(left / 99) + 1
        parts = (F.when(new >= 666, new + 1).otherwise(new), left % 99 + 1, right + 1)
        padded = [F.lpad(p.cast("bigint").cast("string"), n, "0") for p, n in zip(parts, (3, 2, 4), strict=True)]
        return F.concat_ws("-", *padded)

    return F.when(valid, feistel(index * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn", dashed))


def _date(v: Column, key: str) -> Column:
    numbers = F.split(v, "[-/.]")
    part = [numbers[i].cast("int") for i in range(3)]
    iso, slashes = v.contains("-"), v.contains("/")

    def day(y: Column, m: Column, d: Column) -> Column:
        return F.try_to_date(F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), m.cast("string"), d.cast("string")), "yyyy-M-d")

    american = day(part[2], part[0], part[1])
    european = day(part[2], part[1], part[0])
    date = F.when(iso, day(*part)).when(slashes, F.coalesce(american, european)).otherwise(european)
    epoch = F.lit("1920-01-01").cast("date")

    def moved(number: Column) -> Column:
        block = F.floor(number / 40000).cast("bigint")
        place = number - block * 40000

        def written(left: Column, right: Column) -> Column:
            new = F.date_add(epoch, (block * 40000 + left * 200 + right).cast("int"))
            text = (
                F.when(iso, F.date_format(new, "yyyy-MM-dd"))
                .when(~slashes, F.date_format(new, "dd.MM.yyyy"))
                .when(american.isNull(), F.date_format(new, "dd/MM/yyyy"))
                .otherwise(F.date_format(new, "MM/dd/yyyy"))
            )
            return F.when(F.year(new).between(1000, 9999), text)

        return feistel(F.floor(place / 200), place % 200, 200, 200, key, "date", written)

    return F.when(date.isNotNull(), _let(F.datediff(date, epoch).cast("bigint"), moved))


def _shifted(s: Column, digest: Column) -> Column:
    """Each letter or digit of ``s`` moved within its alphabet by a byte of ``digest``."""
    return _let(digest, lambda d: _shifted_by(s, d))


def _shifted_by(s: Column, stream: Column) -> Column:
    chars = F.filter(F.split(s, ""), lambda c: c != "")

    def move(c: Column, i: Column) -> Column:
        return _let(F.struct(c.alias("c"), byte_at(i).alias("b")), lambda x: moved(x.c, x.b))

    def byte_at(i: Column) -> Column:
        return F.conv(F.substring(stream, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")

    def moved(c: Column, byte: Column) -> Column:
        def within(first: int, size: int) -> Column:
            return F.char(F.lit(first) + F.pmod(F.ascii(c) - first + byte, F.lit(size)))

        latin = [chr(x) for x in range(0xC0, 0x180) if x not in (0xD7, 0xF7)]
        place = F.instr(F.lit("".join(latin)), c)
        return (
            F.when(c.between("0", "9"), within(48, 10))
            .when(c.between("a", "z"), within(97, 26))
            .when(c.between("A", "Z"), within(65, 26))
            .when(place > 0, F.substring(F.lit("".join(latin)), F.pmod(place - 1 + byte, F.lit(len(latin))) + 1, F.lit(1)))
            .otherwise(_among_neighbours(c, byte))
        )

    return F.array_join(F.transform(chars, move), "")


def _among_neighbours(c: Column, byte: Column) -> Column:
    """The letter that comes first in steps of so many places around its group of code points.

    That is a permutation of the letters and numbers of the group. Other characters stay.
    """
    letter = r"^[\p{L}\p{N}]$"

    def written(point: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")

    def walked(point: Column) -> Column:
        low = point - point % GROUP
        start = F.struct(point.alias("point"), F.lit(False).alias("done"))

        def step(s: Column, _: Column) -> Column:
            new = low + F.pmod(s.point - low + byte, F.lit(GROUP))
            further = _let(new, lambda n: F.struct(n.alias("point"), written(n).rlike(letter).alias("done")))
            return F.when(s.done, s).otherwise(further)

        return F.aggregate(F.sequence(F.lit(1), F.lit(GROUP)), start, step, lambda s: written(s.point))

    return F.when(c.rlike(letter), _let(F.ascii(c), walked)).otherwise(c)


def _email(v: Column, key: str) -> Column:
    local, domain = F.regexp_extract(v, "^[^@]*", 0), F.regexp_extract(v, "@.*$", 0)
    n = F.length(local)
    cut = F.floor((n + 1) / 2).cast("int")

    def step(state: Column, i: Column) -> Column:
        def moved(half: Column, other: Column) -> Column:
            return _shifted(half, _hash(key, F.lit("email"), i, n, other))

        return F.when(
            i % 2 == 0, F.struct(moved(state.l, state.r).alias("l"), state.r.alias("r"))
        ).otherwise(F.struct(state.l.alias("l"), moved(state.r, state.l).alias("r")))

    start = F.struct(F.substring(local, F.lit(1), cut).alias("l"), F.substring(local, cut + 1, n).alias("r"))
    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return _let(done, lambda d: F.concat(d.l, d.r, domain))


_REPLACE = {
    "email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone,
}


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value; the value itself where none of its kinds is valid."""
    kinds = [
        F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), replace(value, key)) for kind, replace in _REPLACE.items()
    ]
    return F.coalesce(*kinds, value)


def pseudonymize(docs: DataFrame, key: str = DEFAULT_KEY, column: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``column`` replaced; nothing is shuffled."""
    return docs.withColumn(column, replaced(F.col(f"`{column}`"), key))


def replaced(text: Column, key: str = DEFAULT_KEY) -> Column:
    found = F.regexp_extract_all(text, F.lit(_ALL), F.lit(0))

    def put_back(values: Column) -> Column:
        return F.array_join(F.flatten(F.zip_with(F.split(text, _ALL, -1), values, lambda b, v: F.array(b, v))), "", "")

    def changed(values: Column) -> Column:
        pseudonyms = F.transform(values, lambda v: pseudonym(v, key))
        return F.when(F.size(values) == 0, text).otherwise(put_back(pseudonyms))

    return F.when(text.rlike("[0-9]|@"), _let(found, changed)).otherwise(text)
