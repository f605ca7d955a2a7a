"""Personal data replaced by format-preserving pseudonyms.

One pattern finds candidates; each is validated in its own way (check digits,
calendar, ranges) and replaced by a keyed permutation of the values that share
its format.  The permutations are Feistel networks: a value is split into two
parts, and each round adds a keyed hash of one part to the other, modulo the
number of values that part can have.  Check digits are computed anew.  So equal
values get equal pseudonyms in all documents, different values different ones,
and a pseudonym is as valid as what it replaces.

A text is split at the matches and put together again; nothing is shuffled, and
only DataFrame functions run here.  The regular expression takes time linear in
the text: what may repeat is bounded, possessive or tied to its start.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.llm.common import fresh

ROUNDS = 5  # of two half rounds each
LONG = 64  # characters
#: Days from 1900-01-01 to 2099-12-31 are permuted among themselves.
FIRST_DAY = "1900-01-01"
DAYS = 73_049
#: Valid social security numbers: areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999.
SSN_AREAS, SSN_GROUPS, SSN_SERIALS = 898, 99, 9999

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_YEAR, _MONTH, _DAY = r"(?:19|20)\d\d", r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])"
_M, _D = r"(?:0?[1-9]|1[0-2])", r"(?:0?[1-9]|[12]\d|3[01])"
_QUOTE = r"(?:\\?[\"'])?"  # JSON within JSON escapes its quotes
_SECRET = (
    r"(?i:token|password|passwd|pwd|secret(?:[_-]?(?:access[_-]?)?key)?|(?:api|access|private|auth)[_-]?key)"
    rf"{_QUOTE}\s{{0,4}}[=:]\s{{0,4}}{_QUOTE}"
)
_BEARER = r"(?i:bearer)\s{1,4}"
_BASE64 = r"[0-9A-Za-z+/_~=-]++"
#: Beginnings of keys that stay as they are; words joined by dashes have no digit.
_ISSUER = r"(?:AKIA|ASIA|gh[pousr]_|github_pat_|sk-|xox[abprs]-|AIza|eyJ)"
_URL64 = r"[A-Za-z0-9_-]"
#: Lengths of IBANs by country; a spaced one ends there, and letters may follow.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_SPACED = "|".join(
    rf"(?:{'|'.join(countries.split())})\d\d(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" [A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, countries in IBAN_LENGTHS.items()
)
#: Candidates in the order in which they are tried at a place of the text.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++(?:'[\p{L}\p{N}._%+-]++){0,3}+@(?:[A-Za-z0-9-]{1,63}+\.){1,32}+[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])(?=[Agsxe])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|github_pat_[0-9A-Za-z_]{22,255}+"
    rf"|sk-(?=[A-Za-z_-]{{0,64}}\d){_URL64}{{20,255}}+|xox[abprs]-(?=[A-Za-z-]{{0,64}}\d)[0-9A-Za-z-]{{10,255}}+|AIza{_URL64}{{35}}"
    rf"|eyJ{_URL64}{{8,}}+\.{_URL64}{{8,}}+\.{_URL64}{{8,}}+)(?![A-Za-z0-9])",
    "secret": rf"(?<![A-Za-z])(?=[tpsabTPSAB])(?:{_SECRET}[0-9A-Za-z+/_-]{{8,}}+"
    rf"|{_BEARER}(?=[0-9A-Za-z+/_.~=-]{{16}})(?=[A-Za-z+/_.~-]{{0,64}}\d){_BASE64}(?:\.{_BASE64})*+)",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)",
    "date": rf"(?<!\d){_YEAR}-{_MONTH}-{_DAY}(?!\d)|(?<!\d){_DAY}(?<dot>[./]){_MONTH}\k<dot>{_YEAR}(?!\d)"
    rf"|(?<![\d./])(?:{_D}(?<short>[./]){_M}\k<short>|{_M}/{_D}/){_YEAR}(?!\d|[./]\d)|(?<![\d-]){_YEAR}-{_M}-{_D}(?![\d-])"
    rf"|(?<![\d-])(?:{_D}-{_M}|{_M}-{_D})-{_YEAR}(?![\d-])",
    "ssn": r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\d-])"
    r"|(?<![\d-])(?<!\d )(?!000|666|9)\d{3} (?!00)\d\d (?!0000)\d{4}(?![\d-]| \d)",
    "phone": r"\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}(?!\d)"
    r"|\+\d{1,3}[ .-]?(?:\(\d\) ?)?\d(?:[ .-]\d{2,4}){2,4}(?!\d)"
    r"|\+\d{1,3}[ .-]?\(0\) ?\d{1,5}(?:[ .-]?\d{2,8}){1,3}(?!\d)"
    r"|(?<![\d.-])1(?<long>[ .-])\d{3}\k<long>\d{3}\k<long>\d{4}(?![\d-])"
    r"|\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d.-])\d{3}(?<mark>[.-])\d{3}\k<mark>\d{4}(?![\d-])",
    "iban": r"(?<![A-Za-z0-9])(?=[A-Z]{2}\d\d|[a-z]{2}\d\d)"
    rf"(?:{_SPACED}|[A-Z]{{2}}\d\d(?:[A-Z0-9]{{11,30}}+|(?: \d{{4}}){{3,7}}+(?: \d{{1,3}})?)|[a-z]{{2}}\d\d[a-z0-9]{{11,30}}+)(?![A-Za-z0-9])",
    "card": r"(?<![\d-])(?:\d{13,19}|\d{4}(?<four>[ .-])\d{4}\k<four>\d{4}\k<four>\d{1,7}|\d{4}(?<six>[ -])\d{6}\k<six>\d{5})(?!\d)",
}
_LETTERS, _NUMBERS = ("email", "key", "secret", "iban"), ("ip", "date", "ssn", "phone", "card")
#: All of them; inside a word two tests are enough to go on.
ANY = r"(?<!\p{L})(?:%s)|(?=[\d+(])(?:%s)" % tuple(
    "|".join(f"(?:{PATTERNS[k]})" for k in kinds) for kinds in (_LETTERS, _NUMBERS)
)


def let(value: Column, use) -> Column:  # noqa: ANN001
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


# Permutations ---------------------------------------------------------------------------------------


def keyed(key: str, kind: str | Column, step: Column, value: Column) -> Column:
    """A keyed hash as a number below 2**60."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind) if isinstance(kind, str) else kind, step.cast("string"), value.cast("string")).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, lefts: Column, rights: Column, key: str, kind: str) -> Column:
    """Struct (left, right) of permuted numbers, the parts below ``lefts`` and ``rights``."""
    step = F.sequence(F.lit(1), F.lit(ROUNDS))

    def one(state: Column, i: Column) -> Column:
        a = (state.left + keyed(key, kind, 2 * i, state.right) % lefts) % lefts
        return let(
            F.struct(a.alias("left"), state.right.alias("right")),
            lambda s: F.struct(
                s.left.alias("left"), ((s.right + keyed(key, kind, 2 * i + 1, s.left) % rights) % rights).alias("right")
            ),
        )

    return F.aggregate(step, F.struct(left.cast("long").alias("left"), right.cast("long").alias("right")), one)


def permute_number(value: Column, count: int, key: str, kind: str) -> Column:
    """A number from 0 to ``count`` - 1; ``count`` is split into two factors."""
    small = next(d for d in range(math.isqrt(count), 0, -1) if count % d == 0)
    rest = F.lit(count // small).cast("long")
    return let(
        feistel(F.floor(value / rest), value % rest, F.lit(small).cast("long"), rest, key, kind),
        lambda s: s.left * rest + s.right,
    )


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A string of 2 to 36 digits, with as many digits."""
    head = F.floor(F.length(digits) / 2).cast("int")
    tail = F.length(digits) - head
    power = lambda n: F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")
    parts = feistel(
        F.substring(digits, F.lit(1), head).cast("long"),
        F.substring(digits, head + 1, tail).cast("long"),
        power(head),
        power(tail),
        key,
        kind,
    )
    return let(
        parts,
        lambda s: F.concat(F.lpad(s.left.cast("string"), head, F.lit("0")), F.lpad(s.right.cast("string"), tail, F.lit("0"))),
    )


#: Letters outside A to Z change within these ranges of code points, which hold letters only.
LETTERS = (
    (0xC0, 0xD6), (0xD8, 0xDE), (0xDF, 0xF6), (0xF8, 0xFF), (0x100, 0x17F), (0x391, 0x3A1), (0x3A3, 0x3AB), (0x3AC, 0x3CE),
    (0x400, 0x42F), (0x430, 0x45F), (0x531, 0x556), (0x561, 0x586), (0x5D0, 0x5EA), (0x620, 0x64A), (0x905, 0x939),
    (0xE01, 0xE30), (0x10D0, 0x10F0), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3),
)


def foreign_letter(c: Column, moved: Column) -> Column:
    """A letter outside A to Z moved within its range; one outside all ranges becomes one of a to z."""
    code = F.ascii(c).cast("long")
    found = F.lit(None).cast("struct<low:bigint,size:bigint>")
    for first, last in LETTERS:
        own = F.struct(F.lit(first).cast("long").alias("low"), F.lit(last - first + 1).cast("long").alias("size"))
        found = F.when(code.between(first, last), own).otherwise(found)
    place = let(found, lambda r: r.low + (code - r.low + moved) % r.size)
    new = F.decode(F.unhex(F.lpad(F.hex(place), 4, "0")), "UTF-16BE")
    latin = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (moved % 26 + 1).cast("int"), F.lit(1))
    return F.when(c.rlike(r"^[\p{L}&&[^A-Za-z]]$"), F.coalesce(new, latin))


def permute_letters(value: Column, key: str, kind: str | Column, hexadecimal: Column | None = None) -> Column:
    """A string whose digits and letters change within their alphabets; the rest stays.

    Where ``hexadecimal`` holds, letters of a value that has none beyond f (in one case)
    stay within a to f.  Two values can only meet there: one with and one without
    a letter beyond f.
    """
    small, large = F.lit("abcdefghijklmnopqrstuvwxyz"), F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    if hexadecimal is not None:
        small = F.when(hexadecimal & value.rlike("^[0-9a-f]+$"), "abcdef").otherwise(small)
        large = F.when(hexadecimal & value.rlike("^[0-9A-F]+$"), "ABCDEF").otherwise(large)

    def alphabet(c: Column) -> Column:
        own = F.when(c.rlike("^[0-9]$"), "0123456789")
        return own.when(c.rlike("^[a-z]$"), small).when(c.rlike("^[A-Z]$"), large)

    def add(part: Column, other: Column, step: Column) -> Column:
        def char(c: Column, i: Column) -> Column:
            moved = lambda a: F.substring(
                a, ((F.instr(a, c) - 1 + keyed(key, kind, step * 1000 + i, other) % F.length(a)) % F.length(a) + 1).cast("int"), F.lit(1)
            )
            return F.coalesce(let(alphabet(c), moved), foreign_letter(c, keyed(key, kind, step * 1000 + i, other)), c)

        return F.array_join(F.transform(F.split(part, ""), char), "")

    def brief(other: Column) -> Column:
        """Every character hashes the other half; of a long one a digest, else time grows with the square."""
        return F.when(F.length(other) > LONG, F.sha2(other.cast("binary"), 256)).otherwise(other)

    head = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(
        F.substring(value, F.lit(1), head).alias("left"),
        F.substring(value, head + 1, F.length(value) - head).alias("right"),
    )

    def one(state: Column, i: Column) -> Column:
        return let(
            F.struct(let(brief(state.right), lambda o: add(state.left, o, 2 * i)).alias("left"), state.right.alias("right")),
            lambda s: F.struct(s.left.alias("left"), let(brief(s.left), lambda o: add(s.right, o, 2 * i + 1)).alias("right")),
        )

    return let(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, one), lambda s: F.concat(s.left, s.right))


# Formats --------------------------------------------------------------------------------------------


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def fill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits``, separators kept."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("used"))

    def put(state: Column, c: Column) -> Column:
        is_digit = c.rlike(r"^\d$")
        return F.struct(
            F.concat(state.text, F.when(is_digit, F.substring(digits, state.used + 1, F.lit(1))).otherwise(c)).alias("text"),
            (state.used + is_digit.cast("int")).alias("used"),
        )

    return F.aggregate(F.split(shape, ""), start, put, lambda s: s.text)


def luhn_sum(digits: Column) -> Column:
    """The check sum of card numbers: every second digit from the right counts double, its digits added."""
    return F.aggregate(
        F.transform(
            F.reverse(F.split(digits, "")),
            lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c >= "5", 9).otherwise(0)),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )


def card(value: Column, key: str) -> Column:
    def new(digits: Column) -> Column:
        body = permute_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
        with_check = let(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(luhn_sum(digits) % 10 == 0, fill(value, with_check))

    return let(digits_of(value), new)


def ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.substring(value, *at).cast("long") for at in ((1, 3), (5, 2), (8, 4)))
    left = (area - 1 - (area > 666).cast("long")) * SSN_GROUPS + group - 1
    lefts = F.lit(SSN_AREAS * SSN_GROUPS).cast("long")
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")

    def new(s: Column) -> Column:
        a = F.floor(s.left / SSN_GROUPS) + 1
        mark = F.substring(value, 4, 1)
        return F.concat(pad(a + (a >= 666).cast("long"), 3), mark, pad(s.left % SSN_GROUPS + 1, 2), mark, pad(s.right + 1, 4))

    return let(feistel(left, serial - 1, lefts, F.lit(SSN_SERIALS).cast("long"), key, "ssn"), new)


def ip(value: Column, key: str) -> Column:
    part = F.split(value, r"\.")
    pair = lambda i: part[i].cast("long") * 256 + part[i + 1].cast("long")
    size = F.lit(65_536).cast("long")
    text = lambda x: [F.floor(x / 256).cast("string"), (x % 256).cast("string")]
    return let(feistel(pair(0), pair(2), size, size, key, "ip"), lambda s: F.concat_ws(".", *text(s.left), *text(s.right)))


def date(value: Column, key: str) -> Column:
    """Another day in the same form; where the year is last the day comes first if that is a date."""
    forms = [("-", 0, 1, 2, "yyyy-MM-dd"), ("-", 2, 1, 0, "dd-MM-yyyy"), ("-", 2, 0, 1, "MM-dd-yyyy"), ("/", 2, 1, 0, "dd/MM/yyyy")]
    forms += [("/", 2, 0, 1, "MM/dd/yyyy"), (".", 2, 1, 0, "dd.MM.yyyy")]
    short = value.rlike(r"(?<!\d)\d(?!\d)")
    parts = F.split(value, "[-./]")
    result = F.lit(None).cast("string")
    for mark, year, month, of_month, form in forms:
        iso = F.concat_ws("-", parts[year], parts[month], parts[of_month])
        day = F.when(F.contains(value, F.lit(mark)), F.datediff(iso.try_cast("date"), F.lit(FIRST_DAY).cast("date")))

        def new(d: Column) -> Column:
            moved = F.date_add(F.lit(FIRST_DAY).cast("date"), permute_number(d.cast("long"), DAYS, key, "date").cast("int"))
            brief = form.replace("MM", "M").replace("dd", "d")
            return F.when(d.isNotNull(), let(moved, lambda m: F.when(short, F.date_format(m, brief)).otherwise(F.date_format(m, form))))

        result = F.coalesce(result, let(day, new))
    return result


def phone(value: Column, key: str) -> Column:
    """The country code stays, and a zero in brackets behind it; the other digits are permuted."""
    code = F.regexp_extract(value, r"^(\+\d{1,3}(?=[ .(-])(?:[ .-]?\(0\))?|1(?=[ .-])|\+?)", 1)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    return F.concat(code, fill(rest, permute_digits(digits_of(rest), key, "phone")))


def mod97(value: Column) -> Column:
    """Remainder of a string of digits and capitals (A counts 10) as one number."""
    number = F.array_join(
        F.transform(F.split(value, ""), lambda c: F.when(c >= "A", (F.ascii(c) - 55).cast("string")).otherwise(c)), ""
    )
    return F.aggregate(F.split(number, ""), F.lit(0), lambda a, c: (a * 10 + c.cast("int")) % 97)


def iban(value: Column, key: str) -> Column:
    """In small letters it is the same number, and gets the same pseudonym."""

    def new(plain: Column) -> Column:
        country, check, body = F.substring(plain, 1, 2), F.substring(plain, 3, 2), F.substring(plain, F.lit(5), F.length(plain))
        valid = mod97(F.concat(body, country, check)) == 1
        made = let(permute_letters(body, key, "iban"), lambda b: F.concat(
            country, F.lpad((98 - mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b))
        # Spaces are only found between groups of four.
        spaced = F.rtrim(F.regexp_replace(made, "(.{4})", "$1 "))
        shaped = F.when(F.contains(value, F.lit(" ")), spaced).when(value.rlike("[a-z]"), F.lower(made)).otherwise(made)
        return F.when(valid, shaped)

    return let(F.upper(F.regexp_replace(value, " ", "")), new)


def email(value: Column, key: str) -> Column:
    """The last label of the domain stays."""
    name, last = F.regexp_extract(value, r"^(.*)\.[^.]+$", 1), F.regexp_extract(value, r"(\.[^.]+)$", 1)
    return F.concat(permute_letters(name, key, "email"), last)


def secret(value: Column, key: str) -> Column:
    """The name before the value stays; a key that may stand elsewhere without a name changes as it does there."""
    name = F.regexp_extract(value, f"^({_SECRET}|{_BEARER})", 1)

    def new(rest: Column) -> Column:
        known = rest.rlike(f"^(?:{PATTERNS['key']})$")
        issuer = F.when(known, F.regexp_extract(rest, f"^({_ISSUER})", 1)).otherwise("")
        body = F.substring(rest, F.length(issuer) + 1, F.length(rest))
        return F.concat(name, issuer, permute_letters(body, key, F.when(known, "key").otherwise("secret"), ~known))

    return let(F.substring(value, F.length(name) + 1, F.length(value)), new)


def access_key(value: Column, key: str) -> Column:
    """What tells the issuer stays."""
    issuer = F.regexp_extract(value, f"^({_ISSUER})", 1)
    return F.concat(issuer, permute_letters(F.substring(value, F.length(issuer) + 1, F.length(value)), key, "key"))


FORMATS = {
    "email": email, "key": access_key, "secret": secret, "ip": ip, "date": date, "ssn": ssn, "phone": phone,
    "iban": iban, "card": card,
}


def kind_of(value: Column) -> Column:
    """Which pattern found a candidate."""
    found = F.when(F.contains(value, F.lit("@")), "email").when(value.rlike(f"^(?:{PATTERNS['key']})$"), "key")
    found = found.when(value.rlike(f"^(?:{_SECRET}|{_BEARER})"), "secret").when(value.rlike(f"^(?:{PATTERNS['ip']})$"), "ip")
    for kind in ("date", "ssn", "phone", "iban"):
        found = found.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return found.otherwise("card")


def candidate(value: Column) -> Column:
    """Struct (kind, before, value, after): a card number within what only looks like an IBAN stands for itself."""
    plain = F.upper(F.regexp_replace(value, " ", ""))
    valid = mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1

    def found(before: Column, kind: Column, own: Column, after: Column) -> Column:
        return F.struct(kind.alias("kind"), before.alias("before"), own.alias("value"), after.alias("after"))

    def within(kind: Column) -> Column:
        number = F.when((kind == "iban") & ~valid, F.regexp_extract(value, f"({PATTERNS['card']})", 1))

        def split(n: Column) -> Column:
            at = F.instr(value, n)
            inside = found(F.substring(value, F.lit(1), at - 1), F.lit("card"), n, F.substring(value, at + F.length(n), F.length(value)))
            return F.when(n != "", inside).otherwise(found(F.lit(""), kind, value, F.lit("")))

        return let(number, split)

    return let(kind_of(value), within)


def pseudonymize(df: DataFrame, key: str, text: str = "text", spans: str | None = None) -> DataFrame:
    """``df`` with pseudonyms in its texts; ``spans`` names a new array column of what was replaced.

    A span has kind, pseudonym and start (the offset in the new text, from 0).
    Candidates that are not valid stay as they are; a card number within a
    candidate for an IBAN is looked for again.  Null texts stay null and have no
    spans.  Row order, repeated rows and other columns are kept.
    """
    (made,) = fresh(df, "made")
    body = F.col(text).cast("string")
    no_spans = F.array().cast("array<struct<kind:string,pseudonym:string,start:int>>")

    def replaced(value: Column) -> Column:
        def by_kind(c: Column) -> Column:
            new = F.lit(None).cast("string")
            for name, permuted in FORMATS.items():
                new = F.when(c["kind"] == name, permuted(c["value"], key)).otherwise(new)
            return let(
                new,
                lambda n: F.struct(
                    F.when(n.isNotNull(), c["kind"]).alias("kind"),
                    F.concat(c["before"], F.coalesce(n, c["value"]), c["after"]).alias("text"),
                    n.alias("pseudonym"),
                    F.length(c["before"]).alias("lead"),
                ),
            )

        return let(candidate(value), by_kind)

    def joined(row: Column) -> Column:
        pieces = F.transform(row["parts"], lambda p, i: F.concat(p, F.coalesce(F.get(row["new"], i)["text"], F.lit(""))))
        start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), no_spans.alias("spans"))

        def step(state: Column, new: Column) -> Column:
            at = state["at"] + F.length(F.get(row["parts"], state["i"]))
            span = F.struct(new["kind"].alias("kind"), new["pseudonym"].alias("pseudonym"), (at + new["lead"]).alias("start"))
            grown = F.when(new["kind"].isNull(), state["spans"]).otherwise(F.array_append(state["spans"], span))
            return F.struct((at + F.length(new["text"])).alias("at"), (state["i"] + 1).alias("i"), grown.alias("spans"))

        found = F.aggregate(row["new"], start, step, lambda state: state["spans"]) if spans else no_spans
        return F.struct(F.array_join(pieces, "").alias("text"), found.alias("spans"))

    def rewritten(found: Column) -> Column:
        # Few texts have a candidate; only those are split.
        row = F.struct(F.split(body, ANY, -1).alias("parts"), F.transform(found, replaced).alias("new"))
        return F.when(F.size(found) > 0, let(row, joined)).otherwise(F.struct(body.alias("text"), no_spans.alias("spans")))

    result = df.withColumn(made, let(F.regexp_extract_all(body, F.lit(ANY), F.lit(0)), rewritten))
    if spans:
        result = result.withColumn(spans, F.coalesce(F.col(made)["spans"], no_spans))
    return result.withColumn(text, F.col(made)["text"]).drop(made)
