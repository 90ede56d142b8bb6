"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Each text is split at its validated finds; each find is replaced in place and the text joined
again. Digits go through a keyed Feistel network over the decimal strings of their length
(alternating, unequal halves, rounds of truncated SHA-256 under the key), so the map is a
permutation within the format and equal values stay equal in all documents:

- card numbers (13 to 19 digits that pass the Luhn test): all digits but the last are
  permuted, the last is the new check digit; separators stay. In a run of digit groups that isn't
  one itself, cards are sought from group to group, so one beside a date of expiry, a CVV or
  another number is found;
- IBANs that pass mod 97, which end at their country's length: the digits after the check are permuted, the check is computed anew;
- phone numbers: digits are permuted, punctuation stays; a leading + and country code (of E.164) stay;
- US social security numbers that can be issued (no area 000, 666 or 9xx, no group 00, no serial 0000):
  permuted among those;
- calendar dates (ISO, and day.month.year, month/day/year): the day number is
  permuted by its high and low parts and printed in the same layout, 1900-2099 among themselves;
- IPv4 addresses: each address is a permuted 32-bit number;
- e-mail addresses: the part before the @ goes through a Feistel network on its two halves, in which letters and
  digits move within their classes; the domain and upper case stay; keys and tokens (AKIA..., key = "hex")
  likewise, so a letter stays a letter and a digit a digit.

All of these are permutations: different values of a kind never become equal. So a value may also become itself;
that is likely only for a few characters (one e-mail name of two letters in 676).
Numbers that fail validation (Luhn, mod 97, calendar, issued, 0-255) stay as they are.

Edge cases: null text stays null; empty text stays empty; a text may be of any length; rows
are independent, so ties, repeated rows and null ids change nothing; an empty table gives an
empty result. Other columns are passed on untouched by pseudonymise().
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Days from 1900-01-01 to 2100-01-02, and from 0001-01-01 to 9999-12-31, as products of two moduli.
DAYS_A, DAYS_B, ALL_A, ALL_B = 229, 319, 1717, 2127
#: From 0001-01-01 to 1900-01-01.
DAYS_BEFORE = 693_595
#: Area and group numbers, and serial numbers, of social security numbers.
SSN_A, SSN_B = 898 * 99, 9999
#: Groups of digits that one step of a fold joins.
FOLD = 256
#: Repeated groups are possessive or counted: Java's regular expressions recurse on others, once for each repeat.
_EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++"
#: After a colon, as in prose, only what is quoted or holds a digit.
_SECRET = r"\bAKIA[0-9A-Z]{16}\b|\b(?:password|passwd|token|secret|api_?key)\s*+(?:=\s*+[\"']?|:\s*+(?:[\"']|(?=[A-Za-z+/_\-]*+[0-9])))[A-Za-z0-9+/_\-]{8,}+"
#: Countries by the length of their IBAN; at that length a find ends, whatever follows.
_IBANS = {15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU"}
_IBAN = "|".join(rf"\b(?:{c})\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}\b" for n, c in _IBANS.items()) + r"|\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
_DATE = r"(?<![\d./\-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d]|[./\-]\d)"
_IP = r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)"
_SSN = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
_PHONE = r"(?<![\w.])(?:\+\d{1,3}[ .\-]?)?\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}(?!\d)|(?<![\w.])\+(?=(?:[ .\-]?\d){8})\d{1,3}(?:[ .\-]?\d{2,4}){2,5}(?!\d)|(?<![\w.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])"
#: A run of digits in groups, which may hold cards among other numbers; it ends where another kind of find begins.
_CARD = rf"(?<!\d)\d(?:(?! (?:{_DATE}|{_IP}|{_SSN}|{_PHONE}))[ \-]?\d){{12,}}+(?!\d)"
_USUAL = r"^(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3}|\d{4}[ \-]\d{6}[ \-]\d{4,5})[ \-]?$"
#: Country codes of phone numbers (ITU E.164): one digit, two, and else three.
_COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: US social security numbers that can be issued.
_ISSUED = r"^(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}$"
#: In order of precedence where finds start alike.
ANY = "|".join((_EMAIL, _SECRET, _IBAN, _DATE, _IP, _SSN, _PHONE, _CARD))


#: Each find has one of these, or AKIA.
SIGN = "[0-9@=:]"


def _round(key: str, salt: Column, i: Column, half: Column) -> Column:
    """48 keyed bits of a half."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), salt, i.cast("string"), half), 256), 1, 12), 16, 10).cast("long")


def feistel(digits: Column, key: str, salt: Column) -> Column:
    """A keyed permutation of the decimal strings of that length (two digits at least, up to
    30); one digit alone is shifted by a keyed amount."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    right = (n - left).cast("int")
    ten: Column = lambda k: F.pow(F.lit(10.0), k).cast("long")
    text: Column = lambda value, size: F.lpad(value.cast("string"), size, "0")
    start = F.struct(F.substring(digits, F.lit(1), left).cast("long").alias("a"), F.substring(digits, left + 1, right).cast("long").alias("b"))

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        a = F.when(even, F.pmod(s["a"] + _round(key, salt, i, text(s["b"], right)), ten(left))).otherwise(s["a"])
        b = F.when(even, s["b"]).otherwise(F.pmod(s["b"] + _round(key, salt, i, text(s["a"], left)), ten(right)))
        return F.struct(a.alias("a"), b.alias("b"))

    mixed = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(text(s["a"], left), text(s["b"], right)))
    one = F.pmod(digits.cast("long") + _round(key, salt, F.lit(0), F.lit("")), F.lit(10)).cast("string")
    return F.when(n < 2, one).otherwise(mixed)


def _pair(number: Column, a: int, b: int, key: str, salt: str) -> Column:
    """A keyed permutation of the numbers below a * b, on high and low parts modulo a and b."""
    start = F.struct(F.floor(number / b).cast("long").alias("a"), (number % b).cast("long").alias("b"))

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        one = F.when(even, F.pmod(s["a"] + _round(key, F.lit(salt), i, s["b"].cast("string")), F.lit(a))).otherwise(s["a"])
        two = F.when(even, s["b"]).otherwise(F.pmod(s["b"] + _round(key, F.lit(salt), i, s["a"].cast("string")), F.lit(b)))
        return F.struct(one.alias("a"), two.alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["a"] * b + s["b"])


def fill(layout: Column, digits: Column) -> Column:
    """layout with its digits replaced, in order, by the given ones."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    chars = F.split(layout, "")

    def step(s: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        return F.struct(F.concat(s["out"], F.when(is_digit, F.substring(digits, s["k"], F.lit(1))).otherwise(c)).alias("out"), (s["k"] + is_digit.cast("int")).alias("k"))

    return F.aggregate(chars, start, step, lambda s: s["out"])


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def check_digit(payload: Column) -> Column:
    """The Luhn digit that completes the payload."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(payload)), F.lit(0),
        lambda s, i: s + F.when(i % 2 == 1, (F.substring(F.reverse(payload), i, F.lit(1)).cast("int") * 2).cast("int")).otherwise(F.substring(F.reverse(payload), i, F.lit(1)).cast("int"))
        - F.when((i % 2 == 1) & (F.substring(F.reverse(payload), i, F.lit(1)).cast("int") > 4), 9).otherwise(0),
    )
    return F.pmod(-total, F.lit(10)).cast("string")


def _mod97(text: Column) -> Column:
    """Letters count as 10 to 35."""
    return F.aggregate(F.split(text, ""), F.lit(0), lambda s, c: F.when(c.rlike("[0-9]"), (s * 10 + c.cast("int")) % 97).when(c.rlike("[A-Z]"), (s * 100 + F.ascii(c) - 55) % 97).otherwise(s))


def _date(x: Column, key: str) -> Column:
    """A date in its layout; null if the calendar lacks it. Days of 1900 to 2099 stay among themselves."""
    iso, dotted = x.rlike(r"^\d{4}-"), x.contains(".")
    day = F.coalesce(
        F.when(iso, F.try_to_timestamp(x, F.lit("yyyy-MM-dd"))).when(dotted, F.try_to_timestamp(x, F.lit("dd.MM.yyyy"))).otherwise(F.try_to_timestamp(x, F.lit("MM/dd/yyyy"))).cast("date")
    )
    number = F.datediff(day, F.lit("1900-01-01").cast("date"))
    recent = (number >= 0) & (number < DAYS_A * DAYS_B)
    near = _pair(number, DAYS_A, DAYS_B, key, "date")
    # others are permuted among all days, again until the day is none of those
    within: Column = lambda d: (d >= DAYS_BEFORE) & (d < DAYS_BEFORE + DAYS_A * DAYS_B)
    walk = F.aggregate(F.sequence(F.lit(0), F.lit(31)), _pair(number + DAYS_BEFORE, ALL_A, ALL_B, key, "day"), lambda d, _: F.when(within(d), _pair(d, ALL_A, ALL_B, key, "day")).otherwise(d))
    to = F.date_add(F.lit("1900-01-01").cast("date"), F.when(recent, near).otherwise(walk - DAYS_BEFORE).cast("int"))
    return F.when(iso, F.date_format(to, "yyyy-MM-dd")).when(dotted, F.date_format(to, "dd.MM.yyyy")).otherwise(F.date_format(to, "MM/dd/yyyy"))


def _ssn(x: Column, key: str) -> Column:
    """A number that can be issued becomes another; null if it can't be."""
    area, group, serial = (F.substring(x, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    at = (F.when(area > 666, area - 2).otherwise(area - 1) * 99 + group - 1) * SSN_B + serial - 1
    spell = lambda v: F.concat_ws("-", *(F.lpad(y.cast("string"), n, "0") for y, n in ((_area(F.floor(v / (99 * SSN_B))), 3), (F.floor(v / SSN_B) % 99 + 1, 2), (v % SSN_B + 1, 4))))
    return F.when(x.rlike(_ISSUED), _let(_pair(at, SSN_A, SSN_B, key, "ssn"), spell))


def _area(i: Column) -> Column:
    return F.when(i >= 665, i + 2).otherwise(i + 1)


def _address(x: Column, key: str) -> Column:
    parts = F.transform(F.split(x, r"\."), lambda p: p.cast("long"))
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda s, p: s * 256 + p)
    start = F.struct(F.floor(number / 65536).cast("long").alias("a"), (number % 65536).alias("b"))
    step = lambda s, i: F.struct(s["b"].alias("a"), F.pmod(s["a"] + _round(key, F.lit("ip"), i, s["b"].cast("string")), F.lit(65536)).alias("b"))
    out = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.array_join(F.transform(F.array(F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256), lambda p: p.cast("string")), "."))
    return F.when(F.forall(parts, lambda p: p <= 255), out)


def _scramble(x: Column, key: str, salt: Column) -> Column:
    """A keyed permutation of the strings of x's length and layout: a-z, A-Z and 0-9 stay what they are, all else stays.
    A Feistel network on both halves; a half's characters move by a stream from the other half."""
    classes = (("a", "z", 97, 26), ("A", "Z", 65, 26), ("0", "9", 48, 10))

    def moved(half: Column, other: Column, i: Column) -> Column:
        seed = F.sha2(F.concat_ws("|", F.lit(key), salt, i.cast("string"), F.array_join(other, "")), 256)
        stream = lambda d: F.transform(F.sequence(F.lit(0), F.floor(F.size(half) / 8).cast("int")), lambda n: F.sha2(F.concat(d, n.cast("string")), 256))

        def turn(blocks: Column) -> Column:
            def one(c: Column, j: Column) -> Column:
                by = F.conv(F.substring(F.element_at(blocks, (F.floor(j / 8) + 1).cast("int")), (j % 8 * 8 + 1).cast("int"), F.lit(8)), 16, 10).cast("long")
                out = c
                for lo, hi, first, size in classes:
                    out = F.when((c >= lo) & (c <= hi), F.char(F.lit(first) + F.pmod(F.ascii(c) - first + by, F.lit(size)))).otherwise(out)
                return out

            return F.transform(half, one)

        return _let(seed, lambda d: _let(stream(d), turn))

    def network(chars: Column) -> Column:
        left = F.floor(F.size(chars) / 2).cast("int")
        start = F.struct(F.slice(chars, F.lit(1), left).alias("a"), F.slice(chars, left + 1, F.size(chars) - left).alias("b"))

        def step(s: Column, i: Column) -> Column:
            even = i % 2 == 0
            return F.struct(F.when(even, moved(s["a"], s["b"], i)).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(moved(s["b"], s["a"], i)).alias("b"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.array_join(F.concat(s["a"], s["b"]), ""))

    return _let(F.split(x, ""), network)


def _email(x: Column, key: str) -> Column:
    """The part before the @ is permuted, whatever its case, among those of the domain; case and domain stay."""
    at = F.locate("@", x)
    name, domain = F.substring(x, F.lit(1), at - 1), F.substring(x, at, F.length(x))
    new = _scramble(F.lower(name), key, F.concat(F.lit("email"), F.lower(domain)))
    cased = F.zip_with(F.split(name, ""), F.split(new, ""), lambda a, b: F.when((a >= "A") & (a <= "Z"), F.upper(b)).otherwise(b))
    return F.concat(F.array_join(cased, ""), domain)


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _is_card(d: Column) -> Column:
    return (F.length(d) >= 13) & (F.length(d) <= 19) & (check_digit(F.substring(d, F.lit(1), F.length(d) - 1)) == F.substring(d, -1, 1))


def _card(x: Column, key: str) -> Column:
    d = _digits(x)
    new = feistel(F.substring(d, F.lit(1), F.length(d) - 1), key, F.lit("card"))
    return _let(new, lambda body: fill(x, F.concat(body, check_digit(body))))


def _cards(x: Column, key: str) -> Column:
    """A run of digits with its cards replaced: the whole run if it is one; else, from the left, the longest
    groups that are one, unless a card in a usual layout begins within them."""

    def parts(groups: Column) -> Column:
        text = lambda i, k: F.array_join(F.slice(groups, i, k), "")

        def best(i: Column) -> Column:
            found = F.filter(F.sequence(F.lit(1), F.least(F.lit(19), F.size(groups) - i + 1)), lambda k: _let(_digits(text(i, k)), _is_card))
            most = lambda of: F.coalesce(F.array_max(of), F.lit(0))
            return _let(found, lambda f: F.struct(most(F.filter(f, lambda k: text(i, k).rlike(_USUAL))).alias("usual"), most(f).alias("any")))

        def fold(bests: Column) -> Column:
            def step(s: Column, i: Column) -> Column:
                b = F.element_at(bests, i)
                later = F.exists(F.slice(bests, i + 1, F.greatest(b["any"] - 1, F.lit(0))), lambda c: c["usual"] > 0)
                size = F.when(b["usual"] > 0, b["usual"]).when(later, 0).otherwise(b["any"])
                took = _let(size, lambda k: F.when(k > 0, F.struct(F.concat(s["out"], _let(text(i, k), lambda t: _card(t, key))).alias("out"), (i + k).alias("next"))).otherwise(F.struct(F.concat(s["out"], F.element_at(groups, i)).alias("out"), (i + 1).alias("next"))))
                return F.when(i < s["next"], s).otherwise(took)

            def chunk(s: Column, c: Column) -> Column:
                of = F.sequence(c * FOLD + 1, F.least(F.size(groups), (c + 1) * FOLD))
                part = F.aggregate(of, F.struct(F.lit("").alias("out"), s["next"].alias("next")), step)
                return _let(part, lambda p: F.struct(F.concat(s["out"], p["out"]).alias("out"), p["next"].alias("next")))

            # in chunks, as a string grown group by group costs the square of its length
            chunks = F.sequence(F.lit(0), F.floor((F.size(groups) - 1) / FOLD).cast("int"))
            return F.aggregate(chunks, F.struct(F.lit("").alias("out"), F.lit(1).alias("next")), chunk, lambda s: s["out"])

        return _let(F.transform(F.sequence(F.lit(1), F.size(groups)), best), fold)

    whole = _let(_digits(x), _is_card)
    return F.when(whole, _card(x, key)).otherwise(_let(F.regexp_extract_all(x, F.lit(r"\d+[ \-]?"), F.lit(0)), parts))


def pseudonym(x: Column, key: str) -> Column:
    """What stands for one find; the find itself if it isn't valid."""
    d = _digits(x)
    bare = F.regexp_replace(x, " ", "")
    account = F.substring(bare, F.lit(5), F.length(bare))
    account_digits = _digits(account)
    account_new = fill(account, feistel(account_digits, key, F.concat(F.lit("iban"), F.substring(bare, 1, 2))))
    check = F.lpad((98 - _mod97(F.concat(account_new, F.substring(bare, 1, 2), F.lit("00")))).cast("string"), 2, "0")
    iban = F.when((_mod97(F.concat(account, F.substring(bare, 1, 4))) == 1) & (account_digits != ""), fill(x, F.concat(check, _digits(account_new))))
    code = F.regexp_extract(x, _COUNTRY, 0)
    number = F.substring(x, F.length(code) + 1, F.length(x))
    phone = F.concat(code, fill(number, feistel(_digits(number), key, F.lit("phone"))))
    secret = F.regexp_extract(x, r"^(AKIA|.*?[=:]\s*[\"']?)", 1)
    hidden = F.substring(x, F.length(secret) + 1, F.length(x))
    full = lambda p: x.rlike(f"^(?:{p})$")
    return (
        F.when(full(_EMAIL), _email(x, key))
        .when(full(_SECRET), F.concat(secret, _scramble(hidden, key, F.lit("secret"))))
        .when(x.rlike(r"^[A-Z]{2}\d{2}"), F.coalesce(iban, x))
        .when(full(r"\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4}"), F.coalesce(_date(x, key), x))
        .when(full(r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"), F.coalesce(_address(x, key), x))
        .when(full(r"\d{3}-\d{2}-\d{4}"), F.coalesce(_ssn(x, key), x))
        .when(full(r"\d(?:[ \-]?\d){12,}+"), _cards(x, key))
        .otherwise(phone)
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """docs with the text replaced, and __found, __replaced: how many finds, and how many changed. Columns of docs
    with these two names are replaced."""
    body = F.col(f"`{text_col}`").cast("string")
    # most texts have no find: they are passed on without being split. Working columns have names of their own
    finds, fresh = (f"__pii_{x}_{uuid.uuid4().hex}" for x in ("finds", "new"))
    parts = docs.withColumn(finds, F.when((body.rlike(SIGN) | body.contains("AKIA")) & body.rlike(ANY), F.regexp_extract_all(body, F.lit(ANY), F.lit(0))))
    parts = parts.withColumn(fresh, F.transform(finds, lambda x: pseudonym(x, key)))
    joined = F.array_join(F.flatten(F.zip_with(F.split(body, ANY, -1), F.col(fresh), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    changed = F.size(F.filter(F.zip_with(finds, fresh, lambda a, b: a != b), lambda x: x))
    return parts.select(*[F.when(F.col(finds).isNull(), body).otherwise(joined).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in ("__found", "__replaced")], F.coalesce(F.size(finds), F.lit(0)).alias("__found"), F.coalesce(changed, F.lit(0)).alias("__replaced"))
