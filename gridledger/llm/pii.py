"""Format-preserving pseudonyms for personal data.

Values are found by one pattern, validated (check digits, ranges, calendar), and permuted within their own
format by a keyed Feistel network: a card number becomes another valid card number, a date another date. The permutation depends
on the key and the kind of value only, so equal values get equal pseudonyms in all documents and different
values different ones, without a table of values and without a shuffle.

A value is taken apart into two numbers, L below a and R below b; each round adds a keyed digest of one to the other, modulo a
or b. That is a permutation of all pairs, whatever a and b, so no value is ever out of its format.

Everything is built-in column functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import let, without

ROUNDS = 8
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters permuted at a time: their numbers stay exact.
RUN = 10
FIRST_DAY, DAYS_A, DAYS_B = "1900-01-01", 250, 292  # 73,000 days

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9])"
#: A secret runs to its end: a blank, a quote, a bracket, or a comma, semicolon, colon or ampersand.
SECRET = r"(?i:password|passwd|pwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_+/.=~!@#$%^*?-]{8,}"
ACCESS_KEY = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
#: Characters of an IBAN by country (ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
#: Of its country's length, where there is one; else as far as it goes.
IBAN = r"(?<![A-Za-z0-9])(?:" + "|".join(
    rf"(?:{c.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + "(?![A-Za-z0-9])"
    for n, c in IBAN_LENGTHS.items()) + r"|[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
#: Any separators or none after +1; else a mark or brackets somewhere, or blanks only and an area and exchange from 200 up.
PHONE = (
    r"(?<![\d+.-])(?:\+1[ .-]?(?:\(\d{3}\) ?|\d{3}[ .-]?)\d{3}[ .-]?\d{4}|(?:1[ .-]?)?(?:(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}"
    r"|\d{3} \d{3}[.-]\d{4}|[2-9]\d{2} [2-9]\d{2} \d{4}))(?!\d)"
)
ABROAD = r"(?<![\d+])\+[2-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,6}(?!\d)"
IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
ISO_DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
DAY_DATE = r"(?<![\d./])(?:\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?!\d|[./]\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5}|\d{13,19})(?!\d|-\d)"
#: Of several that fit at one place the first counts.
PATTERN = "|".join((EMAIL, SECRET, ACCESS_KEY, IBAN, PHONE, ABROAD, IP, ISO_DATE, DAY_DATE, SSN, CARD))


def _digest(key: str, kind: str, round_: Column, value: Column) -> Column:
    text = F.concat_ws(":", F.lit(key), F.lit(kind), round_.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, left: Column, right: Column, a: Column, b: Column) -> Column:
    """The permuted pair as a struct (l, r), 0 <= l < a and 0 <= r < b."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(pair: Column, i: Column) -> Column:
        even = i % 2 == 0
        moved_left = F.pmod(pair["l"] + F.pmod(_digest(key, kind, i, pair["r"]), a), a)
        moved_right = F.pmod(pair["r"] + F.pmod(_digest(key, kind, i, pair["l"]), b), b)
        return F.struct(
            F.when(even, moved_left).otherwise(pair["l"]).cast("long").alias("l"),
            F.when(even, pair["r"]).otherwise(moved_right).cast("long").alias("r"),
        )

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn)


def number(text: Column, alphabet: str) -> Column:
    """A string as a number whose digits are its characters' places in the alphabet."""
    return F.aggregate(
        F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0).cast("long"),
        lambda n, c: n * len(alphabet) + (F.instr(F.lit(alphabet), c) - 1))


def spelled(value: Column, length: Column, alphabet: str) -> Column:
    """`number` undone: so many characters."""
    base = F.lit(float(len(alphabet)))
    place = lambda i: F.floor(value / F.pow(base, (length - 1 - i).cast("double"))) % len(alphabet) + 1
    return F.when(length < 1, F.lit("")).otherwise(F.array_join(F.transform(
        F.sequence(F.lit(0), length - 1), lambda i: F.substr(F.lit(alphabet), place(i).cast("int"), F.lit(1))), ""))


def permuted(key: str, kind: str, text: Column, alphabet: str) -> Column:
    """Another string of the same length over the alphabet (2 * RUN characters at most)."""
    radix = F.lit(float(len(alphabet)))

    def over(t: Column) -> Column:
        n = F.length(t)
        half = F.floor(n / 2).cast("int")
        size = lambda k: F.pow(radix, k.cast("double")).cast("long")
        pair = feistel(
            key, f"{kind}{len(alphabet)}", number(F.substr(t, F.lit(1), half), alphabet),
            number(F.substr(t, half + 1, n - half), alphabet), size(half), size(n - half))
        return let(pair, lambda p: F.concat(spelled(p["l"], half, alphabet), spelled(p["r"], n - half, alphabet)))

    return let(text, over)


def by_class(key: str, kind: str, text: Column) -> Column:
    """Runs of small letters, capitals and digits permuted, each within its class; the rest stays."""
    runs = F.regexp_extract_all(text, F.lit(f"[a-z]{{1,{RUN}}}|[A-Z]{{1,{RUN}}}|[0-9]{{1,{RUN}}}|[^a-zA-Z0-9]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: (
        F.when(r.rlike("^[a-z]"), permuted(key, kind, r, LOWER)).when(r.rlike("^[A-Z]"), permuted(key, kind, r, UPPER))
        .when(r.rlike("^[0-9]"), permuted(key, kind, r, DIGITS)).otherwise(r))), "")


def refilled(model: Column, characters: Column) -> Column:
    """The model with its letters and digits replaced in turn."""
    parts = F.regexp_extract_all(model, F.lit("[A-Za-z0-9]+|[^A-Za-z0-9]+"), F.lit(0))
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(state: Column, part: Column) -> Column:
        filled = part.rlike("^[A-Za-z0-9]")
        return F.struct(
            F.concat(state["out"], F.when(filled, F.substr(characters, state["at"], F.length(part))).otherwise(part)).alias("out"),
            (state["at"] + F.when(filled, F.length(part)).otherwise(0)).alias("at"))

    return F.aggregate(parts, start, put)["out"]


def luhn_sum(digits: Column, doubled_first: Column) -> Column:
    """Sum of the digits from the right, every other one doubled, the last one too if `doubled_first`."""
    shift = F.when(doubled_first, 1).otherwise(0)

    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((i + shift) % 2 == 1, twice).otherwise(d)

    cells = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), weigh)
    return F.aggregate(cells, F.lit(0), lambda a, x: a + x)


def _card(key: str, m: Column) -> Column:
    def over(d: Column) -> Column:
        body = permuted(key, "card", F.substr(d, F.lit(1), F.length(d) - 1), DIGITS)
        again = let(body, lambda p: F.concat(p, ((10 - luhn_sum(p, F.lit(True)) % 10) % 10).cast("string")))
        return F.when(luhn_sum(d, F.lit(False)) % 10 == 0, let(again, lambda n: refilled(m, n))).otherwise(m)

    return let(F.regexp_replace(m, "[ -]", ""), over)


def _mod97(text: Column) -> Column:
    """Remainder of letters and digits read as one decimal number, A = 10 and so on."""
    def step(n: Column, c: Column) -> Column:
        v = F.instr(F.lit(DIGITS + UPPER), c) - 1
        return (n * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _iban(key: str, m: Column) -> Column:
    def over(d: Column) -> Column:
        country, body = F.substr(d, F.lit(1), F.lit(2)), F.substr(d, F.lit(5), F.length(d))
        valid = _mod97(F.concat(body, F.substr(d, F.lit(1), F.lit(4)))) == 1
        check = lambda b: F.lpad((98 - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0")
        again = let(by_class(key, "iban", body), lambda b: F.concat(country, check(b), b))
        return F.when(valid, let(again, lambda n: refilled(m, n))).otherwise(m)

    return let(F.regexp_replace(m, " ", ""), over)


def _phone(key: str, m: Column) -> Column:
    """Ten digits. Area and exchange from 200 to 999 stay there, areas below 200 stay below, and so do exchanges below 200 of other areas."""
    def over(d: Column) -> Column:
        ten = F.substr(d, F.length(d) - 9, F.lit(10))
        prefix = F.substr(d, F.lit(1), F.length(d) - 10)
        area, exchange, line = (F.substr(ten, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (4, 3), (7, 4)))
        odd_area, odd_exchange = area < 200, (area >= 200) & (exchange < 200)
        # The least area and exchange of the number's kind, and how many there are of each.
        least_area, areas = F.when(odd_area, 0).otherwise(200), F.when(odd_area, 200).otherwise(800)
        least_exchange = F.when(odd_area | odd_exchange, 0).otherwise(200)
        exchanges = F.when(odd_area, 1000).when(odd_exchange, 200).otherwise(800)
        pair = feistel(key, "phone", area - least_area, (exchange - least_exchange) * 10_000 + line, areas, exchanges * 10_000)
        pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
        again = let(pair, lambda p: F.concat(
            prefix, pad(p["l"] + least_area, 3), pad(F.floor(p["r"] / 10_000) + least_exchange, 3), pad(p["r"] % 10_000, 4)))
        return let(again, lambda n: refilled(m, n))

    return let(F.regexp_replace(m, "[^0-9]", ""), over)


def _abroad(key: str, m: Column) -> Column:
    """Two digits of country code and area stay, the others are permuted; 8 to 15 digits in all."""
    def over(d: Column) -> Column:
        again = F.concat(F.substr(d, F.lit(1), F.lit(2)), permuted(key, "abroad", F.substr(d, F.lit(3), F.length(d)), DIGITS))
        return F.when(F.length(d).between(8, 15), let(again, lambda n: refilled(m, n))).otherwise(m)

    return let(F.regexp_replace(m, "[^0-9]", ""), over)


def _ip(key: str, m: Column) -> Column:
    def over(o: Column) -> Column:
        pair = feistel(key, "ip", o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65_536), F.lit(65_536))
        octets = lambda n: (F.floor(n / 256).cast("string"), (n % 256).cast("string"))
        again = let(pair, lambda p: F.concat_ws(".", *octets(p["l"]), *octets(p["r"])))
        return F.when(F.array_max(o) < 256, again).otherwise(m)

    return let(F.transform(F.split(m, r"\."), lambda x: x.cast("int")), over)


def _moved(key: str, day: Column, write: Callable[[Column], Column], otherwise: Column) -> Column:
    """A date of the range permuted within it; any other text stays."""
    first = F.lit(FIRST_DAY).cast("date")
    offset = F.datediff(day, first)
    pair = feistel(key, "date", F.floor(offset / DAYS_B), offset % DAYS_B, F.lit(DAYS_A), F.lit(DAYS_B))
    again = let(pair, lambda p: write(F.date_add(first, (p["l"] * DAYS_B + p["r"]).cast("int"))))
    return F.when(offset.between(0, DAYS_A * DAYS_B - 1), again).otherwise(otherwise)


def _iso_date(key: str, m: Column) -> Column:
    return let(m.try_cast("date"), lambda d: _moved(key, d, lambda x: x.cast("string"), m))


def _day_date(key: str, m: Column) -> Column:
    """Day first where that is a date, else month first; two digits where the value had two."""
    def over(p: Column) -> Column:
        iso = lambda d, mon: F.concat_ws("-", p[2], F.lpad(mon, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")
        mark = F.when(F.instr(m, "/") > 0, "/").otherwise(".")
        day_first, month_first = iso(p[0], p[1]), iso(p[1], p[0])

        def write(first: str, second: str) -> Callable[[Column], Column]:
            padded = lambda x, part, model: F.when(
                F.length(model) == 2, F.date_format(x, part * 2)).otherwise(F.date_format(x, part))
            return lambda x: F.concat(padded(x, first, p[0]), mark, padded(x, second, p[1]), mark, F.date_format(x, "yyyy"))

        return F.when(day_first.isNotNull(), _moved(key, day_first, write("d", "M"), m)).otherwise(
            _moved(key, month_first, write("M", "d"), m))

    return let(F.split(m, "[./]"), over)


def _ssn(key: str, m: Column) -> Column:
    """Area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999."""
    def over(p: Column) -> Column:
        valid = (p[0].between(1, 899)) & (p[0] != 666) & (p[1] > 0) & (p[2] > 0)
        area = p[0] - F.when(p[0] > 666, 2).otherwise(1)
        pair = feistel(key, "ssn", area, (p[1] - 1) * 9999 + p[2] - 1, F.lit(898), F.lit(99 * 9999))
        pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
        again = let(pair, lambda q: F.concat_ws(
            "-", pad(q["l"] + F.when(q["l"] >= 665, 2).otherwise(1), 3), pad(F.floor(q["r"] / 9999) + 1, 2), pad(q["r"] % 9999 + 1, 4)))
        return F.when(valid, again).otherwise(m)

    return let(F.transform(F.split(m, "-"), lambda x: x.cast("int")), over)


def _email(key: str, m: Column) -> Column:
    """Lower-cased, so that one mailbox has one pseudonym; the last label stays."""
    def over(e: Column) -> Column:
        return F.concat(by_class(key, "email", F.regexp_extract(e, r"^(.*)\.[a-z]+$", 1)), F.regexp_extract(e, r"(\.[a-z]+)$", 1))

    return let(F.lower(m), over)


def _secret(key: str, m: Column) -> Column:
    """The name of a secret stays, its value is permuted."""
    head = F.regexp_extract(m, r"^(.*?[=:]\s*[\"']?)", 1)
    return F.concat(head, by_class(key, "secret", F.substr(m, F.length(head) + 1, F.length(m))))


def _access_key(key: str, m: Column) -> Column:
    return F.concat(F.substr(m, F.lit(1), F.lit(4)), by_class(key, "secret", F.substr(m, F.lit(5), F.length(m))))


def pseudonym(key: str, m: Column) -> Column:
    """Pseudonym of a match of PATTERN; a value that is not valid in its format stays as it is."""
    return (
        F.when(m.rlike(r"[=:]"), _secret(key, m))
        .when(m.contains("@"), _email(key, m))
        .when(m.rlike(r"^A[KS]IA"), _access_key(key, m))
        .when(m.rlike(r"^[A-Z]"), _iban(key, m))
        .when(m.rlike(r"^\+[2-9]"), _abroad(key, m))
        .when(m.rlike(r"^\d{4}-\d{2}-\d{2}$"), _iso_date(key, m))
        .when(m.rlike(r"^\d{1,2}[./]\d{1,2}[./]\d{4}$"), _day_date(key, m))
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), _ssn(key, m))
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), _ip(key, m))
        .when(m.rlike(r"^(\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})$"), _card(key, m))
        .otherwise(_phone(key, m))
    )


def _replaced(key: str, text: Column) -> Column:
    """Struct (text, n): the text with its pseudonyms, and how many values were replaced."""
    def over(found: Column) -> Column:
        return let(F.transform(found, lambda m: pseudonym(key, m)), lambda new: F.struct(
            F.array_join(F.zip_with(F.split(text, PATTERN, -1), new, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "").alias("text"),
            F.size(F.filter(F.zip_with(found, new, lambda x, y: x != y), lambda d: d)).cast("long").alias("n")))

    plain = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))
    return F.when(text.rlike(PATTERN), let(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), over)).otherwise(plain)


def pseudonymise(documents: DataFrame, key: str, *, text: str = "text", count: str | None = None) -> DataFrame:
    """The documents with the personal data of `text` replaced; with `count`, a column of that name says how often.

    All other columns stay as they are, NULLs and odd names too (but for one named like `count`, which is replaced). A NULL text stays NULL and an
    empty one empty. Repeated rows and equal values anywhere get the same pseudonyms under one key. An empty table stays empty.
    """
    kept = without(documents, [count]) if count else documents
    made = "_pseudonyms"
    whole = kept.withColumn(made, _replaced(key, F.col(f"`{text}`").cast("string")))
    columns = [F.col(f"{made}.text").alias(c) if c == text else F.col(f"`{c}`") for c in kept.columns]
    return whole.select(*columns, *([F.col(f"{made}.n").alias(count)] if count else []))
