"""Format-preserving pseudonyms for personal numbers, dates, addresses and keys inside texts.

A value that passes its kind's check is numbered inside the set of all values of its format, moved
by a keyed Feistel permutation of that set and written back in the same format. The permutation is
one to one, so equal values get equal pseudonyms in every document and different values different
ones; without the key the values cannot be told back. Column expressions only, no shuffle.

| kind | check | what is permuted |
|---|---|---|
| card | check digit (Luhn) | all digits between the first and the check digit, which is set anew |
| iban | remainder 1 modulo 97, also in printed groups of four or in small letters | the digits of the account; the check digits are set anew |
| ssn | no 000, 666 or 9xx area, no 00 group, no 0000 serial | the whole number among valid ones |
| phone | exchange starts with 2 to 9, or the number has a + or a bracket | the ten national digits among those of its class: area and exchange from 200, only the area below, exchange below |
| international | + and 8 to 15 digits, also in groups | all digits but the first two |
| ip | four numbers up to 255 | the 32-bit address |
| ip6 | eight groups, or fewer around `::` | its hexadecimal digits as written, so two spellings of an address are two values |
| date | a day between 1900 and 2099, with or without leading zeros | the day among those 73,049 |
| email | name, @, domain, letters of any script | letters and digits of the name, other letters as four of them; the domain stays |
| key | AWS-style id, 32 or more hex digits, value after `password=`, `"Token": "`, `Bearer` and the like | its letters and digits |
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
_FIRST_DAY, _DAYS = "1900-01-01", 73049  # 17 * 4297

# Lengths of IBANs by country, so that a printed one does not take in the word or number after it.
_IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}


def _printed_iban() -> str:
    """Groups of four, the last one shorter; other countries' end at the last group."""
    known = [
        f"(?:{'|'.join(names.split())})\\d{{2}}(?: [A-Z0-9]{{4}}){{{size // 4 - 1}}}"
        + (f" [A-Z0-9]{{{size % 4}}}" if size % 4 else "")
        for size, names in _IBAN_LENGTHS.items()
    ]
    others = "(?!" + "|".join(n for names in _IBAN_LENGTHS.values() for n in names.split()) + ")"
    rest = others + r"[A-Z]{2}\d{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?"
    return "(?:" + "|".join([*known, rest]) + r")(?!\w)"


_PRINTED_IBAN = _printed_iban()

# Words before a secret, and what may stand between the word and the secret.
_SECRET_WORDS = "(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"
_GIVEN = _SECRET_WORDS + r"""["']?\s{0,2}[=:]\s{0,2}["']?"""
_BEARER = r"(?i:bearer)\s"

# The shapes of values, tried in this order at every place that does not follow a
# letter, a digit or an underscore.
SHAPES = {
    "email": r"[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}](?:[\p{L}\p{N}-]*\.)+\p{L}{2,}+(?![\w\p{L}])",
    # Runs of more than 64 digits without a letter are numbers, not keys.
    "key": r"AKIA[0-9A-Z]{16}(?!\w)|[0-9a-f]{32,64}+(?!\w)|(?=\d*+[a-f])[0-9a-f]{65,}+(?!\w)",
    # Right after = three symbols will do; after a blank or a colon a short word is more likely prose.
    "secret": rf"(?<={_GIVEN})(?:[A-Za-z0-9+/_-]{{6,}}+|(?<==[\"']?)[A-Za-z0-9+/_-]{{3,}}+)"
    rf"|(?<={_BEARER})(?=[A-Za-z+/._~-]*+\d|[\w.~+/-]{{20}})[A-Za-z0-9+/_~-]{{3,}}+(?:\.[A-Za-z0-9+/_~-]++)*+",
    "iban": r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}+(?!\w)|[a-z]{2}\d{2}[a-z0-9]{11,30}+(?!\w)|" + _PRINTED_IBAN,
    "ip": r"(?<!\.)(?:\d{1,3}\.){3}\d{1,3}+(?!\w|\.\d)",
    "ip6": r"(?<!:)(?=[A-Fa-f:]*+\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "ssn": r"(?<!-)\d{3}-\d{2}-\d{4}(?![\w-])",
    "date": r"(?<![-./])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})"
    r"(?=T\d{2}(?::?\d{2}|Z?\b)|(?![\w-]|[./]\d))",
    "card": r"(?:\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{4} \d{6} \d{5}|\d{13,19}+)(?![\w-])",
    "phone": r"(?:\+?1[ .-]?)?\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}(?!\w)",
    "international": r"\+\d{8,15}+(?!\w)|\+\d(?: ?\d){7,14}(?!\w)",
}
# Every shape has one of these; most texts have none and are not searched further.
ANY_SIGN = rf"[0-9@]|{_GIVEN}|{_BEARER}|AKIA[A-Z]{{16}}|[a-f]{{32}}"
ANY_SHAPE = r"(?<![\w\p{L}])(?:" + "|".join(SHAPES.values()) + ")"


def _long(text: Column, base: int = 10) -> Column:
    return F.conv(text, base, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: Column, tweak: Column) -> Column:
    """A keyed permutation of the pairs (left < a, right < b), as a struct with left and right."""

    def round_(state: Column, i: Column) -> Column:
        def noise(half: Column, below: Column) -> Column:
            text = F.concat_ws("|", key, tweak, i.cast("string"), half.cast("string"))
            return _long(F.substring(F.sha2(text, 256), 1, 15), 16) % below

        even = i % 2 == 0
        return F.struct(
            F.when(even, (state["left"] + noise(state["right"], a)) % a)
            .otherwise(state["left"])
            .alias("left"),
            F.when(even, state["right"])
            .otherwise((state["right"] + noise(state["left"], b)) % b)
            .alias("right"),
        )

    start = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, round_)


def _paired(left, right, a: int, b: int, key: Column, kind: str, use: Callable) -> Column:
    """`use(left, right)` of the permuted pair, which is computed once."""
    pair = feistel(left, right, F.lit(a).cast("long"), F.lit(b).cast("long"), key, F.lit(kind))
    return F.transform(F.array(pair), lambda p: use(p["left"], p["right"]))[0]


def permute_symbols(symbols: Column, radix: int, key: Column, kind: str) -> Column:
    """Permute a string of base-`radix` digits among those of its length, 18 digits at a time."""

    def part(text: Column, i: Column) -> Column:
        n = F.length(text)
        u = F.floor(n / 2).cast("int")
        tweak = F.concat_ws(":", F.lit(kind), n.cast("string"), i.cast("string"))
        a, b = (F.round(F.pow(F.lit(float(radix)), x)).cast("long") for x in (u, n - u))
        left = F.when(u > 0, _long(F.left(text, u), radix)).otherwise(0)
        pair = feistel(left, _long(F.right(text, n - u), radix), a, b, key, tweak)

        def spelled(number: Column, size: Column) -> Column:
            return F.lower(F.lpad(F.conv(number.cast("string"), 10, radix), size, F.lit("0")))

        return F.transform(
            F.array(pair),
            lambda p: F.concat(
                F.when(u > 0, spelled(p["left"], u)).otherwise(""), spelled(p["right"], n - u)
            ),
        )[0]

    return F.array_join(F.transform(F.regexp_extract_all(symbols, F.lit("(?s).{1,18}"), 0), part), "")


def _refill(template: Column, symbols: Column, of: str) -> Column:
    """`template` with its characters of class `of` replaced, in order, by those of `symbols`."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(
        F.split(template, ""),
        start,
        lambda s, c: F.when(
            c.rlike(of),
            F.struct(
                F.concat(s["out"], F.substring(symbols, s["at"], F.lit(1))).alias("out"),
                (s["at"] + 1).alias("at"),
            ),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"],
    )


def _refill_long(template: Column, symbols: Column, of: str, not_of: str) -> Column:
    """The same for templates of any length, 256 characters at a time."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def add(state: Column, part: Column) -> Column:
        size = F.length(F.regexp_replace(part, not_of, ""))
        mine = F.substring(symbols, state["at"], size)
        return F.struct(
            F.concat(state["out"], _refill(part, mine, of)).alias("out"),
            (state["at"] + size).alias("at"),
        )

    parts = F.regexp_extract_all(template, F.lit("(?s).{1,256}"), F.lit(0))
    return F.aggregate(parts, start, add, lambda s: s["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _card(value: Column, key: Column) -> Column:
    digits = _digits(value)
    middle = F.substring(digits, F.lit(2), F.length(digits) - 2)
    body = F.concat(F.left(digits, F.lit(1)), permute_symbols(middle, 10, key, "card"))
    whole = F.transform(
        F.array(body),
        lambda b: F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: F.concat(b, c.cast("string"))),
            _luhn,
        )[0],
    )[0]
    return F.when(_luhn(digits), _refill(value, whole, "[0-9]"))


def _mod97(text: Column) -> Column:
    """A string of digits and capital letters (A is 10) modulo 97."""
    return F.aggregate(
        F.filter(F.split(text, ""), lambda c: c != ""),
        F.lit(0),
        lambda rest, c: F.when(c.rlike("[0-9]"), (rest * 10 + c.try_cast("int")) % 97)
        .otherwise((rest * 100 + F.ascii(c) - 55) % 97)
        .cast("int"),
    )


def _iban(value: Column, key: Column) -> Column:
    plain = F.upper(F.replace(value, F.lit(" "), F.lit("")))
    country, account = F.left(plain, F.lit(2)), F.substring(plain, F.lit(5), F.length(plain))
    valid = _mod97(F.concat(account, F.left(plain, F.lit(4)))) == 1
    moved = _refill(account, permute_symbols(_digits(account), 10, key, "iban"), "[0-9]")
    whole = F.transform(
        F.array(moved),
        lambda m: F.concat(
            country,
            F.lpad((F.lit(98) - _mod97(F.concat(m, country, F.lit("00")))).cast("string"), 2, "0"),
            m,
        ),
    )[0]
    return F.when(
        valid & (_digits(account) != ""),
        F.when(value.contains(" "), _refill(value, whole, "[A-Z0-9]"))
        .when(value == F.lower(value), F.lower(whole))
        .otherwise(whole),
    )


def _ssn(value: Column, key: Column) -> Column:
    area, group, serial = (_long(F.substring(value, i, n)) for i, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = area - 1 - F.when(area > 666, 1).otherwise(0)

    def spelled(left: Column, right: Column) -> Column:
        plain = F.floor(left / 99).cast("long") + 1
        number = plain + F.when(plain >= 666, 1).otherwise(0)
        return F.format_string("%03d-%02d-%04d", number, left % 99 + 1, right + 1)

    moved = _paired(index * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn", spelled)
    return F.when(valid, moved)


def _phone(value: Column, key: Column) -> Column:
    """Permuted inside its class of numbers, so that no two numbers become the same one."""
    digits = _digits(value)
    national = F.right(digits, F.lit(10))
    area, exchange, line = (_long(F.substring(national, i, n)) for i, n in ((1, 3), (4, 3), (7, 4)))
    low, odd = area < 200, exchange < 200

    def spelled(pair: Column) -> Column:
        left = pair["left"]
        by_area = F.floor(left / F.when(odd, 200).otherwise(800)).cast("long")
        number = F.format_string(
            "%03d%03d%04d",
            by_area + F.when(odd | low, 0).otherwise(200),
            F.when(odd, left % 200).otherwise(left % 800 + 200),
            pair["right"],
        )
        return _refill(value, F.concat(F.left(digits, F.length(digits) - 10), number), "[0-9]")

    left = (
        F.when(odd, area * 200 + exchange)
        .when(low, area * 800 + exchange - 200)
        .otherwise((area - 200) * 800 + exchange - 200)
    )
    size = F.when(odd, 200_000).when(low, 160_000).otherwise(640_000).cast("long")
    tweak = F.when(odd, "phone exchange").when(low, "phone area").otherwise("phone")
    pair = feistel(left, line, size, F.lit(10_000).cast("long"), key, tweak)
    # Without a + or a bracket, a number with a low exchange may be any other number.
    return F.when(~odd | value.rlike("[+(]"), F.transform(F.array(pair), spelled)[0])


def _international(value: Column, key: Column) -> Column:
    digits = _digits(value)
    rest = F.substring(digits, F.lit(3), F.length(digits))
    moved = F.concat(F.left(digits, F.lit(2)), permute_symbols(rest, 10, key, "international"))
    return _refill(value, moved, "[0-9]")


def _ip(value: Column, key: Column) -> Column:
    part = F.transform(F.split(value, "\\."), lambda x: _long(x))
    valid = F.forall(part, lambda x: x <= 255)
    moved = _paired(
        part[0] * 256 + part[1],
        part[2] * 256 + part[3],
        65536,
        65536,
        key,
        "ip",
        lambda l, r: F.concat_ws(
            ".",
            *[x.cast("string") for h in (l, r) for x in (F.floor(h / 256).cast("long"), h % 256)],
        ),
    )
    return F.when(valid, moved)


def _ip6(value: Column, key: Column) -> Column:
    symbols = F.lower(F.regexp_replace(value, "[^0-9A-Fa-f]", ""))
    groups = F.size(F.filter(F.split(value, ":"), lambda g: g != ""))
    return F.when(
        (groups < 8) | ~value.contains("::"),
        _refill(value, permute_symbols(symbols, 16, key, "ip6"), "[0-9A-Fa-f]"),
    )


# Patterns of dates and the forms they are tried for, in this order.
_DATES = {
    "yyyy-MM-dd": r"^\d{4}-",
    "yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}$",
    "yyyy/M/d": r"^\d{4}/",
    "dd.MM.yyyy": r"^\d{2}\.\d{2}\.",
    "d.M.yyyy": r"^\d{1,2}\.",
    "MM/dd/yyyy": r"^\d{2}/\d{2}/",
    "dd/MM/yyyy": r"^\d{2}/\d{2}/",
    "M/d/yyyy": r"^\d{1,2}/",
    "d/M/yyyy": r"^\d{1,2}/",
}


def _date(value: Column, key: Column) -> Column:
    """Month/day/year where that is a date, else day/month/year, for dates with slashes."""
    first = F.lit(_FIRST_DAY).cast("date")

    def read(pattern: str, form: str) -> Column:
        day = F.datediff(F.try_to_timestamp(value, F.lit(pattern)).cast("date"), first)
        known = F.when(value.rlike(form) & day.between(0, _DAYS - 1), day)
        return F.when(known.isNotNull(), F.struct(known.alias("day"), F.lit(pattern).alias("pattern")))

    def moved(found: Column) -> Column:
        day, pattern = found["day"], found["pattern"]

        def spelled(left: Column, right: Column) -> Column:
            new = F.date_add(first, (left * 4297 + right).cast("int"))
            return F.call_function("date_format", new, pattern)

        pair = _paired(F.floor(day / 4297), day % 4297, 17, 4297, key, "date", spelled)
        return F.when(found.isNotNull(), pair)

    found = F.coalesce(*[read(pattern, form) for pattern, form in _DATES.items()])
    return F.transform(F.array(found), moved)[0]


def _email(value: Column, key: Column) -> Column:
    """Letters beyond ASCII are spelled in four symbols first, under a tweak of their own."""
    name = F.lower(F.substring_index(value, "@", 1))
    spelled = F.array_join(
        F.transform(
            F.split(name, ""),
            lambda c: F.when(
                c.rlike(r"[^\x00-\x7F]"), F.lower(F.lpad(F.conv(F.ascii(c).cast("string"), 10, 36), 4, "0"))
            ).otherwise(c),
        ),
        "",
    )

    def moved(plain: Column, kind: str) -> Column:
        symbols = F.regexp_replace(plain, "[^a-z0-9]", "")
        new = _refill(plain, permute_symbols(symbols, 36, key, kind), "[a-z0-9]")
        return F.when(symbols != "", F.concat(new, F.lit("@"), F.substring_index(value, "@", -1)))

    return F.when(name.rlike(r"[^\x00-\x7F]"), moved(spelled, "email wide")).otherwise(moved(name, "email"))


def _key(value: Column, key: Column) -> Column:
    hexadecimal = value.rlike("^[0-9a-f]+$")
    aws = value.rlike("^AKIA[0-9A-Z]{16}$")
    tail = F.substring(value, F.lit(5), F.lit(16))
    symbols = F.lower(F.regexp_replace(value, "[^A-Za-z0-9]", ""))
    return (
        F.when(aws, F.concat(F.lit("AKIA"), F.upper(permute_symbols(F.lower(tail), 36, key, "aws"))))
        .when(hexadecimal, permute_symbols(value, 16, key, "hex"))
        .when(
            symbols != "",
            _refill_long(
                value, permute_symbols(symbols, 36, key, "key"), "[A-Za-z0-9]", "[^A-Za-z0-9]"
            ),
        )
    )


_MAKERS = {
    "email": _email,
    "key": _key,
    "iban": _iban,
    "ip": _ip,
    "ip6": _ip6,
    "ssn": _ssn,
    "date": _date,
    "card": _card,
    "phone": _phone,
    "international": _international,
}


def pseudonym(value: Column, key: Column, also_secret: Column) -> Column:
    """The pseudonym of one matched value, or null if it fails the check of every kind it looks like.

    `also_secret` tells that the value follows a word such as `password=`.
    """
    chosen = F.when(also_secret, _key(value, key))
    for kind, make in _MAKERS.items():
        looks = value.rlike(f"^(?:{SHAPES[kind]})$")
        chosen = F.coalesce(chosen, F.when(looks, make(value, key)))
    return chosen


def _unused(name: str, columns: list[str]) -> str:
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def pseudonymise(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """`docs` with every valid value in `column` replaced, and n_pseudonyms, the number replaced.

    A null text stays null with 0 pseudonyms; a text without valid values stays as it is. Repeated
    rows get equal results. Other columns pass through; an n_pseudonyms of the input is replaced.
    The key comes from a table of one row, so that no plan, log or page shows it.
    """
    docs = docs.drop("n_pseudonyms")
    cut_, new_, key_ = (_unused(name, docs.columns) for name in ("__cut", "__new", "__key"))
    text, cut = F.col(column), F.col(cut_)
    keys = docs.sparkSession.createDataFrame([(key,)], f"{key_} string")
    split = docs.join(F.broadcast(keys)).withColumn(
        cut_,
        F.when(
            text.rlike(ANY_SIGN),
            F.struct(
                F.split(text, ANY_SHAPE, -1).alias("between"),
                F.regexp_extract_all(text, F.lit(ANY_SHAPE), F.lit(0)).alias("values"),
            ),
        ),
    )
    secret = f"{_GIVEN}$|{_BEARER}$"
    new = F.transform(
        cut["values"],
        lambda v, i: F.struct(
            v.alias("old"),
            pseudonym(v, F.col(key_), F.get(cut["between"], i).rlike(secret)).alias("new"),
        ),
    )
    named = split.withColumn(new_, F.when(F.size(cut["values"]) > 0, new))
    joined = F.array_join(
        F.zip_with(
            cut["between"],
            F.transform(new_, lambda v: F.coalesce(v["new"], v["old"])),
            lambda between, value: F.concat(between, F.coalesce(value, F.lit(""))),
        ),
        "",
    )
    replaced = F.size(F.filter(new_, lambda v: v["new"].isNotNull()))
    return named.withColumns(
        {
            column: F.when(F.col(new_).isNull(), text).otherwise(joined),
            "n_pseudonyms": F.when(F.col(new_).isNull(), 0).otherwise(replaced).cast("int"),
        }
    ).drop(cut_, new_, key_)
