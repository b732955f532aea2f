"""Personal data with DataFrame functions only (operator 6).

Regular expressions propose spans; Luhn and modulo 97 confirm them; words
nearby raise or lower the score of the proposals beyond the base kinds. Spark
returns matches without offsets, so positions are running sums over the matches
and the pieces between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Each pattern matches what its base form matches leftmost and without overlap,
# written so that Java's matcher needs time in proportion to the text: runs are
# possessive, and a match starts only where a run starts (or, for addresses,
# where the last match ended).
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}"
_RUN_START = r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])"
CARD = _RUN_START + r"(?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Length of an account number by country code (ISO 13616 registry).
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}
_CODES = "|".join(codes.replace(" ", "|") for codes in _IBAN_LENGTHS.values())
_FIXED = "|".join(rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in _IBAN_LENGTHS.items())
# a known country's number has its length, whatever follows; others are maximal runs
IBAN = rf"(?<![A-Za-z0-9])(?:{_FIXED}|(?!{_CODES})[A-Z][A-Z][0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+)(?![A-Za-z0-9])"
SHORT_CARD = _RUN_START + r"(?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])"
LOCAL_PHONE = r"(?<![0-9+().-])(?<![0-9)]\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![\x20.-]?[0-9])"

# Words that speak for or against a kind when they stand nearby.
_NEAR = {
    "iban": "iban|account|bank|transfer|konto|compte|cuenta",
    "short_card": "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta",
    "local_phone": "phone|tel|telephone|call|fax|mobile|telefon|portable",
}
_AGAINST = "order|invoice|version|serial|isbn|tracking|part"
#: Code points on either side that count as nearby.
REACH = 40
#: Score of a pattern, what a passed checksum adds, what a word nearby adds or takes.
_SCORES = {"iban": (0.3, 0.5), "short_card": (0.1, 0.3), "local_phone": (0.4, 0.0)}
_WORD_FOR, _WORD_AGAINST, ACCEPT = 0.3, 0.3, 0.6
KINDS = ("email", "ip", "card", "phone")


def _let(value: Column, use) -> Column:
    """use(value), with `value` worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(lengths: Column) -> Column:
    """Running sums: in round k each place takes in the sum of the 2**k before it.
    This takes n log n steps; an aggregate that appends to an array copies it n times."""

    def round_(sums, k):
        step = F.call_function("shiftleft", F.lit(1), k)
        return F.when(step < F.size(sums), F.transform(sums, lambda x, i: x + F.when(i >= step, F.get(sums, i - step)).otherwise(0))).otherwise(sums)

    return F.aggregate(F.sequence(F.lit(0), F.lit(30)), lengths, round_)


def _matches(text: Column, pattern: str, needs: Column, around: bool = False) -> Column:
    """array<struct<m,s,e>> of a pattern's matches: text, start and end (exclusive)
    in code points; with `around` also `near`, up to REACH code points on either
    side. `needs` is a cheap test that every text with a match passes."""
    pieces = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("gap"))
    size = lambda x: F.coalesce(F.char_length(x), F.lit(0))

    def placed(all_):
        ends = _running(F.transform(all_, lambda x: size(x["gap"]) + size(x["m"])))
        return F.zip_with(all_, ends, lambda x, e: F.struct(x["m"].alias("m"), (e - size(x["m"])).alias("s"), e.alias("e"), *((F.left(x["gap"], F.lit(REACH)).alias("head"), F.right(x["gap"], F.lit(REACH)).alias("tail")) if around else ())))

    def nearby(all_, x, i):
        # a match has 12 code points or more, so REACH goes over 3 others at most
        part = lambda j, name: F.coalesce(F.get(all_, i + j)[name], F.lit(""))
        before = F.concat(*(part(j, name) for j in range(-4, 0) for name in ("tail", "m")), x["tail"])
        after = F.concat(*(part(j, name) for j in range(1, 5) for name in ("head", "m")))
        return F.struct(x["m"].alias("m"), x["s"].alias("s"), x["e"].alias("e"), F.concat(F.right(before, F.lit(REACH)), F.lit(" | "), F.left(after, F.lit(REACH))).alias("near"))

    spans = _let(pieces, placed)
    if around:
        spans = _let(spans, lambda all_: F.transform(all_, lambda x, i: nearby(all_, x, i)))
    empty = F.array().cast(f"array<struct<m: string, s: int, e: int{', near: string' if around else ''}>>")
    return F.when(needs, F.filter(spans, lambda x: x["m"].isNotNull())).otherwise(empty)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, i):
        x = F.substring(digits, i, F.lit(1)).cast("int")
        double = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when((F.length(digits) - i) % 2 == 1, double).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _mod97(m: Column) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))

    def add(rest, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c >= 65, (rest * 100 + c - 55) % 97).otherwise((rest * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _scored(spans: Column, kind: str, checksum) -> Column:
    """Proposals of a kind whose score reaches ACCEPT."""
    base, passed = _SCORES[kind]

    def score(x):
        around = F.lower(x["near"])
        near = F.when(around.rlike(rf"\b(?:{_NEAR[kind]})\b"), _WORD_FOR).otherwise(0.0) - F.when(around.rlike(rf"\b(?:{_AGAINST})\b"), _WORD_AGAINST).otherwise(0.0)
        return F.lit(base) + (F.when(checksum(x["m"]), passed).otherwise(-passed) if checksum else F.lit(0.0)) + near

    return F.filter(spans, lambda x: F.round(score(x), 6) >= ACCEPT)


def _named(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.concat(F.lit(f"{kind}:"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string")))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, n_added.

    Base spans are matches of the four base patterns that pass their test
    (parts up to 255; 16 to 19 digits and Luhn; 8 to 15 digits). Added after
    them in `spans` are account numbers (iban, modulo 97), cards of 13 to 15
    digits with Luhn and a word nearby (short_card) and national telephone
    numbers with a word nearby (local_phone). Positions are code points, end
    exclusive. Null text is empty; a null identifier is kept; repeated rows give
    equal rows; other columns are ignored; an empty table gives none.
    """
    t = F.col("text")
    octet = r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])\.?){4}$"
    count = lambda m: F.length(_digits(m))
    has = lambda x: F.contains(t, F.lit(x))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # three cheap tests, each made once
    rows = rows.select("doc_id", "text", t.rlike(r"[0-9]\.[0-9]").alias("dotted"), t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}").alias("long_run"), t.rlike(r"[A-Z]{2}[0-9]{2}").alias("coded"))
    rows = rows.select(
        "doc_id",
        "text",
        _matches(t, EMAIL, has("@")).alias("email"),
        _matches(t, IP, F.col("dotted")).alias("ip"),
        _matches(t, CARD, F.col("long_run")).alias("card"),
        _matches(t, PHONE, has("+")).alias("phone"),
        _matches(t, IBAN, F.col("coded"), True).alias("iban"),
        _matches(t, SHORT_CARD, F.col("long_run"), True).alias("short_card"),
        _matches(t, LOCAL_PHONE, t.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"), True).alias("local_phone"),
    )
    rows = rows.select(
        "doc_id",
        "text",
        "email",
        F.filter("ip", lambda x: x["m"].rlike(octet)).alias("ip"),
        F.filter("card", lambda x: _luhn(_digits(x["m"]))).alias("card"),
        F.filter("phone", lambda x: (count(x["m"]) >= 8) & (count(x["m"]) <= 15)).alias("phone"),
        _scored(F.col("iban"), "iban", _mod97).alias("iban"),
        _scored(F.col("short_card"), "short_card", lambda m: _luhn(_digits(m))).alias("short_card"),
        _scored(F.col("local_phone"), "local_phone", None).alias("local_phone"),
    )
    base = F.concat(*(_named(k, F.col(k)) for k in KINDS))
    added = F.concat(*(_named(k, F.col(k)) for k in _NEAR))
    rows = rows.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), base.alias("base"), added.alias("added"))
    return rows.select(
        "doc_id",
        *(f"n_{k}" for k in KINDS),
        F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join(F.concat("base", "added"), ",").alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
