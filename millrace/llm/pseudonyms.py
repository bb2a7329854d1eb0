"""Format-preserving pseudonyms for personal numbers, dates and addresses, by keyed Feistel permutations.

Values are found by shape, validated, and permuted within the set of valid values of their format: a payment card stays
a card with a right check digit, a date stays a date. A permutation maps different values to different ones and equal
values to equal ones in every document, so links survive; who has the key can undo it.

A shape that fails validation takes nothing from its neighbours. Kinds are sought in the order email, IBAN, card as
printed (one run, 4-4-4-4 with up to three more, 4-6-4, 4-6-5), phone, date, SSN and IP, card in other groups. In a run
of digit groups with a space or hyphen between, each group may start a card or IBAN, and the longest valid one is taken.
Undoing reads the new text by the same rules; where digits touch a value with only a space or hyphen between, a chance
check digit can make another card of them, so there the undo isn't certain.

=======  =====================================================  ============================================
kind     valid                                                  permuted
=======  =====================================================  ============================================
card     13-19 digits with a right Luhn digit                   all but the first digit; check digit anew
ssn      area 001-899 but 666, group and serial not 0           all
phone    ten digits with or without 1 before                    all ten digits, assignable ones among themselves
ip       four octets up to 255                                  all 32 bits
date     1900-2099: y-m-d, y/m/d, d.m.y, and d/m or m/d by      the day's number
         ``slash``
iban     mod-97 right                                           account part by class; check digits anew
email    address                                                letters and digits of the local part by class
=======  =====================================================  ============================================

Numbers use an alternating Feistel network over two residues, so the domain's size needs no power of two and no
cycle walking; strings shift letters and digits of one half by a keyed hash of the other. Only DataFrame functions are
used and nothing is shuffled. Defined cases: null texts stay null with counts 0; texts of any length are treated whole;
shapes that fail validation stay as they are; repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind

ROUNDS = 10
KINDS = ("card", "ssn", "phone", "ip", "date", "iban", "email")
#: The shapes, in the order in which they are tried. Runs are taken whole from their start, so time is linear.
SHAPES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}([-/])[0-9]{2}\1[0-9]{2}|[0-9]{2}([./])[0-9]{2}\2(?:19|20)[0-9]{2})(?![0-9/-]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
}


#: Runs in which cards and IBANs are sought by validity: values may touch others with a space or hyphen between.
CARD_RUN = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}+"
IBAN_RUN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]*+(?![a-z])(?: [A-Z0-9]++(?![a-z]))*+"
#: How cards are printed. Other groupings are tried after phone numbers, SSNs and dates.
PRINTED = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$"
#: Noncharacters around what is done: OPEN, the kind's letter, the new value, CLOSE. Those of the text itself are escaped.
OPEN, CLOSE = "\ufdd0", "\ufdd1"
DONE = f"{OPEN}[^{CLOSE}]*+{CLOSE}"
#: Dates, SSNs and IP addresses, which may also touch a value that is done with a hyphen between.
REST = "|".join((
    rf"(?:(?<![0-9./-])|(?<={CLOSE}-))(?:(?:19|20)[0-9]{{2}}([-/])[0-9]{{2}}\1[0-9]{{2}}|[0-9]{{2}}([./])[0-9]{{2}}\2(?:19|20)[0-9]{{2}})(?![0-9/]|-(?!{OPEN})|\.[0-9])",
    rf"(?:(?<![0-9-])|(?<={CLOSE}-))[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![0-9]|-(?!{OPEN}))",
    SHAPES["ip"],
))
LETTERS = {"card": "c", "ssn": "s", "phone": "p", "ip": "i", "date": "d", "iban": "b", "email": "e"}


def _long(x) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).cast("long")


def _round(key: str, tweak: Column | str, i: Column, x: Column) -> Column:
    """60 pseudorandom bits of the key, the format, the round and the other half."""
    tweak = F.lit(tweak) if isinstance(tweak, str) else tweak
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), x.cast("string")), 256), 1, 15), 16, 10).cast("long")


def permute(left: Column, right: Column, a, b, key: str, tweak: Column | str, back: bool = False) -> Column:
    """The pair (left in 0..a-1, right in 0..b-1) under the keyed permutation of pairs, as struct(l, r); ``back`` undoes it."""
    rounds = range(ROUNDS)[::-1] if back else range(ROUNDS)
    sign = F.lit(-1 if back else 1)
    a, b = _long(a), _long(b)
    start = F.struct(_long(left).alias("l"), _long(right).alias("r"))

    def step(s, i):
        even = F.struct(F.pmod(s["l"] + sign * (_round(key, tweak, i, s["r"]) % a), a).alias("l"), s["r"].alias("r"))
        odd = F.struct(s["l"].alias("l"), F.pmod(s["r"] + sign * (_round(key, tweak, i, s["l"]) % b), b).alias("r"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    return F.aggregate(F.array(*[F.lit(i) for i in rounds]), start, step)


def _chars(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substring(s, i, F.lit(1)))).otherwise(F.array().cast("array<string>"))


def _shift(c: Column, by: Column) -> Column:
    code = F.ascii(c)
    move = lambda first, n: F.char(F.pmod(code - first + by, F.lit(n)) + first)
    return F.when(c.rlike("^[0-9]$"), move(48, 10)).when(c.rlike("^[a-z]$"), move(97, 26)).when(c.rlike("^[A-Z]$"), move(65, 26)).otherwise(c)


def permute_string(s: Column, key: str, tweak: str, back: bool = False) -> Column:
    """Letters and digits of ``s`` permuted within their classes; other characters stay."""
    sign = F.lit(-1 if back else 1)

    def moved(part, other, i):
        stream = lambda n: F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), i.cast("string"), F.floor(n / 8).cast("string"), other), 256), F.pmod(n, F.lit(8)) * 8 + 1, F.lit(7)), 16, 10).cast("int")
        return F.array_join(F.transform(_chars(part), lambda c, n: _shift(c, sign * (stream(n) % 130))), "")

    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substring(s, F.lit(1), half).alias("l"), F.substring(s, half + 1, F.length(s)).alias("r"))

    def step(p, i):
        return F.when(i % 2 == 0, F.struct(moved(p["l"], p["r"], i).alias("l"), p["r"].alias("r"))).otherwise(F.struct(p["l"].alias("l"), moved(p["r"], p["l"], i).alias("r")))

    rounds = range(ROUNDS)[::-1] if back else range(ROUNDS)
    return bind(F.aggregate(F.array(*[F.lit(i) for i in rounds]), start, step), lambda p: F.concat(p["l"], p["r"]))


def fill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced one by one by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    put = lambda acc, c: F.when(c.rlike("^[0-9]$"), F.struct(F.concat(acc["out"], F.substring(digits, acc["k"], F.lit(1))).alias("out"), (acc["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["k"].alias("k")))
    return F.aggregate(_chars(shape), start, put)["out"]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _pad(x: Column, n) -> Column:
    return F.lpad(x.cast("string"), n, "0")


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum, the last digit counted once."""
    n = F.length(digits)
    d = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + F.when((n - i) % 2 == 1, F.when(d(i) > 4, d(i) * 2 - 9).otherwise(d(i) * 2)).otherwise(d(i)))


def mod97(s: Column) -> Column:
    """An IBAN's remainder; letters count as 10 to 35."""
    return F.aggregate(_chars(s), F.lit(0), lambda acc, c: F.when(c.rlike("^[0-9]$"), (acc * 10 + F.try_to_number(c, F.lit("9")).cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))


def card(m: Column, key: str, back: bool = False) -> Column:
    def of(d):
        n = F.length(d)
        right = F.floor((n - 2) / 2).cast("int")
        left = n - 2 - right
        tens = lambda k: F.pow(F.lit(10.0), k.cast("double")).cast("long")
        pair = permute(F.substring(d, F.lit(2), left).cast("long"), F.substring(d, left + 2, right).cast("long"), tens(left), tens(right), key, F.concat(F.lit("card"), F.substring(d, 1, 1), n.cast("string")), back)
        body = bind(pair, lambda p: F.concat(F.substring(d, 1, 1), F.lpad(p["l"].cast("string"), left, F.lit("0")), F.lpad(p["r"].cast("string"), right, F.lit("0"))))
        anew = bind(body, lambda b: F.concat(b, F.pmod(10 - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10)).cast("string")))
        return F.when((luhn_sum(d) % 10 == 0) & ~d.rlike("^0+$"), fill(m, anew))

    return bind(_digits(m), of)


def ssn(m: Column, key: str, back: bool = False) -> Column:
    def of(d):
        area, group, serial = (F.substring(d, i, n).cast("int") for i, n in ((1, 3), (4, 2), (6, 4)))
        index = area - F.when(area > 666, 2).otherwise(1)
        pair = permute(index, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn", back)
        area_of = lambda i: i + F.when(i >= 665, 2).otherwise(1)
        out = bind(pair, lambda p: F.concat(_pad(area_of(p["l"]), 3), _pad(F.floor(p["r"] / 9999) + 1, 2), _pad(p["r"] % 9999 + 1, 4)))
        return F.when(area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0), fill(m, out))

    return bind(_digits(m), of)


def phone(m: Column, key: str, back: bool = False) -> Column:
    def of(d):
        ten = F.substring(d, -10, 10)
        area, exchange, line = (F.substring(ten, i, n).cast("int") for i, n in ((1, 3), (4, 3), (7, 4)))
        # three sets of numbers, each permuted within itself: assignable ones, other exchanges, other areas
        kind = F.when(area < 200, 2).when(exchange < 200, 1).otherwise(0)
        start = F.when(kind == 2, 0).otherwise(200)
        first = F.when(kind == 0, 200).otherwise(0)
        exchanges = F.when(kind == 0, 800).when(kind == 1, 200).otherwise(1000)
        pair = permute(area - start, (exchange - first) * 10000 + line, F.when(kind == 2, 200).otherwise(800), exchanges * 10000, key, F.concat(F.lit("phone"), kind.cast("string")), back)
        out = bind(pair, lambda p: F.concat(F.substring(d, F.lit(1), F.length(d) - 10), _pad(p["l"] + start, 3), _pad(F.floor(p["r"] / 10000) + first, 3), _pad(p["r"] % 10000, 4)))
        return F.when((F.length(d) == 10) | d.startswith("1"), fill(m, out))

    return bind(_digits(m), of)


def ip(m: Column, key: str, back: bool = False) -> Column:
    def of(parts):
        o = [F.get(parts, k).cast("int") for k in range(4)]
        pair = permute(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip", back)
        out = bind(pair, lambda p: F.concat_ws(".", *[x.cast("string") for half in (p["l"], p["r"]) for x in (F.floor(half / 256), half % 256)]))
        return F.when((F.size(parts) == 4) & F.forall(parts, lambda x: (x.cast("int") <= 255) & ~x.rlike("^0[0-9]")), out)

    return bind(F.split(m, r"\."), of)


def date(m: Column, key: str, slash: str, back: bool = False) -> Column:
    sep = F.regexp_extract(m, "[^0-9]", 0)
    first = m.rlike("^[0-9]{4}")
    order = F.when(first, "ymd").when(sep == ".", "dmy").otherwise(slash)

    def of(p):
        year = F.when(first, F.get(p, 0)).otherwise(F.get(p, 2))
        month = F.when(order == "ymd", F.get(p, 1)).when(order == "dmy", F.get(p, 1)).otherwise(F.get(p, 0))
        day = F.when(order == "ymd", F.get(p, 2)).when(order == "dmy", F.get(p, 0)).otherwise(F.get(p, 1))
        number = F.datediff(F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-MM-dd"), F.lit("1900-01-01").cast("date"))

        def anew(n):
            pair = permute(F.floor(n / 4297), n % 4297, 17, 4297, key, "date", back)  # 17 * 4297 days from 1900 to 2099
            return bind(bind(pair, lambda q: F.date_add(F.lit("1900-01-01").cast("date"), (q["l"] * 4297 + q["r"]).cast("int"))), written)

        def written(d):
            y, mo, da = (F.date_format(d, x) for x in ("yyyy", "MM", "dd"))
            return F.when(order == "ymd", F.concat(y, sep, mo, sep, da)).when(order == "dmy", F.concat(da, sep, mo, sep, y)).otherwise(F.concat(mo, sep, da, sep, y))

        return bind(number, lambda n: F.when(n.isNotNull(), anew(n)))

    return bind(F.split(m, "[./-]"), of)


def iban(m: Column, key: str, back: bool = False) -> Column:
    def of(s):
        country, account = F.substring(s, 1, 2), F.substring(s, F.lit(5), F.length(s))

        def anew(a):
            check = _pad(98 - mod97(F.concat(a, country, F.lit("00"))), 2)
            whole = F.concat(country, check, a)
            start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
            put = lambda acc, c: F.when(c != " ", F.struct(F.concat(acc["out"], F.substring(whole, acc["k"], F.lit(1))).alias("out"), (acc["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["k"].alias("k")))
            return F.aggregate(_chars(m), start, put)["out"]

        good = F.length(s).between(15, 34) & (mod97(F.concat(account, F.substring(s, 1, 4))) == 1)
        return F.when(good, bind(permute_string(account, key, "iban", back), anew))

    return bind(F.regexp_replace(m, " ", ""), of)


def email(m: Column, key: str, back: bool = False) -> Column:
    return F.concat(permute_string(F.substring_index(m, "@", 1), key, "email", back), F.lit("@"), F.substring_index(m, "@", -1))


def replaced(m: Column, key: str, slash: str, back: bool = False) -> Column:
    """A date, SSN or IP address made anew and marked; null where it isn't valid."""
    made = {"date": date(m, key, slash, back), "ssn": ssn(m, key, back), "ip": ip(m, key, back)}
    return F.coalesce(*[F.when(m.rlike(f"^(?:{SHAPES[name]})$"), _done(name, value)) for name, value in made.items()])


def _done(kind: str, out: Column) -> Column:
    return F.concat(F.lit(OPEN + LETTERS[kind]), out, F.lit(CLOSE))


def _escaped(text: Column) -> Column:
    """Noncharacters of the text itself as marked digits 0 and 1."""
    parts = F.split(text, f"(?<=[{OPEN}{CLOSE}])|(?=[{OPEN}{CLOSE}])", -1)
    marked = F.transform(parts, lambda p: F.when(p == OPEN, F.lit(f"{OPEN}0{CLOSE}")).when(p == CLOSE, F.lit(f"{OPEN}1{CLOSE}")).otherwise(p))
    return F.when(text.rlike(f"[{OPEN}{CLOSE}]"), F.array_join(marked, "")).otherwise(text)


def _unescaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, f"{OPEN}0{CLOSE}", OPEN), f"{OPEN}1{CLOSE}", CLOSE)


def _pass(text: Column, shape: str, new) -> Column:
    """``text`` with every match of ``shape`` outside what is done replaced by new(match), or left where that is null."""
    pattern = f"{DONE}|{shape}"

    def of(t):
        made = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda m: F.when(m.startswith(OPEN), m).otherwise(F.coalesce(new(m), m)))
        return F.when(t.rlike(shape), F.array_join(F.zip_with(F.split(t, pattern, -1), made, lambda p, s: F.concat(p, F.coalesce(s, F.lit("")))), "")).otherwise(t)

    return bind(text, of)


def _in_run(run: Column, kind: str, cut: str, most: int, begins: str, whole: str, new) -> Column:
    """``run`` with its valid values marked: from the left, at each word that ``begins`` one, the longest of up to ``most``
    words that has the shape ``whole`` and for which ``new`` isn't null."""

    def of(words):
        joined = lambda i, k: F.regexp_replace(F.array_join(F.slice(words, i, k), ""), "^[ -]", "")
        tried = lambda m: F.when(m.rlike(whole), new(m))
        none = F.struct(F.lit(0).alias("k"), F.lit(None).cast("string").alias("out"))

        def longest(i):
            lengths = F.sequence(F.least(F.lit(most), F.size(words) - i + 1), F.lit(1), F.lit(-1))
            return F.aggregate(lengths, none, lambda acc, k: F.when(acc["k"] > 0, acc).otherwise(bind(bind(joined(i, k), tried), lambda out: F.struct(F.when(out.isNotNull(), k).otherwise(0).alias("k"), out.alias("out")))))

        def step(acc, i):
            word = F.get(words, i - 1)
            put = lambda b: F.struct((i + F.greatest(b["k"], F.lit(1))).alias("next"), F.concat(acc["out"], F.when(b["k"] > 0, F.concat(F.regexp_extract(word, "^[ -]?", 0), _done(kind, b["out"]))).otherwise(word)).alias("out"))
            return F.when(i < acc["next"], acc).otherwise(bind(F.when(word.rlike(begins), longest(i)).otherwise(none), put))

        return F.aggregate(F.sequence(F.lit(1), F.size(words)), F.struct(F.lit(1).alias("next"), F.lit("").alias("out")), step)["out"]

    return bind(F.split(run, cut, -1), of)


def pseudonymise(docs: DataFrame, key: str, *, slash: str = "mdy", text_col: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with its text pseudonymised and n_<kind> for every kind (replaced if they exist). ``back`` undoes it."""
    counts = [f"n_{k}" for k in KINDS]
    columns = [c for c in docs.columns if c not in counts and c != "__new"]
    rows = docs.select(*[F.col(f"`{c}`") for c in columns])
    text = F.col(f"`{text_col}`")
    cards = lambda shape: lambda m: _in_run(m, "card", "(?=[ -])", 19, "[0-9]", shape, lambda x: card(x, key, back))
    passes = [
        (SHAPES["email"], lambda m: _done("email", email(m, key, back))),
        (IBAN_RUN, lambda m: _in_run(m, "iban", "(?= )", 9, "^ ?[A-Z]{2}[0-9]{2}", f"^(?:{SHAPES['iban']})$", lambda x: iban(x, key, back))),
        (CARD_RUN, cards(PRINTED)),
        (SHAPES["phone"], lambda m: _done("phone", phone(m, key, back))),
        (REST, lambda m: replaced(m, key, slash, back)),
        (CARD_RUN, cards(f"^{SHAPES['card']}$")),
    ]
    rows = rows.withColumn("__new", F.when(text.rlike("[0-9@]"), _escaped(text)))
    for shape, new in passes:  # a projection each: in one, the lambdas nest deeper than the analyzer goes
        rows = rows.withColumn("__new", _pass(F.col("__new"), shape, new))
    plain = _unescaped(F.regexp_replace("__new", f"{OPEN}[a-z]([^{CLOSE}]*+){CLOSE}", "$1"))
    number = lambda kind: F.coalesce(F.regexp_count("__new", F.lit(OPEN + LETTERS[kind])), F.lit(0))
    return rows.select(*[F.coalesce(plain, text).alias(c) if c == text_col else F.col(f"`{c}`") for c in columns], *[number(k).alias(f"n_{k}") for k in KINDS])
