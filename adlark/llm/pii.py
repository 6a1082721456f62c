"""Format-preserving pseudonyms for personal numbers, dates and addresses, in SQL expressions only (operator 6).

What is found and validated is permuted within its format by a keyed Feistel network, so equal values get equal
pseudonyms in every document, different ones different pseudonyms, and the pseudonym passes the same validation:

    card number   13 to 19 digits with a valid Luhn digit: all but the first and the Luhn digit are permuted
    phone         North American, with separators: area and exchange stay in 200 to 999; others are permuted among themselves
    SSN           area 001 to 899 but 666, group 01 to 99, serial 0001 to 9999
    IPv4          four octets of at most 255
    IBAN          valid modulo 97: letters and digits of the account are permuted in their classes, check digits follow
    date          y-m-d, or d-m-y (m-d-y if only that is valid), of 1800 to 2199, in its separators and widths
    e-mail        letters and digits of the local part are permuted in their classes; the domain stays

Numbers use an unbalanced Feistel network over Z_a x Z_b with a * b values: halves take turns at adding a keyed hash of
the other one, so it is a permutation of exactly the valid values and needs no retries. Strings use the same with a shift
of each character within its class.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}(?![A-Za-z0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
YMD = r"(?<![0-9./-])[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}(?![0-9]|[-/.][0-9])"
DMY = r"(?<![0-9./-])[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4}(?![0-9]|[-/.][0-9])"
PHONE = r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])(?:[0-9]{4}([ -])[0-9]{4}\3[0-9]{4}\3[0-9]{1,7}|[0-9]{13,19})(?![0-9])"
PATTERN = "|".join((EMAIL, IBAN, IPV4, YMD, DMY, PHONE, SSN, CARD))
#: Any text with one of these has two digits in a row or an @, or digits around a separator.
HINT = r"[0-9]{2}|@|[0-9][./-][0-9]"


def _sql(pattern: str) -> str:
    return "r'" + pattern.replace("'", "") + "'"


def _let(name: str, value: str, body: str) -> str:
    """Body with a name bound to a value; inside a lambda SQL has no other way to use a value twice."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


class Cipher:
    """SQL expressions of the permutations under a key."""

    def __init__(self, key: str, rounds: int = ROUNDS):
        if not key:
            raise ValueError("pseudonyms need a key")
        # plans and event logs show a derived key, not the caller's
        self.key, self.rounds = hashlib.sha256(b"pseudonyms:" + key.encode()).hexdigest(), rounds

    def _hash(self, kind: str, other: str, turn: str = "i") -> str:
        return f"sha2(concat('{self.key}:{kind}:', {turn}, ':', {other}), 256)"

    def number(self, x: str, a: int, b: int, kind: str) -> str:
        """The image of bigint x among the numbers below a * b."""
        add = lambda other: f"cast(conv(substring({self._hash(kind, other)}, 1, 14), 16, 10) as bigint)"
        step = f"if(i % 2 = 1, named_struct('l', (s.l + {add('s.r')}) % {a}L, 'r', s.r), named_struct('l', s.l, 'r', (s.r + {add('s.l')}) % {b}L))"
        fold = f"aggregate(sequence(1, {self.rounds}), named_struct('l', ({x}) div {b}L, 'r', ({x}) % {b}L), (s, i) -> {step})"
        return _let("f", fold, f"f.l * {b}L + f.r")

    def text(self, x: str, kind: str) -> str:
        """The image of a string: each character stays a digit, a small or a capital letter of A to Z, or itself."""
        by = "cast(conv(substring(h, (j % 30) * 2 + 1, 4), 16, 10) as int)"
        char = f"""case when c between '0' and '9' then chr(48 + (ascii(c) - 48 + {by}) % 10) when c between 'a' and 'z' then chr(97 + (ascii(c) - 97 + {by}) % 26)
                   when c between 'A' and 'Z' then chr(65 + (ascii(c) - 65 + {by}) % 26) else c end"""
        shift = lambda t, other: _let("h", self._hash(kind, other), f"array_join(transform(split({t}, ''), (c, j) -> {char}), '')")
        step = f"if(i % 2 = 1, named_struct('l', {shift('s.l', 's.r')}, 'r', s.r), named_struct('l', s.l, 'r', {shift('s.r', 's.l')}))"
        half = f"(length({x}) div 2)"
        fold = f"aggregate(sequence(1, {self.rounds}), named_struct('l', substring({x}, 1, {half}), 'r', substring({x}, {half} + 1)), (s, i) -> {step})"
        return _let("f", fold, "concat(f.l, f.r)")


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    """The check digit that makes digits valid when it is appended."""
    double = "if((length(d) - j) % 2 = 1, if(int(c) > 4, int(c) * 2 - 9, int(c) * 2), int(c))"
    return _let("d", digits, f"cast((10 - aggregate(transform(split(d, ''), (c, j) -> {double}), 0, (a, v) -> a + v) % 10) % 10 as string)")


def _refill(shape: str, digits: str) -> str:
    """digits in the places of the digits of a string."""
    return _let("w", digits, f"aggregate(split({shape}, ''), named_struct('o', '', 'n', 1), (a, c) -> if(c between '0' and '9', named_struct('o', concat(a.o, substring(w, a.n, 1)), 'n', a.n + 1), named_struct('o', concat(a.o, c), 'n', a.n))).o")


def _mod97(x: str) -> str:
    """An IBAN's account, country and check digits modulo 97."""
    return f"aggregate(split(concat(substring({x}, 5), substring({x}, 1, 4)), ''), 0, (a, c) -> if(c between '0' and '9', (a * 10 + ascii(c) - 48) % 97, (a * 100 + ascii(c) - 55) % 97))"


def pseudonym(m: str, key: str) -> str:
    """SQL of what takes the place of a match of PATTERN; null if the match isn't valid."""
    z = Cipher(key)
    email = _let("p", f"instr({m}, '@')", f"concat({z.text(f'substring({m}, 1, p - 1)', 'mail')}, substring({m}, p))")
    octets = f"transform(split({m}, '[.]'), o -> cast(o as bigint))"
    whole = "aggregate(q, 0L, (a, o) -> a * 256 + o)"
    ip = _let("q", octets, f"if(exists(q, o -> o > 255), null, {_let('v', z.number(whole, 1 << 16, 1 << 16, 'ip'), 'concat_ws(\'.\', v div 16777216, v div 65536 % 256, v div 256 % 256, v % 256)')})")
    account = _let("u", f"concat(substring({m}, 1, 2), '00', {z.text(f'substring({m}, 5)', 'iban')})", f"concat(substring(u, 1, 2), lpad(cast(98 - {_mod97('u')} as string), 2, '0'), substring(u, 5))")
    iban = f"if({_mod97(m)} = 1, {account}, null)"
    image = z.number("datediff(d, date'1800-01-01')", 189, 773, "date")  # 400 years have 189 * 773 days
    fit = lambda part, like: f"if(length({like}) = 1, cast({part}(e) as string), lpad(cast({part}(e) as string), length({like}), '0'))"

    def date(parse: str, year: int, month: int, day: int) -> str:
        show = {year: "lpad(cast(year(e) as string), 4, '0')", month: fit("month", f"n[{month}]"), day: fit("day", f"n[{day}]")}
        build = f"concat_ws(regexp_extract({m}, '[-/.]', 0), {', '.join(show[k] for k in range(3))})"
        return f"if(d between date'1800-01-01' and date'2199-12-31', {_let('e', f'date_add(date\'1800-01-01\', int({image}))', build)}, null)" if parse == "" else _let("d", parse, date("", year, month, day))

    made = lambda y, mo, d: f"try_cast(concat(n[{y}], '-', lpad(n[{mo}], 2, '0'), '-', lpad(n[{d}], 2, '0')) as date)"
    cut = f"split({m}, '[-/.]')"
    ymd = _let("n", cut, date(made(0, 1, 2), 0, 1, 2))
    dmy = _let("n", cut, f"if({made(2, 1, 0)} is not null, {date(made(2, 1, 0), 2, 1, 0)}, {date(made(2, 0, 1), 2, 0, 1)})")
    ten = f"right({_digits(m)}, 10)"
    line = "((int(substring(g, 1, 3)) - 200) * 800L + int(substring(g, 4, 3)) - 200) * 10000L + int(substring(g, 7))"
    again = "concat(cast(200 + v div 8000000 as string), cast(200 + v div 10000 % 800 as string), lpad(cast(v % 10000 as string), 4, '0'))"
    # area below 200: 200 * 1000 pairs of area and exchange; then exchange below 200: 800 * 200 pairs
    pair = "if(int(substring(g, 1, 3)) < 200, int(substring(g, 1, 6)), 200000 + (int(substring(g, 1, 3)) - 200) * 200 + int(substring(g, 4, 3)))"
    odd = "concat(lpad(cast(if(v div 10000 < 200000, v div 10000, (200 + (v div 10000 - 200000) div 200) * 1000 + (v div 10000 - 200000) % 200) as string), 6, '0'), lpad(cast(v % 10000 as string), 4, '0'))"
    plain, other = _let("v", z.number(line, 80000, 80000, "phone"), again), _let("v", z.number(f"({pair}) * 10000L + int(substring(g, 7))", 60000, 60000, "phone0"), odd)
    new_ten = _let("g", ten, f"if(substring(g, 1, 1) >= '2' and substring(g, 4, 1) >= '2', {plain}, {other})")
    phone = _refill(m, f"concat(left({_digits(m)}, length({_digits(m)}) - 10), {new_ten})")
    area = "(int(substring(g, 1, 3)) - if(int(substring(g, 1, 3)) > 666, 2, 1))"
    social = f"({area} * 99L + int(substring(g, 4, 2)) - 1) * 9999L + int(substring(g, 6)) - 1"
    out = "_a + if(_a < 665, 1, 2)".replace("_a", "(v div 989901)")
    ssn_new = f"concat_ws('-', lpad(cast({out} as string), 3, '0'), lpad(cast(v div 9999 % 99 + 1 as string), 2, '0'), lpad(cast(v % 9999 + 1 as string), 4, '0'))"
    right = "int(substring(g, 1, 3)) between 1 and 899 and substring(g, 1, 3) != '666' and substring(g, 4, 2) != '00' and substring(g, 6) != '0000'"
    ssn = _let("g", _digits(m), f"if({right}, {_let('v', z.number(social, 898 * 99, 9999, 'ssn'), ssn_new)}, null)")
    body = f"concat(left(g, 1), {z.text('substring(g, 2, length(g) - 2)', 'card')})"
    card = _let("g", _digits(m), f"if({_luhn('left(g, length(g) - 1)')} = right(g, 1) and g rlike '[1-9]', {_refill(m, _let('y', body, f'concat(y, {_luhn("y")})'))}, null)")
    return f"""case when contains({m}, '@') then {email} when {m} rlike '^[A-Z]' then {iban} when {m} rlike '^([0-9]+[.]){{3}}[0-9]+$' then {ip}
      when {m} rlike '^[0-9]{{4}}[-/.][0-9]{{1,2}}[-/.][0-9]{{1,2}}$' then {ymd} when {m} rlike '^[0-9]{{1,2}}[-/.][0-9]{{1,2}}[-/.][0-9]{{4}}$' then {dmy}
      when {m} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then {ssn} when {m} rlike '^([0-9]{{13,19}}|[0-9]{{4}}([ -])[0-9]{{4}}\\\\2.*)$' then {card} else {phone} end"""


def found(text: Column | str) -> Column:
    """Array of what PATTERN finds in a text."""
    return F.regexp_extract_all(text, F.lit(PATTERN), 0)


def pseudonymise(docs: DataFrame, key: str, column: str = "text", count: str | None = "n_replaced") -> DataFrame:
    """All columns of a table, with validated values of `column` replaced, and their number (long) as `count`, if that is given.

    A null text stays null, an empty one empty; invalid look-alikes stay. Repeated rows stay and agree. A column n_chars
    follows the text. A column of the input named as `count` gives way. Names that SQL has to quote are allowed.
    """
    rest = [c for c in docs.columns if c not in (column, count)]
    cols = {c: docs[f"`{c}`"] for c in docs.columns}
    text = cols[column].cast("string")
    hit = F.when(text.rlike(HINT), found(text)).otherwise(F.array().cast("array<string>"))
    one = docs.select(*(cols[c].alias(f"c{k}") for k, c in enumerate(rest)), text.alias("_text"), hit.alias("_m"))
    new = F.expr(f"transform(_m, x -> {pseudonym('x', key)})")
    two = one.withColumn("_new", F.when(F.size("_m") > 0, new).otherwise(F.array().cast("array<string>")))
    parts = F.split("_text", PATTERN, -1)
    joined = F.array_join(F.transform(parts, lambda p, k: F.concat(p, F.coalesce(F.get("_new", k), F.get("_m", k), F.lit("")))), "")
    three = two.withColumn("_out", F.when(F.size("_m") > 0, joined).otherwise(F.col("_text")))
    changed = F.size(F.filter("_new", lambda v: v.isNotNull())).cast("long")
    out = []
    for c in docs.columns:
        if c == column:
            out.append(F.col("_out").alias(c))
        elif c == "n_chars":
            out.append(F.when(F.coalesce(changed, F.lit(0)) > 0, F.length("_out").cast("long")).otherwise(F.col(f"c{rest.index(c)}").cast("long")).alias(c))
        elif c != count:
            out.append(F.col(f"c{rest.index(c)}").alias(c))
    if count:
        out.append(F.when(F.col("_text").isNull(), 0).otherwise(changed).cast("long").alias(count))
    return three.select(*out)
