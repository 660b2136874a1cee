"""Personal data become pseudonyms of the same format, by a keyed Feistel permutation.

Values that a validity check accepts (card numbers by the Luhn sum, IPv4 addresses by range, calendar dates by existence,
phone numbers, mail addresses with names of up to 64 characters, and secrets by form) are permuted within their format: equal values get equal pseudonyms
in all documents, different values different ones, and who holds the key can turn them back. A card number keeps its
length and a valid check digit, a date stays a date (of the 400 years from 1700), an address an address.

Dates may stand before a time. Phones are numbers with a country code in common groupings or without separators, and ten
digits as (ddd) ddd-dddd, ddd-ddd-dddd or ddd.ddd.dddd. Card numbers are 13 to 19 digits with single spaces or hyphens
anywhere. Where further digit groups stand beside one, the leftmost and fewest whole groups with a valid sum are taken; there,
if new digits by chance make other groups valid, the way back may fail.

Formats are strings of digits, small and large letters, or numbers below a fixed product a * b; both are halves of a
Feistel network whose round function is SHA-256 of key, kind, round and the other half.

Everything is SQL expressions in one projection; texts without a digit, @ or the words before a secret are passed through untouched. Defined results:
null and empty texts stay as they are; values that fail their check stay; a document's other columns are kept;
repeated rows change alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spare

ROUNDS = 8
#: Stands before a changed card number until it is counted: no run of digit groups holds it.
MARK = "#"
#: Kinds of value and their patterns, tried in this order at each place of a text. Dates are ISO dates.
KINDS = {
    "secret": r"""(?i:\btoken = "|\bpassword=|\bsecret=|\bapi_key=)[0-9A-Za-z]{8,}|\bAKIA[0-9A-Z]{16}\b""",
    # names of up to 64 characters, as mail has them: a long run of letters without an @ is passed over in one go
    "mail": r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._+-]{0,63}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone": r"(?<!\w)\+\d{1,3} \(\d{3}\) \d{3}-\d{4}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w|[.-]\d)"
    r"|(?<![\w+])\+\d{1,3}[ .-](?:\d{2}[ .-]\d{4}[ .-]\d{4}|\d{4}[ .-]\d{6}|\d(?:[ .-]\d{2}){4})(?!\w|[.-]\d)"
    r"|(?<![\w+])\+\d{8,15}(?!\w|[.-]\d)"
    r"|(?<![\w)])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\w|[.-]\d)"
    r"|(?<![\w.+-])\d{3}[.-]\d{3}[.-]\d{4}(?!\w|[ .-]\d)",
    "date": r"(?<![\w.-])(?:1[7-9]|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?:(?![\w-])|(?=[Tt]\d\d))",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
}
#: Groups of digits with one space or hyphen between them, 13 digits in all at least, up to what is of another kind. The cards in them are found by their sums.
KINDS["card"] = rf"(?<!\w)(?=\d(?:[ -]?\d){{12}})\d++(?!\w)(?:[ -](?!{KINDS['mail']}|{KINDS['phone']}|{KINDS['date']}|{KINDS['ip']})\d++(?!\w))*+"
_ANY = "|".join(KINDS.values())
#: What a text with a value of any kind holds; secrets may be letters alone.
SOME = r"""[0-9@]|(?i:token = "|password=|secret=|api_key=)|AKIA"""
#: Days from 1700-01-01 that dates are permuted in: 400 years, 189 * 773.
_DAYS = (189, 773)


def _lit(s: str) -> str:
    return "r'" + s.replace("'", "\\x27") + "'"


def _stream(key: str, kind: str, r: str, half: str) -> str:
    return f"sha2(concat('{key}', '|{kind}|', cast({r} AS string), '|', {half}), 256)"


def _shift(half: str, other: str, key: str, kind: str, r: str, sign: str) -> str:
    """Each letter or digit of a half moved on within its class by the round's bytes; the stream starts anew every 32 characters."""
    return f"""array_join(transform(sequence(1, length({half})), i -> transform(array(substr({half}, i, 1)), c -> transform(array(
        conv(substr(sha2(concat('{key}', '|{kind}|', cast({r} AS string), '|', cast(i AS string), '|', {other}), 256), 1, 8), 16, 10)), b ->
        CASE WHEN c >= '0' AND c <= '9' THEN chr(48 + cast(pmod(ascii(c) - 48 {sign} cast(b AS bigint), 10) AS int))
             WHEN c >= 'a' AND c <= 'z' THEN chr(97 + cast(pmod(ascii(c) - 97 {sign} cast(b AS bigint), 26) AS int))
             WHEN c >= 'A' AND c <= 'Z' THEN chr(65 + cast(pmod(ascii(c) - 65 {sign} cast(b AS bigint), 26) AS int))
             ELSE c END)[0])[0]), '')"""


def text_permuted(s: str, key: str, kind: str, back: bool = False) -> str:
    """SQL: the string s with its letters and digits permuted, their classes and all else kept. Two characters at least change together; one alone shifts by the key."""
    rounds = f"sequence({ROUNDS - 1}, 0)" if back else f"sequence(0, {ROUNDS - 1})"
    left = _shift("x.a", "x.b", key, kind, "r", "-" if back else "+")
    right = _shift("x.b", "x.a", key, kind, "r", "-" if back else "+")
    # even rounds move the left half by the right one, odd rounds the right half by the left one
    split = "cast(length(t) / 2 AS int)"
    return f"""transform(array({s}), t -> aggregate({rounds}, named_struct('a', coalesce(substr(t, 1, {split}), ''), 'b', coalesce(substr(t, {split} + 1), '')),
        (x, r) -> named_struct('a', if(r % 2 = 0 AND x.a <> '', {left}, x.a), 'b', if(r % 2 = 1, {right}, x.b)), x -> concat(x.a, x.b)))[0]"""


def number_permuted(n: str, a: int, b: int, key: str, kind: str, back: bool = False) -> str:
    """SQL: the whole number n (0 <= n < a * b) permuted."""
    sign = "-" if back else "+"
    rounds = f"sequence({ROUNDS - 1}, 0)" if back else f"sequence(0, {ROUNDS - 1})"

    def f(half: str) -> str:
        return f"cast(conv(substr({_stream(key, kind, 'r', f'cast({half} AS string)')}, 1, 12), 16, 10) AS bigint)"

    return f"""aggregate({rounds}, named_struct('p', cast({n} AS bigint) DIV {b}, 'q', cast({n} AS bigint) % {b}),
        (x, r) -> named_struct('p', if(r % 2 = 0, pmod(x.p {sign} {f('x.q')}, {a}), x.p), 'q', if(r % 2 = 1, pmod(x.q {sign} {f('x.p')}, {b}), x.q)), x -> x.p * {b} + x.q)"""


def luhn_sum(digits: str) -> str:
    """SQL: the Luhn sum of a string of digits, the last one undoubled."""
    return f"""aggregate(sequence(1, length({digits})), 0, (s, i) -> s + transform(array(cast(substr({digits}, i, 1) AS int) * if((length({digits}) - i) % 2 = 1, 2, 1)), d -> if(d > 9, d - 9, d))[0])"""


def _refilled(shape: str, digits: str) -> str:
    """SQL: the digits put, one by one, in the places of the digits of shape."""
    return f"""aggregate(sequence(1, length({shape})), named_struct('s', '', 'k', 1), (x, i) -> if(substr({shape}, i, 1) BETWEEN '0' AND '9',
        named_struct('s', concat(x.s, substr({digits}, x.k, 1)), 'k', x.k + 1), named_struct('s', concat(x.s, substr({shape}, i, 1)), 'k', x.k)), x -> x.s)"""


def pseudonym(v: str, key: str, back: bool = False) -> str:
    """SQL: the pseudonym of a value v that one of KINDS has matched; v itself if its check fails. MARK stands before each card number that has changed."""
    mail = f"concat({text_permuted(f'''substring_index({v}, '@', 1)''', key, 'mail', back)}, '@', substring_index({v}, '@', -1))"
    # secrets: all after the word and sign in front of them
    head = f"regexp_extract({v}, '^(AKIA|[A-Za-z_]+ ?= ?\"?)', 1)"
    secret = f"concat({head}, {text_permuted(f'substr({v}, length({head}) + 1)', key, 'secret', back)})"
    # the last ten digits, or all but the first where there are fewer
    number = f"regexp_replace({v}, '[^0-9]', '')"
    kept = f"cast(greatest(length({number}) - 10, if({v} LIKE '+%', 1, 0)) AS int)"
    national = f"transform(array(substr({number}, {kept} + 1)), m -> {text_permuted('m', key, 'phone', back)})[0]"
    phone = f"transform(array(concat(substr({number}, 1, {kept}), {national})), d -> {_refilled(v, 'd')})[0]"
    day = f"datediff(try_cast({v} AS date), DATE'1700-01-01')"
    date = f"if(try_cast({v} AS date) IS NULL, {v}, date_format(date_add(DATE'1700-01-01', cast({number_permuted(day, *_DAYS, key, 'date', back)} AS int)), 'yyyy-MM-dd'))"
    octets = f"aggregate(split({v}, '[.]'), 0L, (s, o) -> s * 256 + cast(o AS bigint))"
    ip = f"transform(array({number_permuted(octets, 65536, 65536, key, 'ip', back)}), n -> concat_ws('.', cast(n DIV 16777216 AS string), cast((n DIV 65536) % 256 AS string), cast((n DIV 256) % 256 AS string), cast(n % 256 AS string)))[0]"
    # of a card number all but the check digit is permuted; the check digit follows
    body = text_permuted("substr(n, 1, length(n) - 1)", key, "card", back)
    check = f"cast(pmod(10 - {luhn_sum('''concat(p, '0')''')} % 10, 10) AS string)"
    one = f"""transform(transform(transform(array(regexp_replace(u, '[^0-9]', '')), n -> {body}), p -> concat(p, {check})), d -> {_refilled('u', 'd')})[0]"""
    # from the left, the fewest whole groups with the length and the sum of a card are one
    valid = f"transform(array(array_join(transform(slice(g, f, j - f + 1), w -> regexp_replace(w, '[^0-9]', '')), '')), n -> if(length(n) BETWEEN 13 AND 19, {luhn_sum('n')} % 10 = 0, false))[0]"
    ends = f"filter(sequence(f, least(f + 18, size(g))), j -> {valid})"
    card = f"""transform(array(regexp_extract_all({v}, '[0-9]+[ -]?', 0)), g -> aggregate(sequence(1, size(g)), named_struct('s', '', 'k', 1),
        (z, f) -> if(f < z.k, z, transform(array(get({ends}, 0)), e -> if(e IS NULL, named_struct('s', concat(z.s, g[f - 1]), 'k', f + 1),
            named_struct('s', concat(z.s, '{MARK}', transform(array(array_join(slice(g, f, e - f + 1), '')), u -> {one})[0]), 'k', e + 1)))[0]), z -> z.s))[0]"""
    return f"""CASE WHEN {v} RLIKE {_lit('^(?:' + KINDS['secret'] + ')$')} THEN {secret} WHEN instr({v}, '@') > 0 THEN {mail}
        WHEN {v} RLIKE '^(?:[+(].*|[0-9]{{3}}[.-][0-9]{{3}}[.-][0-9]{{4}})$' THEN {phone} WHEN {v} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' THEN {date}
        WHEN instr({v}, '.') > 0 THEN {ip} ELSE {card} END"""


def pseudonymised(docs: DataFrame, key: str, text: str = "text", back: bool = False) -> DataFrame:
    """docs with the text's values replaced, and n_values, how many have changed. With back, pseudonyms turn into the values again."""
    key = key.replace("'", "''").replace("\\", "\\\\")
    t, any_ = f"`{text}`", _lit(_ANY)
    found = f"regexp_extract_all({t}, {any_}, 0)"
    apart = f"split({t}, {any_}, -1)"
    # texts without a value need no look at each character's surroundings
    some = f"{t} RLIKE {_lit(SOME)}"
    values, made, bare = spare([*docs.columns, "v", "n", "s"], "_v", "_m", "_n")
    out = docs.withColumn(values, F.expr(f"CASE WHEN {some} THEN {found} END"))
    out = out.withColumn(made, F.expr(f"transform({values}, v -> {pseudonym('v', key, back)})"))
    run = f"v RLIKE '^[0-9]' AND instr(n, '{MARK}') > 0"
    out = out.withColumn(bare, F.expr(f"zip_with({values}, {made}, (v, n) -> if({run}, replace(n, '{MARK}', ''), n))"))
    whole = f"CASE WHEN size({values}) > 0 THEN array_join(zip_with({apart}, {bare}, (s, v) -> concat(s, coalesce(v, ''))), '') ELSE {t} END"
    # one run of digit groups may hold several cards
    changed = f"coalesce(aggregate(zip_with({values}, {made}, (v, n) -> if({run}, length(n) - length(replace(n, '{MARK}', '')), if(v <> n, 1, 0))), 0, (a, x) -> a + x), 0)"
    return out.withColumn(text, F.expr(whole)).withColumn("n_values", F.expr(f"cast(greatest({changed}, 0) AS bigint)")).drop(values, made, bare)
