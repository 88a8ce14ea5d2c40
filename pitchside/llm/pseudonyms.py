"""Format-preserving pseudonyms for personal numbers, dates and addresses.

What a pattern finds is validated (check digit, calendar, ranges) and then permuted by a keyed
Feistel network within its own format: a card number becomes another card number of that length, a
date another date. Under one key equal values get equal pseudonyms in all documents and different
values different ones, and ``with_originals`` leads back with the key.

All of it is SQL over the row: the text is split at the finds, each find is replaced, and the pieces
are joined again. Nothing is shuffled. The functions below return SQL text. The key is read by a
subquery from a table of one row, so that no plan shows it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from pitchside.llm.common import text_or_empty

c = F.col

ROUNDS = 8

# --- patterns ---------------------------------------------------------------------------------

#: No digit, and no digit behind a point or comma, stands before a number. Where none can begin, the
#: first class says so before anything else is tried.
BEFORE = r"(?=[0-9+(])(?<![0-9])(?<![0-9][.,])"
AFTER = r"(?![0-9])(?![.,][0-9])"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]+\.)+\p{L}{2,}"

#: Numbers by kind, in the order in which they are tried at a place.
NUMBERS = {
    "ip": rf"{OCTET}(?:\.{OCTET}){{3}}{AFTER}",
    "date": rf"[0-9]{{4}}([-/.])[0-9]{{1,2}}\1[0-9]{{1,2}}{AFTER}",
    "day_first": rf"[0-9]{{1,2}}([-/.])[0-9]{{1,2}}\2[0-9]{{4}}{AFTER}",
    "social": rf"(?<![-+])[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?!-){AFTER}",
    "phone": (
        rf"(?:\+[0-9]{{1,3}}[ .-]?)(?:\([0-9]{{2,4}}\)|[0-9]{{2,4}})"
        rf"(?:[ .-]?[0-9]{{2,4}}){{2,3}}{AFTER}"
        rf"|\([0-9]{{3}}\) ?[0-9]{{3}}-[0-9]{{4}}{AFTER}"
        rf"|(?<!-)[0-9]{{3}}([-.])[0-9]{{3}}\3[0-9]{{4}}(?!-){AFTER}"
    ),
    "card": (
        rf"[0-9]{{4}}([ -])[0-9]{{4}}\4[0-9]{{4}}\4[0-9]{{4}}{AFTER}"
        rf"|[0-9]{{4}}([ -])[0-9]{{6}}\5[0-9]{{5}}{AFTER}"
        rf"|[0-9]{{13,19}}{AFTER}"
    ),
}
FIND = BEFORE + "(?:" + "|".join(NUMBERS.values()) + ")|" + EMAIL
#: Without one of these a text holds nothing to find.
SIGNS = "[0-9@]"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, name: str, body: str) -> str:
    """``body``, in which ``name`` stands for ``value``, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


# --- Feistel networks -------------------------------------------------------------------------


@dataclass(frozen=True)
class Key:
    """The column that holds the key, and whether the networks run backwards."""

    column: str = "_key"
    back: bool = False

    @property
    def steps(self) -> str:
        return f"sequence({ROUNDS}, 1)" if self.back else f"sequence(1, {ROUNDS})"

    @property
    def sign(self) -> str:
        return "-" if self.back else "+"


def _stream(key: Key, kind: str, step: str, other: str) -> str:
    """Sixty-four keyed hexadecimal digits that depend on the other half."""
    return f"sha2(concat_ws('|', {key.column}, {kind}, cast({step} as string), {other}), 256)"


def _pair_half(own: str, other: str, size: str, key: Key, kind: str, step: str) -> str:
    digits = _stream(key, kind, step, f"cast({other} as string)")
    drawn = f"cast(conv(substr({digits}, 1, 12), 16, 10) as bigint)"
    return f"pmod({own} {key.sign} {drawn}, {size})"


def pair(high: str, low: str, m: int, n: int, key: Key, kind: str) -> str:
    """A keyed permutation of the pairs below (m, n); a struct of ``a`` and ``b``."""
    one = _pair_half("s.a", "s.b", f"{m}L", key, quoted(kind), "k")
    two = _pair_half("s.b", "s.a", f"{n}L", key, quoted(kind), "k")
    start = f"named_struct('a', cast({high} as bigint), 'b', cast({low} as bigint))"
    return (
        f"aggregate({key.steps}, {start}, (s, k) -> if(k % 2 = 1,"
        f" named_struct('a', {one}, 'b', s.b), named_struct('a', s.a, 'b', {two})))"
    )


def _letters_half(own: str, other: str, key: Key, kind: str, step: str) -> str:
    """The letters and digits of one half, each moved within its own kind."""
    drawn = "cast(conv(substr(h, 1 + 4 * (i % 16), 4), 16, 10) as int) + i div 16"
    moved = (
        f"case when x between '0' and '9' then char(48 + pmod(ascii(x) - 48 {key.sign} v, 10))"
        f" when x between 'a' and 'z' then char(97 + pmod(ascii(x) - 97 {key.sign} v, 26))"
        f" when x between 'A' and 'Z' then char(65 + pmod(ascii(x) - 65 {key.sign} v, 26)) else x end"
    )
    each = f"transform(split({own}, ''), (x, i) -> {let(drawn, 'v', moved)})"
    return let(_stream(key, kind, step, other), "h", f"array_join({each}, '')")


def letters(text: str, key: Key, kind: str) -> str:
    """A keyed permutation of the texts whose places hold the same kinds of characters."""
    start = (
        f"named_struct('a', substr({text}, 1, length({text}) div 2),"
        f" 'b', substr({text}, length({text}) div 2 + 1))"
    )
    one = _letters_half("s.a", "s.b", key, quoted(kind), "k")
    two = _letters_half("s.b", "s.a", key, quoted(kind), "k")
    rounds = (
        f"aggregate({key.steps}, {start}, (s, k) -> if(k % 2 = 1,"
        f" named_struct('a', {one}, 'b', s.b), named_struct('a', s.a, 'b', {two})),"
        " s -> concat(s.a, s.b))"
    )
    return rounds


# --- kinds ------------------------------------------------------------------------------------


def _digits(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '')"


def _refilled(form: str, digits: str) -> str:
    """``form`` with its digits replaced in turn by those of ``digits``."""
    at = f"length({_digits(f'substr({form}, 1, j + 1)')})"
    return (
        f"array_join(transform(split({form}, ''), (y, j) -> if(y between '0' and '9',"
        f" substr({digits}, {at}, 1), y)), '')"
    )


def luhn_sum(digits: str, doubled: int) -> str:
    """Sum of the digits, each second one doubled; ``doubled`` is 0 if the last digit is."""
    twice = "2 * cast(z as int) - if(z > '4', 9, 0)"
    return (
        f"aggregate(transform(split({digits}, ''), (z, p) -> if((length({digits}) - 1 - p) % 2 ="
        f" {doubled}, {twice}, cast(z as int))), 0, (t, z) -> t + z)"
    )


def _card(m: str, key: Key) -> str:
    """All but the first digit and the check digit are permuted, and that is made anew."""
    body = letters("substr(d, 2, length(d) - 2)", key, "card")
    with_check = let(
        f"concat(substr(d, 1, 1), {body})",
        "e",
        f"concat(e, cast((10 - {luhn_sum('e', 0)} % 10) % 10 as string))",
    )
    valid = f"{luhn_sum('d', 1)} % 10 = 0"
    return let(_digits(m), "d", f"if({valid}, {_refilled(m, with_check)}, {m})")


#: Country codes of one and of two digits; all others have three.
COUNTRY_CODES = (
    "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
)


def _phone(m: str, key: Key) -> str:
    """All digits after the country code are permuted, written together or apart."""
    code = f"regexp_extract({m}, '^[+]({COUNTRY_CODES}|[0-9]{{3}})', 0)"
    rest = let(
        f"substr({m}, length(f) + 1)",
        "g",
        "concat(f, " + let(letters(_digits("g"), key, "phone"), "q", _refilled("g", "q")) + ")",
    )
    return let(code, "f", f"if(length({_digits(m)}) between 8 and 15, {rest}, {m})")


def _ip(m: str, key: Key) -> str:
    parts = f"split({m}, '[.]')"
    turned = let(
        pair("cast(o[0] as int) * 256 + cast(o[1] as int)",
             "cast(o[2] as int) * 256 + cast(o[3] as int)", 65_536, 65_536, key, "ip"),
        "w",
        "concat_ws('.', w.a div 256, w.a % 256, w.b div 256, w.b % 256)",
    )
    return let(parts, "o", turned)


#: The dates from FIRST_DAY on, as DAYS[0] * DAYS[1]: two hundred years.
FIRST_DAY, DAYS = "1900-01-01", (17, 4_297)


def _date(m: str, key: Key, places: tuple[int, int, int]) -> str:
    """Places of year, month and day. A date of no calendar or beyond the range stays."""
    year, month, day = (f"o[{i}]" for i in places)
    iso = f"concat_ws('-', {year}, lpad({month}, 2, '0'), lpad({day}, 2, '0'))"
    read = f"try_to_date({iso}, 'yyyy-MM-dd')"
    number = f"datediff(t, date'{FIRST_DAY}')"
    count = DAYS[0] * DAYS[1]
    drawn = pair(f"{number} div {DAYS[1]}", f"{number} % {DAYS[1]}", *DAYS, key, "date")
    moved = let(drawn, "w", f"date_add(date'{FIRST_DAY}', cast(w.a * {DAYS[1]} + w.b as int))")
    # A field with a leading zero, or of two digits, keeps two; else it is as short as can be.
    padded = f"(length({month}) = 2 and length({day}) = 2)"
    fields = {
        places[0]: "date_format(u, 'yyyy')",
        places[1]: f"if({padded}, date_format(u, 'MM'), cast(month(u) as string))",
        places[2]: f"if({padded}, date_format(u, 'dd'), cast(day(u) as string))",
    }
    ordered = ", ".join(fields[i] for i in range(3))
    written = f"concat_ws(regexp_extract({m}, '[-/.]', 0), {ordered})"
    valid = f"t is not null and {number} between 0 and {count - 1}"
    inner = let(read, "t", f"if({valid}, {let(moved, 'u', written)}, {m})")
    return let(f"split({m}, '[-/.]')", "o", inner)


def _social(m: str, key: Key) -> str:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area = "(cast(o[0] as int) - if(o[0] > '666', 2, 1))"
    valid = (
        "o[0] between '001' and '899' and o[0] <> '666' and o[1] <> '00' and o[2] <> '0000'"
    )
    drawn = pair(f"{area} * 99 + cast(o[1] as int) - 1", "cast(o[2] as int) - 1", 898 * 99, 9_999,
                 key, "social")
    written = (
        "concat_ws('-', lpad(cast(w.a div 99 + if(w.a div 99 >= 665, 2, 1) as string), 3, '0'),"
        " lpad(cast(w.a % 99 + 1 as string), 2, '0'), lpad(cast(w.b + 1 as string), 4, '0'))"
    )
    return let(f"split({m}, '-')", "o", f"if({valid}, {let(drawn, 'w', written)}, {m})")


def _email(m: str, key: Key) -> str:
    """The letters and digits before the sign are permuted; the host stays."""
    return (
        f"concat({letters(f'substring_index({m}, {quoted('@')}, 1)', key, 'email')}, '@',"
        f" substring_index({m}, '@', -1))"
    )


def pseudonym(m: str, key: Key) -> str:
    """The pseudonym of one find, or the find itself where it isn't valid."""
    kinds = [
        (f"{m} like '%@%'", _email(m, key)),
        (f"{m} rlike '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$'", _ip(m, key)),
        (f"{m} rlike '^[0-9]{{4}}[-/.][0-9]{{1,2}}[-/.][0-9]{{1,2}}$'", _date(m, key, (0, 1, 2))),
        (f"{m} rlike '^[0-9]{{1,2}}[-/.][0-9]{{1,2}}[-/.][0-9]{{4}}$'", _date(m, key, (2, 1, 0))),
        (f"{m} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$'", _social(m, key)),
        (f"{m} rlike '^[+(]' or {m} rlike '^[0-9]{{3}}[-.][0-9]{{3}}[-.]'", _phone(m, key)),
    ]
    return "case " + " ".join(f"when {w} then {t}" for w, t in kinds) + f" else {_card(m, key)} end"


def _keys(docs: DataFrame, key: str | DataFrame) -> DataFrame:
    """The table of one row that holds the key."""
    if isinstance(key, str):
        return docs.sparkSession.createDataFrame([(key,)], "key string")
    return key


def _replaced(docs: DataFrame, key: str | DataFrame, text: str, back: bool) -> DataFrame:
    """``docs`` with the text's finds replaced, and ``_found`` and ``_put``."""
    out = (
        docs.withColumn("_text", text_or_empty(text))
        .withColumn("_key", _keys(docs, key).scalar())
        .withColumn(
            "_found",
            F.expr(
                f"if(_text rlike {quoted(SIGNS)}, regexp_extract_all(_text, {quoted(FIND)}, 0),"
                " cast(array() as array<string>))"
            ),
        )
        .withColumn(
            "_between",
            F.when(F.size("_found") > 0, F.split("_text", FIND, -1)).otherwise(F.array("_text")),
        )
        .withColumn("_put", F.expr(f"transform(_found, m -> {pseudonym('m', Key(back=back))})"))
    )
    joined = (
        "if(size(_found) = 0, _text, concat(array_join(zip_with(slice(_between, 1, size(_found)),"
        " _put, (b, r) -> concat(b, r)), ''), element_at(_between, -1)))"
    )
    out = out.withColumn("_joined", F.expr(joined))
    return out.withColumn(text, F.when(c(text).isNotNull(), c("_joined")))


SCRATCH = ("_text", "_key", "_found", "_between", "_put", "_joined")


def with_pseudonyms(docs: DataFrame, key: str | DataFrame, *, text: str = "text") -> DataFrame:
    """Replaces the text column, and adds ``n_found`` and ``n_replaced``.

    Found are e-mail addresses, IPv4 addresses, dates (year first, or day first; 1900 to 2099),
    social security numbers, phone numbers and card numbers; replaced are those that are valid. Dates
    with the month first stay where they are none with the day first. A null text stays null with
    nothing found, and what isn't found stays as it is, byte by byte. Rows stand alone, so repeated
    rows get one answer. ``key`` is the key itself or a table whose one row and column hold it, such as
    a secret that is read where the job runs. Columns called ``n_found`` and ``n_replaced`` are
    replaced, and the others pass through, but for names beginning with ``_``.
    """
    changed = "cast(size(filter(zip_with(_found, _put, (m, r) -> m <> r), x -> x)) as bigint)"
    out = _replaced(docs, key, text, False).withColumns(
        {"n_found": F.size("_found").cast("long"), "n_replaced": F.expr(changed)}
    )
    return out.drop(*SCRATCH)


def with_originals(docs: DataFrame, key: str | DataFrame, *, text: str = "text") -> DataFrame:
    """Replaces the pseudonyms of ``with_pseudonyms`` by what they stand for."""
    return _replaced(docs, key, text, True).drop(*SCRATCH)
