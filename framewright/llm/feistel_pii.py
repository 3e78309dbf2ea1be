"""Personal data replaced by format-preserving Feistel pseudonyms.

Candidates are found by pattern and validated: payment cards (Luhn), IBANs (mod 97), IPv4 octets, US
social security numbers, phone numbers (digit count), calendar dates from 1900 to 2099, and e-mail
addresses. Each validated value goes through a keyed permutation of its own format, so the pseudonym
is valid again, equal values get equal pseudonyms in every document, and different values stay different.
Candidates that fail validation stay as they are.

Cards and IBANs may stand beside other digits or capitals (an expiry date, a currency, another number), so
every stretch of a run that begins and ends at a word boundary is a candidate: for cards each of 13 to
19 digits, for IBANs the one of the length that its country fixes (any length where the country isn't
listed). Only those that are valid are split at; the rest of the run is open to all other kinds.

Everything is SQL expressions: a text is split at the candidates, the candidates are mapped one by
one, and both are joined again. No table of values is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8  # even, so that both halves end where they began
#: Candidate patterns in order of precedence.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
    "date": r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])",
    "phone": r"\+[0-9](?:[ ().-]{0,2}[0-9]){6,14}(?![0-9])|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
#: Stretches that may hold cards or IBANs, of any length.
RUNS = {"iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9 ]{11,}", "card": r"(?<![0-9])[0-9][0-9 -]{11,}[0-9]"}
#: Length of the IBANs of each country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES HN MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
LISTED = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
#: Candidates of a run, those of overlapping places included: one pattern for each length, the longest first.
WITHIN = {
    "iban": [rf"(?<![A-Za-z0-9])(?=((?:{'|'.join(rf'(?:{c.replace(" ", "|")})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}' for n, c in IBAN_LENGTHS.items())})(?![A-Za-z0-9])))",
             *[rf"(?<![A-Za-z0-9])(?!{LISTED})(?=([A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])))" for n in range(34, 14, -1)]],
    "card": [rf"(?<![0-9])(?=([0-9](?:[ -]?[0-9]){{{n - 1}}}(?![0-9])))" for n in range(19, 12, -1)],
}
EDGE = {"iban": "A-Za-z0-9", "card": "0-9"}
DAYS_A, DAYS_B = 17, 4297  # 17 x 4297 = 73,049 days from 1900-01-01 to 2099-12-31


def sql(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Permuter:
    """Builds the SQL of keyed permutations; ``key`` is the secret."""

    def __init__(self, key: str):
        self.key, self.names = sql(key), 0

    def name(self) -> str:
        self.names += 1
        return f"v{self.names}"

    def prf(self, tweak: str, *parts: str) -> str:
        return f"cast(conv(substr(sha2(concat_ws('|', {self.key}, '{tweak}', {', '.join(f'cast({p} as string)' for p in parts)}), 256), 1, 12), 16, 10) as bigint)"

    def let(self, value: str, body) -> str:
        """``body(name)`` with ``name`` bound to ``value``, which is evaluated once."""
        v = self.name()
        return f"element_at(transform(array({value}), {v} -> {body(v)}), 1)"

    def pair(self, a: str, ma: int, b: str, mb: int, tweak: str) -> str:
        """Feistel rounds over Z_ma x Z_mb; a struct of a and b."""
        s, i = self.name(), self.name()
        return (f"aggregate(sequence(1, {ROUNDS}), named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint)), ({s}, {i}) -> "
                f"if({i} % 2 = 0, named_struct('a', ({s}.a + {self.prf(tweak, i, f'{s}.b')}) % {ma}L, 'b', {s}.b), "
                f"named_struct('a', {s}.a, 'b', ({s}.b + {self.prf(tweak, i, f'{s}.a')}) % {mb}L)))")

    def shifted(self, x: str, tweak: str, i: str, other: str) -> str:
        """Every digit and letter of ``x`` moved inside its class by a keyed hash of ``other`` and its place."""
        p, c, k = self.name(), self.name(), self.name()
        wheel = lambda first, n: f"char({first} + (ascii({c}) - {first} + {k}) % {n})"
        one = f"case when {c} between '0' and '9' then {wheel(48, 10)} when {c} between 'a' and 'z' then {wheel(97, 26)} when {c} between 'A' and 'Z' then {wheel(65, 26)} else {c} end"
        moved = f"element_at(transform(array({self.prf(tweak, i, p, other)}), {k} -> element_at(transform(array(substr({x}, {p}, 1)), {c} -> {one}), 1)), 1)"
        return f"if(length({x}) = 0, '', concat_ws('', transform(sequence(1, greatest(length({x}), 1)), {p} -> {moved})))"

    def text(self, x: str, tweak: str) -> str:
        """Feistel rounds over the two halves of a string, class by class; all else stays in place."""
        s, i = self.name(), self.name()
        half = f"cast(length({x}) div 2 as int)"
        step = f"named_struct('l', {s}.r, 'r', {self.shifted(f'{s}.l', tweak, i, f'{s}.r')})"
        rounds = f"aggregate(sequence(1, {ROUNDS}), named_struct('l', substr({x}, 1, {half}), 'r', substr({x}, {half} + 1)), ({s}, {i}) -> {step})"
        return self.let(rounds, lambda v: f"concat({v}.l, {v}.r)")

    def poured(self, form: str, digits: str) -> str:
        """The digits of ``form`` replaced, in order, by ``digits``."""
        s, c = self.name(), self.name()
        return (f"aggregate(split({form}, ''), named_struct('o', '', 'n', 1), ({s}, {c}) -> if({c} between '0' and '9', "
                f"named_struct('o', concat({s}.o, substr({digits}, {s}.n, 1)), 'n', {s}.n + 1), named_struct('o', concat({s}.o, {c}), 'n', {s}.n))).o")

    def luhn(self, d: str) -> str:
        a, i = self.name(), self.name()
        x = f"cast(substr({d}, length({d}) - {i} + 1, 1) as int)"
        return f"aggregate(sequence(1, length({d})), 0, ({a}, {i}) -> {a} + if({i} % 2 = 1, {x}, 2 * {x} - if({x} > 4, 9, 0))) % 10"

    def mod97(self, x: str) -> str:
        a, c = self.name(), self.name()
        return f"aggregate(split({x}, ''), 0, ({a}, {c}) -> case when {c} = '' then {a} when {c} between '0' and '9' then ({a} * 10 + ascii({c}) - 48) % 97 else ({a} * 100 + ascii({c}) - 55) % 97 end)"

    # One method per kind: the pseudonym of m, or null where m isn't valid.

    def email(self, m: str) -> str:
        return f"concat({self.text(f'''substring_index({m}, '@', 1)''', 'email')}, '@', substring_index({m}, '@', -1))"

    def card(self, m: str) -> str:
        def body(d):
            return f"if({self.luhn(d)} = 0, {self.let(self.text(f'substr({d}, 1, length({d}) - 1)', 'card'), lambda b: self.poured(m, f'concat({b}, cast(pmod(10 - {self.luhn(f'''concat({b}, '0')''')}, 10) as string))'))}, null)"
        return self.let(f"regexp_replace({m}, '[^0-9]', '')", body)

    def iban(self, m: str) -> str:
        def body(x):
            rest = f"substr({x}, 5)"
            new = self.let(self.text(f"translate({rest}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')", "iban"), lambda d: self.poured(rest, d))
            check = lambda b: f"lpad(cast(98 - {self.mod97(f'''concat({b}, substr({x}, 1, 2), '00')''')} as string), 2, '0')"
            whole = self.let(new, lambda b: self.poured(m, f"concat({check(b)}, regexp_replace({b}, '[^0-9]', ''))"))
            return f"if({self.mod97(f'concat({rest}, substr({x}, 1, 4))')} = 1, {whole}, null)"
        return self.let(f"replace({m}, ' ', '')", body)

    def ip(self, m: str) -> str:
        o = lambda x, n: f"cast(element_at({x}, {n}) as int)"
        out = lambda r: f"concat_ws('.', cast({r}.a div 256 as string), cast({r}.a % 256 as string), cast({r}.b div 256 as string), cast({r}.b % 256 as string))"
        return self.let(f"split({m}, '[.]')", lambda x: f"if({' and '.join(f'{o(x, n)} <= 255' for n in (1, 2, 3, 4))}, {self.let(self.pair(f'{o(x, 1)} * 256 + {o(x, 2)}', 65536, f'{o(x, 3)} * 256 + {o(x, 4)}', 65536, 'ip'), out)}, null)")

    def ssn(self, m: str) -> str:
        area, group, serial = (f"cast(substr({m}, {a}, {n}) as int)" for a, n in ((1, 3), (5, 2), (8, 4)))
        index = f"({area} - if({area} > 666, 2, 1)) * 99 + {group} - 1"  # 898 areas, 99 groups

        def out(r):
            at = f"({r}.a div 99)"
            return f"concat(lpad(cast({at} + if({at} >= 665, 2, 1) as string), 3, '0'), '-', lpad(cast({r}.a % 99 + 1 as string), 2, '0'), '-', lpad(cast({r}.b + 1 as string), 4, '0'))"
        return f"if({area} between 1 and 899 and {area} != 666 and {group} > 0 and {serial} > 0, {self.let(self.pair(index, 898 * 99, f'{serial} - 1', 9999, 'ssn'), out)}, null)"

    def phone(self, m: str) -> str:
        """The last ten digits move; a country code before them stays."""
        def body(d):
            moved = self.text(f"substr({d}, greatest(length({d}) - 9, 1))", "phone")
            return self.poured(m, f"concat(substr({d}, 1, greatest(length({d}) - 10, 0)), {moved})")
        return self.let(f"regexp_replace({m}, '[^0-9]', '')", lambda d: self.let(body(d), lambda v: v))

    def date(self, m: str) -> str:
        """``.`` is day.month.year; ``/`` is month/day/year where that is a date, else day/month/year."""
        def moved(day, form):
            n = f"datediff({day}, date'1900-01-01')"
            new = self.let(self.pair(f"{n} div {DAYS_B}", DAYS_A, f"{n} % {DAYS_B}", DAYS_B, "date"), lambda r: f"date_format(date_add(date'1900-01-01', cast({r}.a * {DAYS_B} + {r}.b as int)), '{form}')")
            return f"if({day} between date'1900-01-01' and date'2099-12-31', {new}, null)"
        part = lambda y, mo, d: f"try_make_timestamp(cast(substr({m}, {y}, 4) as int), cast(substr({m}, {mo}, 2) as int), cast(substr({m}, {d}, 2) as int), 0, 0, 0)"
        day = lambda ts, form: self.let(f"cast({ts} as date)", lambda v: moved(v, form))
        return (f"case when substr({m}, 5, 1) = '-' then {day(part(1, 6, 9), 'yyyy-MM-dd')} when substr({m}, 3, 1) = '.' then {day(part(7, 4, 1), 'dd.MM.yyyy')} "
                f"else coalesce({day(part(7, 1, 4), 'MM/dd/yyyy')}, {day(part(7, 4, 1), 'dd/MM/yyyy')}) end")

    def valid(self, kind: str, m: str) -> str:
        """Whether a card or IBAN candidate passes its check digits."""
        if kind == "card":
            return self.let(f"regexp_replace({m}, '[^0-9]', '')", lambda d: f"{self.luhn(d)} = 0")
        return self.let(f"replace({m}, ' ', '')", lambda x: f"{self.mod97(f'concat(substr({x}, 5), substr({x}, 1, 4))')} = 1")

    def pattern(self, text: str) -> str:
        """The pattern of one text's candidates in order of precedence; of cards and IBANs only valid ones are in it."""
        parts = []
        for kind, p in PATTERNS.items():
            if kind not in RUNS:
                parts.append(sql(p))
                continue
            r, c = self.name(), self.name()
            each = f"concat({', '.join(f'regexp_extract_all({r}, {sql(w)}, 1)' for w in WITHIN[kind])})"
            good = f"filter(array_distinct(flatten(transform(regexp_extract_all({text}, {sql(RUNS[kind])}, 0), {r} -> {each}))), {c} -> {self.valid(kind, c)})"
            edge = EDGE[kind]
            parts.append(self.let(f"array_join({good}, '|')", lambda v: f"if({v} = '', null, concat('(?<![{edge}])(?:', {v}, ')(?![{edge}])'))"))  # noqa: B023
        return f"concat_ws('|', {', '.join(parts)})"

    def any(self, m: str) -> str:
        """(kind, pseudonym) of a candidate; (null, itself) where it isn't valid."""
        whole = "case " + " ".join(f"when {m} rlike {sql('^(?:' + p + ')$')} then {getattr(self, kind)(m)}" for kind, p in PATTERNS.items()) + " end"
        kind = "case " + " ".join(f"when {m} rlike {sql('^(?:' + p + ')$')} then '{k}'" for k, p in PATTERNS.items()) + " end"
        return self.let(whole, lambda v: f"named_struct('kind', if({v} is null, null, {kind}), 'text', coalesce({v}, {m}))")


def pseudonymise(df: DataFrame, text_col: str = "text", key: str = "demonstration key") -> DataFrame:
    """``df`` with private values of ``text_col`` replaced, and ``n_private``, the number replaced.

    ``key`` is the secret; pass your own. Whole texts are read. Null texts stay null with 0 found; empty
    texts stay empty. Repeated rows get equal results, an empty table gives no rows. An input column
    ``n_private`` is replaced. The permutation is keyed, not a one-way hash: who holds the key can undo it."""
    text = f"`{text_col}`"
    permuter = Permuter(key)
    pattern = f"if({text} rlike '[0-9@]', {permuter.pattern(text)}, null)"
    found = f"transform(regexp_extract_all({text}, __pattern, 0), m -> {permuter.any('m')})"
    between = f"split({text}, __pattern, -1)"
    glued = f"concat(element_at({between}, 1), array_join(zip_with(__found.text, slice({between}, 2, size(__found)), (a, b) -> concat(a, b)), ''))"
    count = "cast(coalesce(size(filter(__found.kind, k -> k is not null)), 0) as int)"
    return (df.withColumn("__pattern", F.expr(pattern)).withColumn("__found", F.expr(found)).withColumn("n_private", F.greatest(F.expr(count), F.lit(0)))
            .withColumn(text_col, F.when(F.col("n_private") > 0, F.expr(glued)).otherwise(F.expr(text))).drop("__found", "__pattern"))
