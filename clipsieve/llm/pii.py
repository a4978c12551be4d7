"""Personal data by patterns, checksums and context words, in DataFrame functions only.

Patterns propose spans; Luhn and mod-97 checksums and digit counts confirm them; context words shortly before
a span raise its score, and kinds that are doubtful alone need them. Patterns use possessive repeats, so
their cost is linear and long matches need no stack.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters before a span in which context words count, and what they add to the score.
CONTEXT_CHARS, CONTEXT_BONUS = 40, 0.3
#: Spans of the added kinds need this score.
LEAST_SCORE = 0.6

#: Spans are gathered in slices of so many, and plain text between them is cut from pieces of so many characters.
SLICE, PIECE_CHARS = 256, 1024

_SPAN = "struct<kind:string,start:int,end:int,score:double>"
_SPANS = f"array<{_SPAN}>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether the digits of a match pass Luhn's check."""
    figures = F.split(F.reverse(_digits(match)), "(?!^)(?!$)")
    doubled = F.transform(
        figures,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2 / 10).cast("int") + (d.cast("int") * 2) % 10
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod_97(match: Column) -> Column:
    """Whether an account number (country, two check digits, rest) leaves 1 when divided by 97."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    remainder = F.aggregate(
        F.split(turned, "(?!^)(?!$)"),
        F.lit(0),
        lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise(
            (a * 100 + F.ascii(c) - 55) % 97
        ),
    )
    return remainder == 1


def _digit_count(low: int, high: int):
    return lambda match: F.length(_digits(match)).between(low, high)


def _card(match: Column) -> Column:
    return F.when(_digit_count(16, 19)(match), luhn(match)).otherwise(False)


_OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def _octets(match: Column) -> Column:
    return match.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$".replace("0*+", "0*"))


def _always(match: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    likely: str  # a cheap test that every text with a match passes
    valid: object
    score: float
    context: str
    base: bool = True


#: Characters of the account numbers of each country.
_IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _of_country(n: int, codes: str) -> str:
    groups, rest = divmod(n - 4, 4)
    end = f" [A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{n - 4}}}|(?: [A-Z0-9]{{4}}){{{groups}}}{end})"


#: Numbers of their country's length; what does not fit is taken by groups to the last that may belong to it.
_ACCOUNT = (
    "|".join(_of_country(*x) for x in _IBAN.items())
    + "|[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){2,7}+(?: [A-Z0-9]{1,3})?+)"
)

#: The base kinds in the order of the digest, then the added ones. A run of characters that a pattern may
#: begin with is entered at its start only, or where the last match ended.
KINDS = (
    Kind(
        "email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", _always, 0.7, "mail|contact|write to",
    ),
    Kind(
        "ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]", _octets, 0.6, r"\bip\b|address|host|server|login",
    ),
    Kind(
        "card", r"[0-9](?:[\x20-]?+[0-9])++",
        r"[0-9](?:[\x20-]?+[0-9]){15}", _card, 0.6, r"card|credit|visa|payment",
    ),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9]", _digit_count(8, 15), 0.6, r"phone|tel|call|mobile|fax",
    ),
    Kind(
        "iban",
        rf"(?<![A-Za-z0-9])(?:{_ACCOUNT})(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}[ A-Z0-9]", mod_97, 0.7, r"iban|account|konto|bank", False,
    ),
    Kind(
        "ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        r"[0-9]-[0-9]{2}-[0-9]", _always, 0.4, r"\bssn\b|social security", False,
    ),
)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _in_slices(values: Column, start: Column, step, item: str) -> Column:
    """Fold ``step`` over an array and return all that it puts ``out``, in order.

    ``step`` takes the state and a value and returns the next state, with the values to add in ``out``. These
    are gathered by slices of the array and put together once, as each addition copies what it adds to.
    """
    none = F.array().cast(f"array<{item}>")

    def add(s: Column, value: Column) -> Column:
        return F.struct(step(s["last"], value).alias("last"), F.concat(s["out"], s["last"]["out"]).alias("out"))

    def end(s: Column) -> Column:
        return F.struct(
            s["last"].withField("out", none).alias("last"), F.concat(s["out"], s["last"]["out"]).alias("out")
        )

    def of_slice(s: Column, own: Column) -> Column:
        begin = F.struct(s["own"]["last"].alias("last"), none.alias("out"))
        slices = F.concat(s["slices"], F.array(s["own"]["out"]))
        return F.struct(F.aggregate(own, begin, add, end).alias("own"), slices.alias("slices"))

    def of_all(v: Column) -> Column:
        places = F.sequence(F.lit(0), (F.size(v) / SLICE).cast("int"))
        slices = F.transform(places, lambda i: F.slice(v, i * SLICE + 1, SLICE))
        begin = F.struct(
            F.struct(start.withField("out", none).alias("last"), none.alias("out")).alias("own"),
            F.array().cast(f"array<array<{item}>>").alias("slices"),
        )
        return F.aggregate(
            slices, begin, of_slice, lambda s: F.flatten(F.concat(s["slices"], F.array(s["own"]["out"])))
        )

    return _let(values, of_all)


def _spans(text: Column, kind: Kind) -> Column:
    """The confirmed spans of a kind, in order. Splitting by the pattern gives what is between the matches,
    so lengths give their places; the last characters passed are carried along as context."""
    between = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["between"])
        end = start + F.length(pair["match"])

        def at_match(before: Column) -> Column:
            bonus = F.when(F.lower(before).rlike(kind.context), CONTEXT_BONUS).otherwise(0.0)
            score = F.round(F.lit(kind.score) + bonus, 2)
            span = F.array(
                F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), score.alias("score"))
            ).cast(_SPANS)
            if not kind.base:
                span = F.filter(span, lambda s: s["score"] >= LEAST_SCORE)
            found = F.when(kind.valid(pair["match"]), span).otherwise(F.array().cast(_SPANS))
            return F.struct(end.alias("at"), _tail(before, pair["match"]).alias("before"), found.alias("out"))

        return _let(_tail(state["before"], pair["between"]), at_match)

    # One more piece than matches: the last pair has no match and is left out.
    pairs = F.filter(
        F.arrays_zip(between.alias("between"), matches.alias("match")), lambda p: p["match"].isNotNull()
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("before"))
    likely = text.contains("@") if kind.likely == "@" else text.rlike(kind.likely)
    return F.when(likely, _in_slices(pairs, start, step, _SPAN)).otherwise(F.array().cast(_SPANS))


def _tail(before: Column, further: Column) -> Column:
    """The last characters, as many as count as context."""
    return F.right(F.concat(before, further), F.lit(CONTEXT_CHARS))


def find(docs: DataFrame, *kept: str) -> DataFrame:
    """``doc_id``, the columns ``kept`` and one array of spans (kind, start, end, score; code points, end
    exclusive) for each kind, named like it, for every row of ``doc_id, text``.

    Null and empty text have no span. Repeated rows and null ids are kept; an empty table gives no row.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", *kept, *[_spans(text, k).alias(k.name) for k in KINDS])


def _written(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text and with their scores."""
    base = F.concat(*[F.col(k.name) for k in KINDS if k.base])
    everything = F.concat(*[F.col(k.name) for k in KINDS])
    return find(docs).select(
        "doc_id",
        *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in KINDS if k.base],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(everything).alias("spans"),
        F.transform(everything, lambda s: s["score"]).alias("scores"),
    )


def mask(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, every span in ``text`` replaced by its kind in brackets.

    Spans that overlap are replaced together, by the kind of the first. Null text stays null.
    """
    text = F.col("row.text")
    rows = docs.select(F.struct("*").alias("row"))
    spans = F.concat(*[_spans(F.coalesce(text, F.lit("")), k) for k in KINDS])
    found = rows.select("row", spans.alias("found"))
    ordered = F.array_sort(
        F.transform(
            "found",
            lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind")),
        )
    )

    def masked(pieces: Column) -> Column:
        def plain(start: Column, end: Column) -> Column:
            first = (start / PIECE_CHARS).cast("int")
            own = F.slice(pieces, first + 1, (end / PIECE_CHARS).cast("int") - first + 1)
            return F.substr(F.array_join(own, ""), start % PIECE_CHARS + 1, end - start)

        def step(state: Column, span: Column) -> Column:
            label = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
            out = F.when(span["start"] >= state["at"], F.array(plain(state["at"], span["start"]), label))
            at = F.greatest(state["at"], -span["back"])
            return F.struct(at.alias("at"), F.coalesce(out, F.array().cast("array<string>")).alias("out"))

        rest = F.array_max(F.transform("spans", lambda s: -s["back"]))
        start = F.struct(F.lit(0).alias("at"))
        return F.concat(F.array_join(_in_slices(F.col("spans"), start, step, "string"), ""), plain(rest, F.length(text)))

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0))
    result = found.select("row", ordered.alias("spans")).select(
        "row", F.when(F.size("spans") > 0, _let(cut, masked)).otherwise(text).alias("masked")
    )
    return result.select(*[F.col("masked" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns])
