r"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

DataFrame functions only. A pattern's matches are taken with their places by
cutting the text at them: the lengths of the parts before a match and of the
earlier matches add up to its start, in code points.

The four base kinds (email, ip, card, phone) follow fixed patterns and checks
and always stay. Beyond them the method finds ``iban`` (mod-97) and ``ssn``
(a valid range, and a context word near it). Each span has a score: what its
pattern and checksum are worth, more if a context word stands near it on either
side, up to the next match of its kind.
Possessive quantifiers and the look at the preceding character give the same
matches as the plain patterns without trying a long run again from each of its
characters.

Defined cases: a null text counts as empty and gives zero counts and empty
lists; null doc_ids and repeated rows each give their own row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakewarden.llm.common import joined_spans, table, texts
from lakewarden.operators.scanning import named

NEAR = 32  # code points before and after a span in which a context word counts

# Fixed patterns of the base kinds, in the order in which they are listed.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"


@dataclass(frozen=True)
class Kind:
    name: str
    rank: int
    pattern: str
    base: bool
    worth: float       # of a match whose check passes
    lift: float        # for a context word near it
    context: str       # pattern of context words
    least: float = 0.0  # score below which a span of the method is left out


KINDS = (
    Kind("email", 0, EMAIL, True, 0.9, 0.1, r"(?i)e-?mail|mail|contact|write"),
    Kind("ip", 1, IP, True, 0.6, 0.3, r"(?i)\bip\b|address|host|server|login"),
    Kind("card", 2, CARD, True, 0.7, 0.3, r"(?i)card|visa|master|amex|credit|debit|payment"),
    Kind("phone", 3, PHONE, True, 0.7, 0.3, r"(?i)phone|tel\b|call|mobile|fax|cell"),
    Kind("iban", 4, IBAN, False, 0.8, 0.2, r"(?i)iban|account|bank|transfer", 0.5),
    Kind("ssn", 5, SSN, False, 0.4, 0.5, r"(?i)ssn|social security|tax", 0.5),
)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    places = F.split(F.reverse(number), "")
    value = lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int"))
    return F.aggregate(F.transform(F.filter(places, lambda d: d != ""), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without blanks leaves 1 when divided by 97, taken character by character."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def step(left: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (left * 10 + code - 48) % 97).otherwise((left * 100 + code - 55) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _holds(name: str, match: Column) -> Column:
    """The check that a proposed span must pass."""
    if name == "ip":
        def part_fits(part: Column) -> Column:
            bare = F.ltrim(part, F.lit("0"))
            return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= F.lit("255")))

        return F.forall(F.split(match, r"\."), part_fits)
    if name == "card":
        return F.length(digits(match)).between(14, 19) & luhn(digits(match))
    if name == "phone":
        return F.length(digits(match)).between(10, 15)
    if name == "iban":
        bare = F.replace(match, F.lit(" "), F.lit(""))
        return F.length(bare).between(15, 34) & mod97(bare)
    if name == "ssn":
        return ~match.rlike("^(000|666|9)") & ~match.rlike("-00-") & ~match.rlike("0000$")
    return F.lit(True)


SPANS = "array<struct<start:bigint,rank:int,kind:string,end:bigint,score:double>>"

# Characters without which a kind cannot occur: most texts skip most patterns.
_MUST = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}


def _found(kind: Kind, text: Column) -> Column:
    """All matches of a kind with what stands before each, or an empty array."""
    pattern = F.lit(kind.pattern)
    both = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"), F.split(text, kind.pattern, -1).alias("before")
    )
    may = F.contains(text, F.lit(_MUST[kind.name])) if kind.name in _MUST else text.rlike(kind.pattern)
    return F.when(may, both)


def _starts(steps: Column) -> Column:
    """What all earlier steps add up to, for each.

    Steps are summed in blocks of about the square root of their number, so a
    text with very many matches is not summed anew for each.
    """

    def total(parts: Column) -> Column:
        return F.aggregate(parts, F.lit(0), lambda a, x: a + x)

    def within(st: Column, size: Column) -> Column:
        def block(i: Column) -> Column:
            return F.floor(i / size).cast("int")

        sums = F.transform(F.sequence(F.lit(0), block(F.size(st))), lambda b: total(F.slice(st, b * size + 1, size)))
        before = named(sums, lambda s: F.transform(s, lambda _, b: total(F.slice(s, F.lit(1), b))))
        return named(before, lambda o: F.transform(
            st, lambda _, i: F.get(o, block(i)) + total(F.slice(st, block(i) * size + 1, i % size))))

    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(steps))).cast("int"))
    return named(steps, lambda st: named(size, lambda n: within(st, n)))


def _spans(kind: Kind, found: Column) -> Column:
    """Spans that pass their check, as structs (start, rank, kind, end, score)."""

    def placed(pairs: Column, starts: Column) -> Column:
        """Each match with its start and the text near it on both sides."""

        def one(x: Column, i: Column) -> Column:
            before, after = x["before"], F.coalesce(F.get(pairs, i + 1)["before"], F.lit(""))
            near = F.concat(F.substr(before, F.greatest(F.lit(1), F.length(before) - NEAR + 1)), F.lit("\n"), F.left(after, F.lit(NEAR)))
            return F.struct((F.get(starts, i) + F.length(before)).cast("long").alias("start"), x["match"].alias("match"), near.alias("near"))

        return F.transform(pairs, one)

    def score(x: Column) -> Column:
        return F.lit(kind.worth) + F.when(x["near"].rlike(kind.context), F.lit(kind.lift)).otherwise(F.lit(0.0))

    def span(x: Column) -> Column:
        return F.struct(
            x["start"].alias("start"), F.lit(kind.rank).alias("rank"), F.lit(kind.name).alias("kind"),
            (x["start"] + F.length(x["match"])).alias("end"), score(x).alias("score"))

    steps = F.transform(found, lambda x: F.length(x["before"]) + F.coalesce(F.length(x["match"]), F.lit(0)))
    every = named(_starts(steps), lambda starts: placed(found, starts))
    fits = F.filter(every, lambda x: x["match"].isNotNull() & _holds(kind.name, x["match"]) & (score(x) >= kind.least))
    return F.coalesce(F.transform(fits, span), F.array().cast(SPANS))


def find(docs: DataFrame) -> DataFrame:
    """doc_id and one array of spans per kind, named as the kind."""
    rows = texts(docs)
    rows = rows.select("doc_id", *[_found(k, F.col("text")).alias(k.name) for k in KINDS])
    return rows.select("doc_id", *[_spans(k, F.col(k.name)).alias(k.name) for k in KINDS])


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    base = [k.name for k in KINDS if k.base]
    every = F.concat(*[F.col(k.name) for k in KINDS])
    return found.select(
        "doc_id",
        *[F.size(n).cast("long").alias(f"n_{n}") for n in base],
        F.sha2(joined_spans(F.concat(*[F.col(n) for n in base])), 256).alias("base_sha256"),
        joined_spans(every).alias("spans"),
        F.coalesce(F.array_max(F.transform(every, lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )


QUERIES = {"op9_pii": op9_pii}
ORACLES: dict[str, str] = {}
