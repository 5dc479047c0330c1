r"""Personal data: patterns propose spans, checksums confirm them, words nearby move a score.

Everything is DataFrame functions on one row at a time: no Python on the
executors, no shuffle, no collect. Every kind goes through the same steps:

1. its pattern cuts the text (``split``) and yields its leftmost
   non-overlapping matches (``regexp_extract_all``); the patterns are possessive
   and tied to the start of a run, so each reads a text once whatever it holds;
2. offsets are running sums of the lengths of gaps and matches, in blocks, so
   many matches in a long text do not cost their square;
3. a check confirms a match: parts up to 255, Luhn, a number of digits,
   ISO 7064 mod 97-10, the ranges in use;
4. the score starts at the kind's ``prior`` and moves by ``lift`` for a
   supporting and by ``-lift`` for an opposing word among the ``CONTEXT``
   characters between a match and its neighbours of the kind.

``BASE`` kinds are found by pattern and check alone and stay whatever their
score; ``ADDED`` kinds stay from ``threshold`` on.

Null and empty texts have no spans; a null id and repeated rows are returned
like any other row; an empty table gives an empty table. Input columns named
like an appended one (``spans``) are replaced. Offsets count code points, ends
are exclusive. Matches of different kinds may overlap and are all listed.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters on either side in which context words count.
CONTEXT = 48
#: Running sums are taken in blocks of so many matches.
BLOCK = 128

SPAN = "array<struct<kind:string,start:bigint,stop:bigint,score:double,base:boolean>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _small_parts(match: Column, before: Column, after: Column) -> Column:
    """Each of four decimal parts is at most 255, whatever its leading zeros."""
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


def luhn(digits: Column, most: int = 19) -> Column:
    """Whether a string of up to ``most`` digits ends in its Luhn check digit."""
    width = most + most % 2
    padded = F.lpad(digits, width, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")
    places = [F.substring(doubled if k % 2 else padded, k, 1).cast("int") for k in range(1, width + 1)]
    return sum(places[1:], places[0]) % 10 == 0


def _card(match: Column, before: Column, after: Column) -> Column:
    digits = _digits(match)
    return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)


def _phone(match: Column, before: Column, after: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def mod97(account: Column) -> Column:
    """Remainder by 97 of an account number in capitals and digits, its first four characters moved to the end."""
    turned = F.split(F.concat(F.substr(account, F.lit(5)), F.substring(account, 1, 4)), "")

    def step(acc: Column, c: Column) -> Column:
        value = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return F.when(c == "", acc).otherwise((acc * F.when(value > 9, 100).otherwise(10) + value) % 97)

    return F.aggregate(turned, F.lit(0), step)


def _alone(before: Column, after: Column) -> Column:
    """No letter or digit touches the match."""
    return ~before.rlike("[A-Za-z0-9]$") & ~after.rlike("^[A-Za-z0-9]")


def _iban(match: Column, before: Column, after: Column) -> Column:
    account = F.translate(match, " ", "")
    return F.when(_alone(before, after) & F.length(account).between(15, 34), mod97(account) == 1).otherwise(False)


def _ssn(match: Column, before: Column, after: Column) -> Column:
    used = ~match.rlike("^(?:000|666|9)|-00-|0000$")
    return used & _alone(before, after) & ~before.rlike("[0-9]-$") & ~after.rlike("^-[0-9]")


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``pattern`` is what is looked for; ``tied`` the same for Java's matcher,
    without restarts inside a run and without recursion; ``hint`` a cheap test
    that every text with a match passes.
    """

    name: str
    pattern: str
    tied: str
    hint: Callable[[Column], Column]
    check: Callable[[Column, Column, Column], Column] | None
    prior: float
    lift: float
    support: str
    oppose: str = "example|sample|test"


BASE = [
    Kind(
        "email",
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda text: F.contains(text, F.lit("@")),
        None,
        0.9, 0.1, "mail|contact|write|correo|courriel",
    ),
    Kind(
        "ip",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda text: text.rlike(r"[0-9]\.[0-9]"),
        _small_parts,
        0.6, 0.3, "ip|address|host|server|login", "version|release|section|chapter",
    ),
    Kind(
        "card",
        r"[0-9]([\x20-]?[0-9])+",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
        _card,
        0.7, 0.2, "card|visa|credit|debit|tarjeta|carte", "order|invoice|serial|isbn",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda text: F.contains(text, F.lit("+")),
        _phone,
        0.7, 0.2, "phone|call|tel|mobile|fax|whatsapp", "equals|plus|sum",
    ),
]

ADDED = [
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}",
        r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}",
        lambda text: text.rlike(r"[A-Z]{2}[0-9]{2}"),
        _iban,
        0.8, 0.2, "iban|account|bank|konto|cuenta|compte",
    ),
    Kind(
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        lambda text: text.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
        _ssn,
        0.4, 0.3, "ssn|social security|taxpayer", "order|invoice|serial|part",
    ),
]


def _sums(sizes: Column) -> Column:
    """Running sums of a short array of longs."""
    none = F.array().cast("array<bigint>")
    last = lambda acc: F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0))
    return F.aggregate(sizes, none, lambda acc, x: F.concat(acc, F.array(x + last(acc))))


def _cut(text: Column, kind: Kind, number: int) -> Column:
    """The matches of a kind and the gaps around them."""
    none = F.array().cast("array<string>")
    hinted = kind.hint(text)
    return F.struct(
        F.lit(number).alias("kind"),
        F.when(hinted, F.split(text, kind.tied, -1)).otherwise(none).alias("gaps"),
        F.when(hinted, F.regexp_extract_all(text, F.lit(kind.tied), F.lit(0))).otherwise(none).alias("found"),
    )


def _proposed(text: Column, kinds: list[Kind]) -> Column:
    """All matches ``(kind, match, stop, before, after)``.

    Each step is a ``transform`` over the kinds, so what it made is there, whole, for the next one.
    """
    cut = F.filter(F.array(*[_cut(text, kind, i) for i, kind in enumerate(kinds)]), lambda s: F.size(s["found"]) > 0)
    keep = lambda s: [s[c].alias(c) for c in ("kind", "gaps", "found")]
    sized = F.transform(cut, lambda s: F.struct(*keep(s), F.zip_with(
        s["found"], F.slice(s["gaps"], 1, F.size(s["found"])),
        lambda m, gap: (F.char_length(m) + F.char_length(gap)).cast("bigint")).alias("sizes")))
    blocks = F.transform(sized, lambda s: F.struct(*keep(s), F.transform(
        F.sequence(F.lit(0), F.floor((F.size(s["sizes"]) - 1) / F.lit(BLOCK)).cast("int")),
        lambda b: _sums(F.slice(s["sizes"], b * BLOCK + 1, F.lit(BLOCK)))).alias("blocks")))
    based = F.transform(blocks, lambda s: F.struct(*keep(s), s["blocks"].alias("blocks"), F.concat(
        F.array(F.lit(0).cast("bigint")),
        _sums(F.transform(s["blocks"], lambda b: F.get(b, F.size(b) - 1)))).alias("bases")))
    placed = F.transform(based, lambda s: F.struct(*keep(s), F.flatten(F.zip_with(
        s["blocks"], F.slice(s["bases"], 1, F.size(s["blocks"])),
        lambda block, base: F.transform(block, lambda x: x + base))).alias("stops")))
    return F.flatten(F.transform(placed, lambda s: F.transform(s["found"], lambda m, i: F.struct(
        s["kind"].alias("kind"),
        m.alias("match"),
        F.get(s["stops"], i).alias("stop"),
        F.right(F.get(s["gaps"], i), F.lit(CONTEXT)).alias("before"),
        F.left(F.get(s["gaps"], i + 1), F.lit(CONTEXT)).alias("after"),
    ))))


def _by_kind(number: Column, values: list) -> Column:
    """The value that belongs to a kind's number."""
    chosen = F.when(number == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        chosen = chosen.when(number == i, value)
    return chosen


def _spans(text: Column, base: list[Kind], added: list[Kind], threshold: float) -> Column:
    kinds = base + added
    confirmed = F.filter(_proposed(text, kinds), lambda p: _by_kind(
        p["kind"], [k.check(p["match"], p["before"], p["after"]) if k.check else F.lit(True) for k in kinds]))

    def scored(p: Column) -> Column:
        near = F.lower(F.concat_ws(" ", p["before"], p["after"]))
        moved = [
            F.lit(k.prior) + F.when(near.rlike(k.support), k.lift).otherwise(0.0)
            - F.when(near.rlike(k.oppose), k.lift).otherwise(0.0)
            for k in kinds
        ]
        return F.struct(
            _by_kind(p["kind"], [F.lit(k.name) for k in kinds]).alias("kind"),
            (p["stop"] - F.char_length(p["match"])).alias("start"),
            p["stop"].alias("stop"),
            F.round(F.least(F.greatest(_by_kind(p["kind"], moved), F.lit(0.0)), F.lit(1.0)), 6).alias("score"),
            (p["kind"] < len(base)).alias("base"),
        )

    spans = F.filter(F.transform(confirmed, scored), lambda s: s["base"] | (s["score"] >= F.lit(threshold)))
    return spans.cast(SPAN)


def find(docs: DataFrame, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``spans`` (kind, start, stop, score, base), in order of kind, then start."""
    kept = [c for c in docs.columns if c.lower() != "spans"]
    if text_col not in kept:
        raise ValueError(f"no text column {text_col!r} apart from the appended column")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(*[f"`{c}`" for c in kept], _spans(text, BASE, ADDED, threshold).alias("spans"))


def _listed(spans: Column) -> Column:
    span = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, span), ",")


def digest(found: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, a digest of their spans and the list of all spans."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: Kind) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind.name)).cast("long").alias(f"n_{kind.name}")

    counts = [count(kind) for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )

