"""Secret scan by patterns and sliding-window entropy, DataFrame functions only (operator 5).

Pattern kinds (``assign``, ``access``, ``hex``) find leftmost non-overlapping
matches. The entropy kinds add spans: candidate strings are the maximal runs
of a character class of at least one window's length; a window of fixed width
slides over each, its character counts are updated by the entering and the
leaving character, and with them ``S = sum c log2 c``, from which Shannon's
entropy is ``log2 W - S / W``. ``S`` is kept in fixed-point integers, so no
rounding adds up and reruns agree bit by bit. Where windows reach the class's
threshold the span from the first to the last such window is found, unless
the allow-list knows the whole string (one of names only if, besides, no window
reaches a higher threshold); what no pattern span covers of it is reported,
in as many parts as pattern spans leave.

Positions are code points, end exclusive. They come from marking the matches
in the text and adding up the lengths of the pieces; the two marker
characters are first replaced, one for one, by a third control character that
no pattern matches, so positions are those of the text as given.

Defined cases: null and empty texts have no spans. A string is scanned whole,
however long. Equal rows have equal spans. Other columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed pattern values of the base kinds, in their order.
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
# a run of 20 / 24 or more: a shorter run can't hold a longer match, so the
# lower bound may stand in the pattern
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
N_BASE = 3
SCALE = 1_000_000_000
_OPEN, _CLOSE, _PLAIN = "\x01", "\x02", "\x03"


@dataclass(frozen=True)
class EntropyClass:
    """A character class: its runs, the window's width, the least entropy in bits."""

    kind: str
    chars: str
    window: int
    bits: float
    #: From these bits of any window on, a string of names counts as random.
    name_bits: float

    @property
    def pattern(self) -> str:
        return f"[{self.chars}]{{{self.window},}}"

    def _limit(self, bits: float) -> int:
        return math.floor(self.window * (math.log2(self.window) - bits) * SCALE)

    @property
    def limit(self) -> int:
        """Largest scaled ``sum c log2 c`` of a window that reaches ``bits``."""
        return self._limit(self.bits)

    @property
    def name_limit(self) -> int:
        return self._limit(self.name_bits)


CLASSES = (EntropyClass("entropy_hex", "0-9A-Fa-f", 16, 2.9, 3.2), EntropyClass("entropy_base64", "A-Za-z0-9+/_=-", 20, 3.75, 4.0))

#: What random letters have and names seldom do: a small letter between capitals, six consonants in a row.
_RANDOM = r"[A-Z][a-z][A-Z]|[B-DF-HJ-NP-TV-XZb-df-hj-np-tv-xz]{6}"
_WORD = r"example|sample|dummy|placeholder|changeme|test|your|my|key|token|secret|api|access|private|password|x{6,}+|[+/_=-]"
#: Possessive throughout: a string is read in one way only.
_AROUND = rf"(?:{_WORD}){{0,20}}+[a-z+/_=-]{{0,8}}+"
#: Strings of names, allowed below ``name_bits``.
NAMES = (
    rf"^(?!.*(?:{_RANDOM}))[^0-9]*$",                                                       # no digit: words, paths
    rf"^(?!.*(?:{_RANDOM}|[0-9][^0-9]|[0-9]{{5}}|[+]|[+/_=-]{{2}}))[A-Za-z][A-Za-z0-9/_=-]*$",  # names joined by signs, with a short number at the end
)
#: Candidate strings that are no secrets; every pattern is about the whole string.
ALLOW = (
    *NAMES,
    r"^[0-9+/_=-]*$",                                       # no letter: numbers, dates, rulers
    rf"(?i)^{_AROUND}(?:0?1234567890?+{_AROUND}){{1,50}}$",  # a counting row between placeholder words or a few letters
    r"^(.{1,4})\1+.{0,3}$",                                 # a short piece repeated
)


def _matches(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, s>>`` of the leftmost non-overlapping matches."""
    kind = "array<struct<start:int,end:int,s:string>>"
    parts = F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}"), f"[{_OPEN}{_CLOSE}]")
    walked = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.array().cast(kind).alias("out")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p)).alias("at"), (~a["inside"]).alias("inside"),
            F.when(a["inside"], F.array_append(a["out"], F.struct(
                a["at"].alias("start"), (a["at"] + F.length(p)).alias("end"), p.alias("s")))).otherwise(a["out"]).alias("out")),
        lambda a: a["out"])
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(kind))


def _hot(s: Column, c: EntropyClass) -> Column:
    """``struct<first, last, least>``: first hot window's begin and last one's end in ``s`` (first is null if none), and the
    least ``sum c log2 c`` of a window."""
    g = F.array(*[F.lit(round(n * math.log2(n) * SCALE) if n else 0).cast("long") for n in range(c.window + 1)])
    codes = F.transform(F.split(s, ""), lambda ch: F.ascii(ch))

    def step(a: Column, i: Column) -> Column:
        enter = F.get(a["codes"], i)
        leave = F.when(i >= c.window, F.get(a["codes"], i - c.window))
        same = F.coalesce(enter == leave, F.lit(False))
        n_in, n_out = F.get(a["counts"], enter), F.get(a["counts"], leave)
        total = F.when(same, a["total"]).otherwise(
            a["total"] + F.get(g, n_in + 1) - F.get(g, n_in)
            + F.coalesce(F.get(g, n_out - 1) - F.get(g, n_out), F.lit(0).cast("long")))
        counts = F.when(same, a["counts"]).otherwise(F.transform(a["counts"], lambda n, k: n + F.when(k == enter, 1).when(
            k == leave, -1).otherwise(0)))
        hot = (i >= c.window - 1) & (total <= c.limit)
        return F.struct(a["codes"].alias("codes"), counts.alias("counts"), total.alias("total"),
                        F.coalesce(a["first"], F.when(hot, i - (c.window - 1))).alias("first"),
                        F.when(hot, i + 1).otherwise(a["last"]).alias("last"),
                        F.when(hot, F.least(a["least"], total)).otherwise(a["least"]).alias("least"))

    null = F.lit(None).cast("int")
    start = F.struct(codes.alias("codes"), F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0).cast("long").alias("total"),
                     null.alias("first"), null.alias("last"), F.lit(None).cast("long").alias("least"))
    return F.aggregate(F.sequence(F.lit(0), F.length(s) - 1), start, step, lambda a: F.struct(a["first"], a["last"], a["least"]))


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))


def _entropy_spans(text: Column, c: EntropyClass) -> Column:
    runs = F.filter(_matches(text, c.pattern), lambda m: ~_allowed(m["s"], ALLOW[len(NAMES):]))
    scored = F.transform(runs, lambda m: F.struct(
        m["start"].alias("start"), _allowed(m["s"], NAMES).alias("names"), _hot(m["s"], c).alias("hot")))
    return F.transform(F.filter(scored, lambda x: x["hot"]["first"].isNotNull() & (~x["names"] | (x["hot"]["least"] <= c.name_limit))),
                       lambda x: _span(c.kind, x["start"] + x["hot"]["first"], x["start"] + x["hot"]["last"]))


def _allowed(s: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | s.rlike(p)
    return out


def _simple(text: Column, kind: str, pattern: str) -> Column:
    return F.transform(_matches(text, pattern), lambda m: _span(kind, m["start"], m["end"]))


def _uncovered(spans: Column, base: Column) -> Column:
    """The parts of ``spans`` that no span of ``base`` (sorted) covers."""
    def parts(m: Column) -> Column:
        def part(start: Column, end: Column) -> Column:
            return F.struct(start.alias("start"), m["kind"].alias("kind"), end.alias("end"))

        return F.aggregate(
            F.filter(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])),
            F.struct(m["start"].alias("at"), F.filter(F.array(m), lambda _: F.lit(False)).alias("out")),
            lambda a, b: F.struct(
                F.greatest(a["at"], b["end"]).alias("at"),
                F.when(a["at"] < b["start"], F.array_append(a["out"], part(a["at"], b["start"]))).otherwise(a["out"]).alias("out")),
            lambda a: F.when(a["at"] < m["end"], F.array_append(a["out"], part(a["at"], m["end"]))).otherwise(a["out"]))

    return F.flatten(F.transform(spans, parts))


def scan(docs: DataFrame, text_col: str = "text", classes: tuple[EntropyClass, ...] = CLASSES) -> DataFrame:
    """``docs`` with ``secret_spans array<struct<start, kind, end>>`` by start, then kind."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), _OPEN + _CLOSE, _PLAIN + _PLAIN)
    df = docs.withColumn("__t", text)
    t = F.col("__t")
    assign = F.transform(F.filter(_matches(t, ASSIGN), lambda m: F.length(F.regexp_extract(m["s"], ASSIGN, 1)) >= ASSIGN_LEAST),
                         lambda m: _span("assign", m["start"], m["end"]))
    df = df.withColumn("__base", F.array_sort(F.concat(assign, _simple(t, "access", ACCESS), _simple(t, "hex", HEX))))
    df = df.withColumn("__more", F.concat(*[_entropy_spans(t, c) for c in classes]))
    fresh = _uncovered(F.col("__more"), F.col("__base"))
    return df.withColumn("secret_spans", F.array_sort(F.concat("__base", fresh))).drop("__t", "__base", "__more")


def span_string(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """Adds counts of the base kinds, ``base_sha256`` and ``spans``."""
    s = F.col("secret_spans")
    base = F.filter(s, lambda x: x["kind"] < N_BASE)

    def count_of(kind: int) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long")

    count = {f"n_{name}": count_of(kind) for kind, name in enumerate(KINDS[:N_BASE])}
    return scanned.withColumns(count | {"base_sha256": F.sha2(span_string(base), 256), "spans": span_string(s)})


def redact(scanned: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replaces every reported span (overlapping ones together) by ``mark``; clean texts stay as they are."""
    text = F.col(text_col)
    walked = F.aggregate(
        "secret_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] < a["at"], a["out"]).otherwise(
                F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return scanned.withColumn(text_col, F.when(F.size("secret_spans") > 0, walked).otherwise(text))
