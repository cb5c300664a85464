r"""Secret scan: fixed patterns and sliding-window entropy, as DataFrame expressions.

Fixed patterns find assignments, access keys and long hex strings.  Beside them,
candidate strings of each character class are scanned with a sliding window: the
window's character counts and the sum of c * log2(c) over them are updated for
the character that enters and the one that leaves, which gives the Shannon
entropy log2(W) - sum / W of every window.  The span of a candidate runs from its
first to its last window at or above the class's threshold.  Random strings of a
smaller alphabet have less entropy in a window, so runs of digits and letters of
one case (base32, base36) are candidates of their own with a threshold from their
alphabet's size.  Candidates on the
allow list (identifiers, slugs, numbers, placeholders) are left out, as are spans
inside one that a fixed pattern has already found.

Spans count code points; the end is exclusive.  Positions come from the lengths
of a pattern's matches and of the text between them.

Each row is handled alone, so nothing is shuffled and no group can be hot.

Defined cases: null text is empty and has no spans; texts of any length are
scanned whole; spans of one start are ordered by kind as listed in ``KINDS``;
repeated rows get equal results; an empty table gives an empty result; all input
columns are kept as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import OWN

# The patterns of the base kinds, least length of what they find.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

#: Character classes of the entropy scan: kind, alphabet, pattern of a candidate, least entropy of a window.
WINDOW = 20


def least_entropy(size: int, deviations: float) -> float:
    """Mean entropy of a window of random characters from an alphabet of ``size``, less some standard deviations."""
    def weight(c: int) -> float:
        return c * math.log2(c) if c else 0.0

    def chance(c: int, d: int, of: int) -> float:
        """That one character occurs c times and, with ``of`` 2, another one d times."""
        rest = WINDOW - c - d
        return math.comb(WINDOW, c) * math.comb(WINDOW - c, d) * (1 - of / size) ** rest / size ** (c + d)

    mean = sum(chance(c, 0, 1) * weight(c) for c in range(WINDOW + 1))
    square = sum(chance(c, 0, 1) * weight(c) ** 2 for c in range(WINDOW + 1))
    both = sum(chance(c, d, 2) * weight(c) * weight(d) for c in range(WINDOW + 1) for d in range(WINDOW + 1 - c))
    variance = size * (square - mean ** 2) + size * (size - 1) * (both - mean ** 2)
    return math.log2(WINDOW) - (size * mean + deviations * math.sqrt(variance)) / WINDOW


def one_case(letters: str) -> str:
    """Letters of one case and digits between other characters than letters and digits; all of them hex digits is entropy_hex's."""
    hex_only = r"(?![0-9A-Fa-f]++(?![A-Za-z0-9]))"
    return rf"(?<![A-Za-z0-9]){hex_only}[{letters}0-9]{{{WINDOW},}}+(?![A-Za-z0-9])"


#: Base32 (32 characters) and base36 are of one case; the smaller alphabet sets the threshold of both.
ONE_CASE_LEAST = round(least_entropy(32, 2.5), 2)
CLASSES = (
    ("entropy_hex", "0123456789abcdefABCDEF", rf"[0-9A-Fa-f]{{{WINDOW},}}", 3.15),
    ("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}", 3.85),
    ("entropy_lower", "abcdefghijklmnopqrstuvwxyz0123456789", one_case("a-z"), ONE_CASE_LEAST),
    ("entropy_upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", one_case("A-Z"), ONE_CASE_LEAST),
)
KINDS = ("assign", "access", "hex", *[c[0] for c in CLASSES])

#: Candidates that match one of these are never reported.
ALLOW = (
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",                 # UUID
    r"^([A-Za-z]+|[0-9]+)([-_/=+]+([A-Za-z]+|[0-9]+))*[-_/=+]*$",            # words and numbers with separators
)
#: Placeholders cut a span; one whose pieces are all shorter than a window is not reported.
PLACEHOLDER = r"(?i)example|sample|placeholder|change_?me|dummy|redacted|x{6}|0{8}|1234567"


def running(values: Column, zero: Column, op) -> Column:
    """For each position, ``op`` folded over all earlier values, from ``zero``.  Blocks keep the work far below the square of the length."""
    def before(part: Column) -> Column:
        return F.transform(part, lambda _, i: F.aggregate(F.slice(part, 1, i), zero, op))

    def blocks(n: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), F.ceil(n / width).cast("int") - 1), lambda b: F.slice(values, b * width + 1, width))

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, zero, op))
        return bound(before(totals), lambda starts: F.flatten(F.zip_with(parts, starts, lambda p, s: F.transform(before(p), lambda x: op(s, x)))))

    return F.when(F.size(values) > 0, bound(blocks(F.size(values)), joined)).otherwise(values)


def bound(value: Column, body) -> Column:
    """``body`` on a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def matches(text: Column, pattern: str) -> Column:
    """Every leftmost non-overlapping match as (start, end, match), in order."""
    def placed(found: Column) -> Column:
        gaps = F.slice(F.transform(F.split(text, pattern, -1), F.char_length), 1, F.size(found))
        sized = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g"), F.char_length(m).alias("n")))
        return bound(sized, lambda s: F.zip_with(s, running(F.transform(s, lambda x: x["g"] + x["n"]), F.lit(0), lambda a, x: a + x), lambda x, at: F.struct(
            (at + x["g"]).alias("start"), (at + x["g"] + x["n"]).alias("end"), x["m"].alias("m"))))

    empty = F.array().cast("array<struct<start: int, end: int, m: string>>")
    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(empty))


def spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), m["end"].alias("end")))


def allowed(candidate: Column) -> Column:
    hit = F.lit(False)
    for pattern in ALLOW:
        hit = hit | candidate.rlike(pattern)
    return hit


def hot_range(candidate: Column, alphabet: str, least: float) -> Column:
    """(lo, hi) offsets that the windows of at least ``least`` bits cover; lo is null if there is none."""
    chars = F.transform(F.filter(F.split(candidate, "", -1), lambda c: c != ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    # c * log2(c) for every count a window can hold
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    start = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("n"), F.lit(0.0).alias("sum"),
                     F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi"),
                     F.lit(0).alias("i"), F.array().cast("array<int>").alias("w"))

    def at(values: Column, i: Column) -> Column:
        return F.element_at(values, (i + 1).cast("int"))

    def step(acc: Column, x: Column) -> Column:
        # leave: the character that drops out of the window, -1 while the window fills
        i = acc["i"]
        leave = F.when(i >= WINDOW, F.element_at(acc["w"], 1)).otherwise(F.lit(-1))
        came = at(acc["n"], x)
        grown = acc["sum"] + at(weight, came + 1) - at(weight, came)
        gone = F.when(leave >= 0, at(acc["n"], F.greatest(leave, F.lit(0))) + F.when(leave == x, 1).otherwise(0)).otherwise(1)
        total = grown - F.when(leave >= 0, at(weight, gone) - at(weight, gone - 1)).otherwise(0.0)
        hot = (i >= WINDOW - 1) & (math.log2(WINDOW) - total / WINDOW >= least)
        window = F.concat(F.when(i >= WINDOW, F.slice(acc["w"], 2, WINDOW)).otherwise(acc["w"]), F.array(x))
        return F.struct(
            F.transform(acc["n"], lambda n, k: n + F.when(k == x, 1).otherwise(0) - F.when(k == leave, 1).otherwise(0)).alias("n"),
            total.alias("sum"),
            F.when(hot & acc["lo"].isNull(), i - (WINDOW - 1)).otherwise(acc["lo"]).alias("lo"),
            F.when(hot, i + 1).otherwise(acc["hi"]).alias("hi"),
            (i + 1).alias("i"), window.alias("w"))

    return F.aggregate(chars, start, step, lambda acc: F.struct(acc["lo"].alias("lo"), acc["hi"].alias("hi")))


def entropy_spans(text: Column, kind: str, alphabet: str, pattern: str, least: float) -> Column:
    candidates = F.filter(matches(text, pattern), lambda m: m["m"].rlike("[0-9]") & m["m"].rlike("[A-Za-z]") & ~allowed(m["m"]))
    ranged = F.transform(candidates, lambda m: F.struct(m["start"].alias("start"), m["m"].alias("m"), hot_range(m["m"], alphabet, least).alias("r")))
    real = F.filter(ranged, lambda m: m["r"]["lo"].isNotNull() & F.exists(
        F.split(F.substr(m["m"], m["r"]["lo"] + 1, m["r"]["hi"] - m["r"]["lo"]), PLACEHOLDER, -1), lambda p: F.char_length(p) >= WINDOW))
    return F.transform(real, lambda m: F.struct(
        (m["start"] + m["r"]["lo"]).alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), (m["start"] + m["r"]["hi"]).alias("end")))


def scan_secrets(docs: DataFrame, base: str = "base_spans", more: str = "entropy_spans") -> DataFrame:
    """``docs`` with two arrays of (start, kind_no, end), each in order of start, then kind; kind_no indexes KINDS.

    Input columns of these two names are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(matches(text, ASSIGN), lambda m: F.char_length(F.regexp_extract(m["m"], ASSIGN, 2)) >= ASSIGN_VALUE)
    fixed = F.sort_array(F.concat(spans(assign, "assign"), spans(matches(text, ACCESS), "access"), spans(matches(text, HEX), "hex")))
    found = F.concat(*[entropy_spans(text, *c) for c in CLASSES])

    def inside_none(b: Column, f: Column) -> Column:
        """Spans of ``f`` that lie in none of ``b``: in order of starts, the furthest end of the base spans so far decides."""
        def span(x: Column, new: int) -> Column:
            return F.struct(x["start"].alias("start"), F.lit(new).alias("new"), x["kind_no"].alias("kind_no"), x["end"].alias("end"))

        def kept(both: Column) -> Column:
            ends = F.transform(both, lambda x: F.when(x["new"] == 0, x["end"]).otherwise(F.lit(-1)))
            furthest = running(ends, F.lit(-1), lambda a, x: F.greatest(a, x))
            marked = F.zip_with(both, furthest, lambda x, far: F.struct(x["start"].alias("start"), x["kind_no"].alias("kind_no"), x["end"].alias("end"),
                                                                          ((x["new"] == 1) & (far < x["end"])).alias("keep")))
            return F.transform(F.filter(marked, lambda x: x["keep"]), lambda x: F.struct(x["start"].alias("start"), x["kind_no"].alias("kind_no"), x["end"].alias("end")))

        return bound(F.sort_array(F.concat(F.transform(b, lambda x: span(x, 0)), F.transform(f, lambda x: span(x, 1)))), kept)

    # Both arrays in one value: the base scan is computed once, also where only the other one is asked for.
    both = bound(F.struct(fixed.alias("b"), found.alias("f")), lambda v: F.struct(v["b"].alias("b"), F.sort_array(inside_none(v["b"], v["f"])).alias("f")))
    out = docs.withColumn(OWN + "scan", both)
    return out.withColumn(base, F.col(OWN + "scan.b")).withColumn(more, F.col(OWN + "scan.f")).drop(OWN + "scan")


def as_text(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["kind_no"] + 1), s["start"], s["end"])), ",")
