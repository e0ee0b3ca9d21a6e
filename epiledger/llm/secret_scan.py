"""Secrets in texts: known shapes and windows of high entropy; DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = ("password", "passwd", "secret", "token", "api_?key")


def _any_case(pattern: str) -> str:
    """The pattern with each ASCII letter in either case, and no letter beyond ASCII."""
    return "".join(f"[{c.upper()}{c}]" if "a" <= c <= "z" else c for c in pattern)


# kind: pattern, group whose length counts, characters it needs.
SHAPES = {
    "assign": (
        f"({'|'.join(_any_case(w) for w in WORDS)})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
}

# kind: alphabet, whether case matters, pattern of a candidate string, characters it must all hold, bits a character.
ENTROPY = {
    "entropy_hex": ("0123456789abcdef", False, "[0-9A-Fa-f]{%d,}", ("[0-9]", "[A-Fa-f]"), 3.0),
    "entropy_base64": (
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=",
        True,
        "[A-Za-z0-9+/_=-]{%d,}",
        ("[A-Z]", "[a-z]", "[0-9]"),
        3.8,
    ),
}

# Candidate strings that are no secrets: placeholders, spelled-out alphabets, repeated groups, joined words with a year.
# Patterns without nested repetition, as Java's matcher would recurse into it on long strings.
ALLOWED = (
    "(?i)example|sample|placeholder|changeme|dummy|redacted|your[_-]",
    "(?i)0123456789|1234567890|abcdefghij|qwertyuiop",
    "^(.{1,8})\\1+$",
    "^[A-Za-z][A-Za-z/_-]*[0-9]{0,4}$",
)

SCALE = 1_000_000
SPANS = "array<struct<match: string, size: int, start: int, end: int>>"


def _run_totals(sizes: Column) -> Column:
    """Totals up to each place of an array: doubling steps, so a long array costs n log n."""
    doublings = F.ceil(F.log2(F.greatest(F.size(sizes), F.lit(1)))).cast("int")
    steps = F.transform(F.sequence(F.lit(0), doublings), lambda e: F.pow(F.lit(2), e).cast("int"))
    return F.aggregate(
        steps,
        sizes,
        lambda totals, step: F.transform(totals, lambda x, i: x + F.coalesce(F.get(totals, i - step), F.lit(0))),
    )


def _pattern(kind: str, width: int) -> str:
    """What the text is searched for.

    A run of hexadecimal digits holds no shorter match, so its least length may stand in the pattern;
    a match of an assignment that fails still uses up its text.
    """
    if kind in ENTROPY:
        return ENTROPY[kind][2] % width
    pattern, _, least = SHAPES[kind]
    return pattern.removesuffix("+") + "{%d,}" % least if kind == "hex" else pattern


def _matches(kind: str, width: int) -> Column:
    """(match, size, start, end) of each match; one piece of the split text lies before each."""
    pattern, found, text = _pattern(kind, width), F.col(f"all_{kind}"), F.col("text")
    group = SHAPES[kind][1] if kind in SHAPES else 0
    sized = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    both = F.zip_with(
        found, F.split(text, pattern, -1), lambda m, p: F.length(p) + F.coalesce(F.length(m), F.lit(0))
    )
    ends = F.slice(_run_totals(both), F.lit(1), F.size(found))
    spans = F.transform(
        F.arrays_zip(found.alias("match"), sized.alias("sized"), ends.alias("end")),
        lambda m: F.struct(
            m["match"].alias("match"),
            F.length(m["sized"]).alias("size"),
            (m["end"] - F.length(m["match"])).alias("start"),
            m["end"].alias("end"),
        ),
    )
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(SPANS))


def _high_windows(candidate: Column, kind: str, width: int) -> Column:
    """From the first window of a candidate that reaches the entropy to the end of the last; nulls if none does.

    With n a character's count in the window, the entropy is log2(width) less the sum of n log2 n
    over the width.  That sum, in millionths, moves from window to window by the two characters
    that come and go.
    """
    alphabet, cased, _, _, bits = ENTROPY[kind]
    table = F.array(*[F.lit(round(SCALE * n * math.log2(n)) if n else 0).cast("long") for n in range(width + 1)])
    limit = math.floor(SCALE * width * (math.log2(width) - bits))
    match = candidate["match"] if cased else F.lower(candidate["match"])
    codes = F.transform(F.split(match, ""), lambda c: F.position(c, F.lit(alphabet)) - 1)
    counts = F.transform(
        F.sequence(F.lit(0), F.lit(len(alphabet) - 1)),
        lambda k: F.size(F.filter(F.slice(codes, 1, width), lambda c: c == k)),
    )
    slides = candidate["size"] - width
    return F.aggregate(
        F.slice(F.sequence(F.lit(0), slides), F.lit(1), slides),
        F.struct(
            codes.alias("codes"),
            counts.alias("counts"),
            F.aggregate(counts, F.lit(0).cast("long"), lambda total, n: total + F.get(table, n)).alias("sum"),
            F.lit(None).cast("int").alias("start"),
            F.lit(None).cast("int").alias("end"),
        ),
        lambda window, at: _slid(window, at, table, limit, width),
        lambda window: F.struct(
            (candidate["start"] + _first(window, slides, limit)).alias("start"),
            (candidate["start"] + _last(window, slides, limit, width)).alias("end"),
        ),
    )


def _first(window: Column, at: Column, limit: int) -> Column:
    return F.when(window["sum"] <= limit, F.coalesce(window["start"], at)).otherwise(window["start"])


def _last(window: Column, at: Column, limit: int, width: int) -> Column:
    return F.when(window["sum"] <= limit, at + width).otherwise(window["end"])


def _slid(window: Column, at: Column, table: Column, limit: int, width: int) -> Column:
    """The window that starts at ``at`` noted and moved on by one character."""
    gone, come = F.get(window["codes"], at), F.get(window["codes"], at + width)
    less, more = F.get(window["counts"], gone), F.get(window["counts"], come)
    moved = window["sum"] - F.get(table, less) + F.get(table, less - 1) - F.get(table, more) + F.get(table, more + 1)
    counts = F.transform(window["counts"], lambda n, k: n + (k == come).cast("int") - (k == gone).cast("int"))
    return F.struct(
        window["codes"].alias("codes"),
        F.when(gone == come, window["counts"]).otherwise(counts).alias("counts"),
        F.when(gone == come, window["sum"]).otherwise(moved).alias("sum"),
        _first(window, at, limit).alias("start"),
        _last(window, at, limit, width).alias("end"),
    )


def scan_secrets(
    docs: DataFrame,
    width: int = 20,
    allowed: tuple[str, ...] = ALLOWED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``id``, lists of spans ``base`` and ``found``.

    A span is (start, rank, end, kind), counted in code points, the end exclusive; lists are ordered by
    start, then by kind in the order of ``SHAPES`` and ``ENTROPY``.  ``base`` are the matches of known
    shape.  ``found`` holds these and the strings of a character class in which a window of ``width``
    characters has the entropy of its class: from the first such window to the end of the last.
    Candidates that match a pattern of ``allowed``, or lack a kind of character that random strings of the
    class have, are passed over.  Spans of two kinds may overlap.

    A null text counts as empty and has no spans.  Repeated rows and null ids are kept as rows.  A long
    text stays in its row; its cost grows with n log n.  Of an empty table the result is empty.  Other
    columns are not read.
    """
    kinds = [*SHAPES, *ENTROPY]
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    rows = rows.select(
        "id", "text",
        *[F.regexp_extract_all("text", F.lit(_pattern(k, width)), F.lit(0)).alias(f"all_{k}") for k in kinds],
    )
    rows = rows.select("id", *[_matches(k, width).alias(k) for k in kinds])

    def span(kind: str, found: Column) -> Column:
        rank = F.lit(kinds.index(kind))
        return F.struct(
            found["start"].alias("start"), rank.alias("rank"), found["end"].alias("end"), F.lit(kind).alias("kind")
        )

    def shaped(kind: str) -> Column:
        least = SHAPES[kind][2]
        return F.transform(F.filter(kind, lambda m: m["size"] >= least), lambda m: span(kind, m))

    def high(kind: str) -> Column:
        needed = ENTROPY[kind][3]

        def likely(m: Column) -> Column:
            verdict = F.lit(True)
            for pattern in needed:
                verdict = verdict & m["match"].rlike(pattern)
            for pattern in allowed:
                verdict = verdict & ~m["match"].rlike(pattern)
            return verdict

        windows = F.transform(F.filter(kind, likely), lambda m: _high_windows(m, kind, width))
        return F.transform(F.filter(windows, lambda w: w["start"].isNotNull()), lambda w: span(kind, w))

    base = F.array_sort(F.concat(*[shaped(k) for k in SHAPES]))
    more = F.concat(*[high(k) for k in ENTROPY])
    return rows.select("id", base.alias("base"), more.alias("more")).select(
        "id", "base", F.array_sort(F.concat("base", "more")).alias("found")
    )


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
