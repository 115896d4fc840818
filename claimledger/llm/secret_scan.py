"""Secrets in texts: three base patterns, and high-entropy strings. DataFrame functions only.

* ``assign``, ``access`` and ``hex``: leftmost, non-overlapping matches of a fixed pattern each, without those that are
  too short;
* ``entropy``: candidates are runs of ``[A-Za-z0-9+/_=-]`` of 20 characters or more that hold a digit. A window slides over
  each; its Shannon entropy is kept up by adding the entering and taking off the leaving character, within pieces of the
  candidate that overlap by a window. The window and the
  limit depend on the class of the candidate's characters: hexadecimal digits (32 characters, 3.0 bits), letters and
  digits (24, 3.7), or the base64 alphabet (24, 3.9). A candidate with a window over its limit is a secret, unless an
  allowed shape says otherwise: a run of one class that counts up or down, a UUID, a decimal number, a path or words
  joined by separators, or an item of ``ALLOWED``. Candidates inside a base span add nothing.

Positions come from the texts between matches: ``(.*?)(pattern|\\z)`` cuts a text into gaps and matches, whose lengths add up.
Running sums and maxima are taken in blocks, so work grows with the text, however long it is and however many secrets it has.
"""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, in the order in which equal starts are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN_VALUE = r"[A-Za-z0-9+/_.=-]+"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy")
LEAST = {"assign": 8, "access": 16, "hex": 32}

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# Class: pattern of the whole candidate, window, least bits per character. The first that fits counts.
CLASSES = (
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 32, 3.0),
    ("alnum", r"^[A-Za-z0-9]+$", 24, 3.7),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", 24, 3.9),
)
# Shapes that are no secrets however mixed their characters are.
ALLOWED_SHAPES = (
    r"^[0-9]+$",
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    # possessive: a repeated group that may give back takes stack for every repetition
    r"^[/_-]?(?:[A-Za-z]{1,15}|[0-9]{1,8})(?:[/_=+-]+(?:[A-Za-z]{1,15}|[0-9]{1,8}))++[/_=+-]*$",
)
# Well-known strings that only look like secrets: alphabets and digit rows.
ALLOWED = (
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "0123456789abcdefghijklmnopqrstuvwxyz",
    "0123456789abcdef0123456789abcdef",
)
MASK = "[SECRET]"

# Items of an array that are added up one by one, and characters in which windows slide and from which gaps are cut.
BLOCK = 256
CHUNK = 192
PIECE = 2048
MAX_WINDOW = 64


def _pieces(text: Column, pattern: str, value: str | None = None) -> Column:
    """The cuts of a text at the matches of a pattern: gap, match and, where the pattern has one, its value.

    The last cut ends with the text and has no match. The pattern is tried only on texts that hold it.
    """
    whole = f"{pattern}{value}" if value else pattern
    # Group 1: the gap; 2: the match; 3: its value, if asked for.
    cut = rf"(?s)(.*?)({pattern}({value})|\z)" if value else rf"(?s)(.*?)({whole}|\z)"
    empty = F.array().cast("array<string>")

    def group(number: int) -> Column:
        return F.when(text.rlike(whole), F.regexp_extract_all(text, F.lit(cut), F.lit(number))).otherwise(empty)

    return F.arrays_zip(
        group(1).alias("gap"), group(2).alias("hit"), (group(3) if value else group(2)).alias("value")
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array of numbers from 0 up, by an associative ``op`` (a sum, a maximum).

    Added up within blocks, and then over blocks: appending to one long array would copy it for every item.
    """
    none = F.array().cast("array<int>")

    def last(items: Column) -> Column:
        return F.coalesce(F.get(items, F.size(items) - 1), F.lit(0))

    def scan(items: Column) -> Column:
        return F.aggregate(items, none, lambda done, x: F.concat(done, F.array(op(last(done), x).cast("int"))))

    def in_blocks(whole: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(whole) - 1) / BLOCK).cast("int")))
        return F.transform(numbers, lambda k: scan(F.slice(whole, k * BLOCK + 1, BLOCK)))

    def joined(blocks: Column) -> Column:
        def lifted(before: Column) -> Column:
            return F.flatten(
                F.transform(
                    blocks,
                    lambda block, k: F.transform(block, lambda x: op(F.coalesce(F.get(before, k - 1), F.lit(0)), x).cast("int")),
                )
            )

        return _let(scan(F.transform(blocks, last)), lifted)

    return _let(values, lambda whole: _let(in_blocks(whole), joined))


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _spans(pieces: Column, kind: str) -> Column:
    """The matches as structs (start, order of the kind, end, value)."""
    order = KINDS.index(kind)

    def placed(cuts: Column) -> Column:
        sizes = F.transform(cuts, lambda c: F.length(c["gap"]) + F.length(c["hit"]))

        def spans(ends: Column) -> Column:
            return F.transform(
                cuts,
                lambda c, at: F.struct(
                    (F.get(ends, at) - F.length(c["hit"])).alias("start"),
                    F.lit(order).alias("rank"),
                    F.get(ends, at).alias("end"),
                    c["value"].alias("value"),
                ),
            )

        return _let(running(sizes, _sum), spans)

    # Only the last cut may have no match.
    return F.filter(_let(pieces, placed), lambda s: s["start"] < s["end"])


def _gains(most: int) -> Column:
    """(c + 1) log2(c + 1) - c log2 c for counts c from 0 on."""
    c_log_c = [c * math.log2(c) if c else 0.0 for c in range(most + 2)]
    return F.array(*[F.lit(after - before) for before, after in zip(c_log_c, c_log_c[1:])])


def _chunk_entropy(chunk: Column, width: Column) -> Column:
    """The greatest entropy of a full window in a short piece of text; 0 if there is none."""
    gains = _gains(MAX_WINDOW)

    def step(state: Column, at: Column) -> Column:
        size = F.least(at - 1, width)
        before = F.substring(chunk, at - size, size)
        entering, leaving = F.substring(chunk, at, 1), F.substring(chunk, at - width, 1)
        full = at > width

        def count(letter: Column) -> Column:
            return size - F.length(F.replace(before, letter, F.lit("")))

        gained = F.get(gains, count(entering))
        change = F.when(~full, gained).when(entering == leaving, 0.0).otherwise(gained - F.get(gains, count(leaving) - 1))
        total = state["total"] + change
        best = F.when(at >= width, F.greatest(state["best"], F.log2(width) - total / width)).otherwise(state["best"])
        return F.struct(total.alias("total"), best.alias("best"))

    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
    places = F.sequence(F.lit(1), F.length(chunk))
    return F.aggregate(places, start, step, lambda state: state["best"])


def _chunks(text: Column, width: Column) -> Column:
    """A text in pieces that overlap by a window less one character; none for an empty text."""

    def overlapped(pieces: Column) -> Column:
        return F.transform(
            pieces, lambda own, k: F.concat(own, F.substring(F.coalesce(F.get(pieces, k + 1), F.lit("")), F.lit(1), width - 1))
        )

    return _let(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0)), overlapped)


def max_window_entropy(text: Column, window: Column) -> Column:
    """The greatest Shannon entropy (bits per character) of a window of ASCII characters in ``text``.

    A shorter text is one window. With counts c of a window of w characters, the entropy is log2(w) - sum(c log2 c) / w; the
    sum changes by two terms when the window moves by one character. Work grows with the length of the text.
    """

    def of_width(width: Column) -> Column:
        return F.array_max(F.transform(_chunks(text, width), lambda chunk: _chunk_entropy(chunk, width)))

    return F.coalesce(_let(F.least(window, F.length(text)), of_width), F.lit(0.0))


def has_window(text: Column, window: Column, least: Column) -> Column:
    """Whether ``text`` has a window of at least ``least`` bits per character. Stops at the first piece that has one."""

    def reached(limits: Column) -> Column:
        return F.exists(
            _chunks(text, limits["width"]), lambda chunk: _chunk_entropy(chunk, limits["width"]) >= limits["least"]
        )

    return _let(F.struct(F.least(window, F.length(text)).alias("width"), least.alias("least")), reached)


def is_entropic(candidate: Column) -> Column:
    """Whether a candidate has a window over the limit of its class and no allowed shape."""
    window, least = F.lit(CLASSES[-1][2]), F.lit(CLASSES[-1][3])
    for _, shape, size, bits in reversed(CLASSES[:-1]):
        window = F.when(candidate.rlike(shape), F.lit(size)).otherwise(window)
        least = F.when(candidate.rlike(shape), F.lit(bits)).otherwise(least)
    allowed = candidate.isin(*ALLOWED)
    for shape in ALLOWED_SHAPES:
        allowed = allowed | candidate.rlike(shape)
    return candidate.rlike("[0-9]") & ~allowed & has_window(candidate, window, least)


def _outside(candidates: Column, base: Column) -> Column:
    """The candidates that lie in no base span.

    In the order of their starts, base spans first, a candidate lies in one if some base span up to it ends no earlier.
    """

    def events(own: Column) -> Column:
        first = F.transform(base, lambda s: F.struct(s["start"].alias("start"), F.lit(-1).alias("at"), s["end"].alias("end")))
        second = F.transform(own, lambda s, at: F.struct(s["start"].alias("start"), at.alias("at"), s["end"].alias("end")))
        return F.array_sort(F.concat(first, second))

    def kept(own: Column) -> Column:
        def free(ordered: Column) -> Column:
            reach = running(F.transform(ordered, lambda e: F.when(e["at"] < 0, e["end"]).otherwise(0)), F.greatest)

            def open_ones(ends: Column) -> Column:
                places = F.transform(ordered, lambda e, k: F.when((e["at"] >= 0) & (F.get(ends, k) < e["end"]), e["at"]))
                return F.transform(F.filter(places, lambda at: at.isNotNull()), lambda at: F.get(own, at))

            return _let(reach, open_ones)

        return _let(events(own), free)

    return _let(candidates, kept)


def find_secrets(documents: DataFrame, text: str = "text", spans: str = "secrets") -> DataFrame:
    """``documents`` with an array of structs (kind, start, end), by start and then in the order of ``KINDS``.

    Positions are code points, end exclusive. Spans of different kinds may overlap. A NULL or empty text has none, and a
    column that is called like ``spans`` is replaced. No shuffle; each text is handled whole, where it is read.
    """
    given = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(_spans(_pieces(given, ASSIGN, ASSIGN_VALUE), "assign"), lambda s: F.length(s["value"]) >= LEAST["assign"])
    # A match shorter than the limit fails as a whole, so runs may be looked for at their least length.
    access = _spans(_pieces(given, rf"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}"), "access")
    hexes = _spans(_pieces(given, rf"[0-9a-f]{{{LEAST['hex']},}}"), "hex")
    candidates = _spans(_pieces(given, CANDIDATE), "entropy")

    def named(base: Column) -> Column:
        entropic = F.filter(_outside(candidates, base), lambda c: is_entropic(c["value"]))
        bare = F.transform(F.concat(base, entropic), lambda s: F.struct(s["start"], s["rank"], s["end"]))
        kinds = F.array(*map(F.lit, KINDS))
        return F.transform(
            F.array_sort(bare),
            lambda s: F.struct(F.get(kinds, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
        )

    found = _let(F.concat(assign, access, hexes), named)
    kept = [c for c in documents.columns if c != spans]
    return documents.select(*kept, found.alias(spans))


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end`` of one that is cut into pieces of ``PIECE`` characters."""
    first, last = F.floor(start / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
    own = F.coalesce(F.get(pieces, first), F.lit(""))
    within = F.substring(own, start % PIECE + 1, end - start)
    across = F.concat(
        F.substring(own, start % PIECE + 1, F.lit(PIECE)),
        F.concat_ws("", F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0)))),
        F.substring(F.coalesce(F.get(pieces, last), F.lit("")), F.lit(1), end % PIECE),
    )
    return F.when(first == last, within).otherwise(across)


def masked(text: Column, spans: Column) -> Column:
    """The text with every secret replaced by ``MASK``; overlapping secrets by one.

    Put together once, from the gaps between secrets; a gap is taken from the piece of the text that it lies in.
    """

    def of_spans(own: Column) -> Column:
        def of_pieces(pieces: Column) -> Column:
            def joined(ends: Column) -> Column:
                def cut(span: Column, k: Column) -> Column:
                    at = F.coalesce(F.get(ends, k - 1), F.lit(0))
                    return F.when(
                        span["start"] >= at, F.concat(_between(pieces, at, span["start"]), F.lit(MASK))
                    ).otherwise(F.lit(""))

                rest = _between(pieces, F.coalesce(F.get(ends, F.size(ends) - 1), F.lit(0)), F.length(text))
                return F.concat(F.concat_ws("", F.transform(own, cut)), rest)

            return _let(running(F.transform(own, lambda s: s["end"]), F.greatest), joined)

        return _let(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0)), of_pieces)

    return _let(spans, of_spans)


def without_secrets(documents: DataFrame) -> DataFrame:
    """The documents with their secrets masked and ``n_chars`` counted anew where a text was changed."""
    found = find_secrets(documents, spans="_secrets")
    changed = F.size("_secrets") > 0
    text = F.when(changed, masked(F.col("text"), F.col("_secrets"))).otherwise(F.col("text"))
    new = found.withColumn("_text", text)
    columns = []
    for name in documents.columns:
        if name == "text":
            columns.append(F.col("_text").alias("text"))
        elif name == "n_chars":
            kind = documents.schema[name].dataType
            columns.append(F.when(changed, F.length("_text").cast(kind)).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return new.select(*columns)
