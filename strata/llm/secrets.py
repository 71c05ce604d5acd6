"""Secret scans (operator 8), DataFrame functions only.

Base kinds are patterns (``assign``, ``access``, ``hex``). The method adds
``entropy`` spans: candidate strings are runs of 24 or more characters of one
character class (hex digits, letters and digits, base64); a window of
``WINDOW`` characters slides over the run, and its Shannon entropy is kept up by
counts of the entering and the leaving character alone. A run whose highest
window reaches its class's threshold is a secret, unless an allow-list pattern
fits it. Base spans are cut out of a run first; what is left on either side is
judged by itself where it still has the 24 characters.

Positions are code points. A pattern's matches and the texts between them tile
the text, so running sums of their lengths give every span. The time for a text
grows with its length and (but for a logarithm) with its spans: running sums go
by chunks, the base spans that meet a run are found by bisection, and parts of a
long text are taken from pieces of it.

Defined results: a null or empty text has no spans (and the digest of the empty
string); whole texts are scanned; repeated rows and null ids are scanned as they
come; extra columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, table


def _any_case(letters: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in letters)


_KEYS = "|".join(
    [_any_case(k) for k in ("password", "passwd", "secret", "token")] + [_any_case("api") + "_?" + _any_case("key")]
)
ASSIGN = rf"({_KEYS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_VALUE = 6
# Greedy runs: requiring the length in the pattern gives the runs of that length.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy")

WINDOW = 20
#: Windows are slid over pieces of a run that begin so many characters apart:
#: taking a character out of a string costs as much as the string is long.
PIECE = 128
SHORTEST = 24
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}"
#: Character class of a run, tried in this order, and the bits a character
#: that its best window must reach.
CLASSES = (
    ("hex", r"^[0-9A-Fa-f]+$", 3.0),
    ("alphanumeric", r"^[A-Za-z0-9]+$", 3.6),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.6),
)
#: Runs that look random but are no secrets. Groups repeat possessively, over
#: parts that share no character: others are matched by recursion, whose stack a
#: long run overflows.
ALLOW = (
    r"^[A-Za-z]+$",  # words of one alphabet
    r"^[0-9]+$",  # numbers
    r"^[A-Z]?[a-z]++(?:[_/+=-]++[A-Za-z]?+[a-z]*+)*+$",  # words joined by signs
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",  # UUID
    r"^(.)\1*$",  # one character
    # lower-case path; letters before it may end in a slash or two
    r"^[A-Za-z]*+(?:(?:[0-9-][a-z0-9-]*+|(?<=[a-z]))/(?:[a-z0-9-]++/)*+|//?(?:[a-z0-9-]++/)++)[a-z0-9-]*+$",
)


def _lit(pattern: str) -> Column:
    return F.lit(pattern)


#: Values that a running sum or maximum takes at once; characters of a text's pieces.
CHUNK = 256
TEXT_PIECE = 4096


def _empty(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


def _running(values: Column, combine) -> Column:
    """Running results of an associative ``combine`` over an array of int, zero
    first: by chunks, whose totals are combined in the same way."""

    def within(chunk):
        state = F.struct(F.lit(0).alias("last"), _empty("int").alias("out"))

        def step(a, x):
            now = combine(a["last"], x)
            return F.struct(now.alias("last"), F.concat(a["out"], F.array(now)).alias("out"))

        return F.aggregate(chunk, state, step, lambda a: a["out"])

    starts = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int"))).otherwise(_empty("int"))
    # a generator's array of one element is computed once, unlike a repeated expression
    chunks = F.transform(starts, lambda k: within(F.slice(values, k * CHUNK + 1, F.lit(CHUNK))))

    def put_together(inner):
        totals = within(F.transform(inner, lambda c: F.element_at(c, -1)))
        return F.flatten(
            F.transform(
                F.arrays_zip(inner.alias("c"), F.slice(F.concat(F.array(F.lit(0)), totals), F.lit(1), F.size(inner)).alias("o")),
                lambda z: F.transform(z["c"], lambda x: combine(z["o"], x)),
            )
        )

    return F.element_at(F.transform(F.array(chunks), put_together), 1)


def _spans(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, value>>`` of the pattern's matches."""

    def tiled(z):
        ends = _running(F.zip_with(z["gaps"], z["values"], lambda g, v: g + F.length(v)), lambda a, x: a + x)
        return F.zip_with(
            ends,
            z["values"],
            lambda e, v: F.struct((e - F.length(v)).alias("start"), e.alias("end"), v.alias("value")),
        )

    values = F.regexp_extract_all(text, _lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    both = F.array(F.struct(F.slice(gaps, F.lit(1), F.greatest(F.size(gaps) - 1, F.lit(0))).alias("gaps"), values.alias("values")))
    # most texts have no match: they are searched once
    found = F.element_at(F.transform(both, tiled), 1)
    return F.when(F.regexp_instr(text, _lit(pattern)) > 0, found).otherwise(
        _empty("struct<start:int,end:int,value:string>")
    )


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, _lit(rf"(?s).{{1,{TEXT_PIECE}}}"), F.lit(0))


def _part(pieces: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` to ``end`` of a text given by its pieces."""
    first = F.floor(start / TEXT_PIECE).cast("int")
    last = F.floor(F.greatest(end - 1, start) / TEXT_PIECE).cast("int")
    held = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(held, start - first * TEXT_PIECE + 1, end - start)).otherwise("")


def _piece_entropy(run: Column, window: int) -> Column:
    """The highest Shannon entropy (bits a character) of the windows of a run.

    With n(c) the window's counts, entropy is log2(w) - sum(n log2 n) / w; a
    step changes that sum by the terms of one entering and one leaving character.
    """

    def term(n: Column) -> Column:
        return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))

    def count(c: Column, part: Column) -> Column:
        return F.length(part) - F.length(F.replace(part, c, F.lit("")))

    def step(acc, i):
        new = F.substring(run, i, F.lit(1))
        start = F.greatest(F.lit(1), i - window)  # of the window before this step
        before = F.substring(run, start, i - start)
        old = F.substring(run, start, F.lit(1))
        grown = count(new, before)
        entered = acc["sum"] + term(grown + 1) - term(grown)
        leaving = count(old, before) + (old == new).cast("int")
        total = F.when(i > window, entered - term(leaving) + term(leaving - 1)).otherwise(entered)
        size = F.least(i, F.lit(window)).cast("double")
        bits = F.log2(size) - total / size
        best = F.when((i >= window) | (i == F.length(run)), F.greatest(acc["best"], bits)).otherwise(acc["best"])
        return F.struct(total.alias("sum"), best.alias("best"))

    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
    return F.aggregate(F.sequence(F.lit(1), F.length(run)), start, step, lambda acc: acc["best"])


def window_entropy(run: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy (bits a character) of the windows of a run of
    any length: of its pieces, each with the windows that begin in it."""
    pieces = F.regexp_extract_all(run, _lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
    whole = F.zip_with(
        pieces,
        F.slice(pieces, F.lit(2), F.size(pieces)),
        lambda p, after: F.concat(p, F.coalesce(F.substring(after, 1, window - 1), F.lit(""))),
    )
    begun = F.filter(whole, lambda p, i: (i == 0) | (F.length(p) >= window))
    return F.coalesce(F.array_max(F.transform(begun, lambda p: _piece_entropy(p, window))), F.lit(0.0))


def suspicious(run: Column) -> Column:
    """Whether a candidate run is a secret by entropy and no allow-list fits."""
    threshold = F.lit(99.0)
    for _, pattern, bits in reversed(CLASSES):
        threshold = F.when(run.rlike(pattern), F.lit(bits)).otherwise(threshold)
    allowed = F.lit(False)
    for pattern in ALLOW:
        allowed = allowed | run.rlike(pattern)
    return ~allowed & (window_entropy(run) >= threshold)


def _with_kind(spans: Column, kind: str) -> Column:
    order = KINDS.index(kind)
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("kind_no"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def _merged(spans: Column) -> Column:
    """The stretches that spans (in order of start) cover, without overlaps, as
    ``array<struct<start, end>>``."""

    def stretches(z):
        # the furthest end before each span; the span begins a stretch if it lies beyond
        begins = F.filter(
            F.arrays_zip(z["s"].alias("s"), F.concat(F.array(F.lit(-1)), z["upto"]).alias("before"), z["upto"].alias("upto")),
            lambda x: x["s"].isNotNull() & (x["s"]["start"] >= x["before"]),
        )
        # a stretch ends where its last span's furthest end lies: just before the next begins
        return F.zip_with(
            begins,
            F.concat(F.slice(begins, F.lit(2), F.size(begins)), F.array(F.element_at(begins, -1))),
            lambda x, y: F.struct(
                x["s"]["start"].alias("start"),
                F.when(y["s"]["start"] > x["s"]["start"], y["before"]).otherwise(F.array_max(z["upto"])).alias("end"),
            ),
        )

    upto = _running(F.transform(spans, lambda s: s["end"]), F.greatest)
    whole = F.element_at(F.transform(F.array(F.struct(spans.alias("s"), upto.alias("upto"))), stretches), 1)
    return F.when(F.size(spans) > 0, whole).otherwise(_empty("struct<start:int,end:int>"))


def _first_beyond(covered: Column, at: Column) -> Column:
    """How many of the stretches (in order) end at or before ``at``, by bisection."""
    state = F.struct(F.lit(0).alias("lo"), F.size(covered).alias("hi"))

    def step(a, _):
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        low = F.get(covered, mid)["end"] <= at
        return F.when(a["lo"] >= a["hi"], a).otherwise(
            F.struct(F.when(low, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(low, a["hi"]).otherwise(mid).alias("hi"))
        )

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(covered) + 1.0)).cast("int"))
    return F.aggregate(rounds, state, step, lambda a: a["lo"])


def _cut(runs: Column, covered: Column) -> Column:
    """What the covered stretches leave of each run, where it has ``SHORTEST``
    characters."""

    def left(r, lo):
        # stretches that meet the run follow each other from ``lo`` on
        meeting = F.filter(
            F.slice(covered, lo + 1, F.greatest(_first_beyond(covered, r["end"]) - lo + 1, F.lit(0))),
            lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]),
        )

        def rest(z):
            begins = F.concat(F.array(r["start"]), F.transform(z["m"], lambda b: b["end"]))
            ends = F.concat(F.transform(z["m"], lambda b: b["start"]), F.array(r["end"]))
            free = F.filter(
                F.arrays_zip(begins.alias("start"), ends.alias("end")), lambda p: p["end"] - p["start"] >= SHORTEST
            )
            return F.transform(
                free,
                lambda p: F.struct(
                    p["start"].alias("start"),
                    p["end"].alias("end"),
                    _part(z["p"], p["start"] - r["start"], p["end"] - r["start"]).alias("value"),
                ),
            )

        both = F.array(F.struct(meeting.alias("m"), _pieces(r["value"]).alias("p")))
        return F.element_at(F.transform(both, rest), 1)

    def one(r):
        def at(lo):
            meets = F.coalesce(F.get(covered, lo)["start"] < r["end"], F.lit(False))
            return F.when(meets, left(r, lo)).otherwise(F.array(r))

        return F.element_at(F.transform(F.array(_first_beyond(covered, r["start"])), at), 1)

    return F.when(F.size(covered) > 0, F.flatten(F.transform(runs, one))).otherwise(runs)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def with_spans(docs: DataFrame, *, text: str = "text", prefix: str = "_s_") -> DataFrame:
    """``docs`` with the arrays ``{prefix}base`` and ``{prefix}all`` of
    ``struct<start, kind_no, end, kind>``, in order of start and kind."""
    t = F.coalesce(col(text).cast("string"), F.lit(""))
    raw = docs.withColumns(
        {
            f"{prefix}assign": F.filter(
                _spans(t, ASSIGN), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_VALUE
            ),
            f"{prefix}access": _spans(t, ACCESS),
            f"{prefix}hex": _spans(t, HEX),
            f"{prefix}runs": _spans(t, CANDIDATE),
        }
    )
    base = F.array_sort(F.concat(*[_with_kind(F.col(f"{prefix}{k}"), k) for k in BASE_KINDS]))
    listed = raw.withColumn(f"{prefix}base", base).withColumn(f"{prefix}covered", _merged(F.col(f"{prefix}base")))
    added = F.filter(
        _cut(F.col(f"{prefix}runs"), F.col(f"{prefix}covered")),
        lambda r: suspicious(r["value"]),
    )
    return listed.withColumn(
        f"{prefix}all", F.array_sort(F.concat(F.col(f"{prefix}base"), _with_kind(added, "entropy")))
    ).drop(f"{prefix}runs", f"{prefix}covered")


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_entropy``, the base spans and all
    spans (arrays of ``start, kind_no, end, kind``) of every row of ``docs``."""
    found = with_spans(docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")))
    return found.select(
        "doc_id",
        *[F.size(f"_s_{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        (F.size("_s_all") - F.size("_s_base")).cast("long").alias("n_entropy"),
        F.col("_s_base").alias("base"),
        F.col("_s_all").alias("all"),
    )


def redact(docs: DataFrame, *, text: str = "text", mark: str = "[SECRET]", length: str | None = None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark`` (spans that
    overlap become one mark); texts without spans are left as they are. A column
    named by ``length`` gets the new number of characters where a text changed."""
    found = with_spans(docs, text=text, prefix="_strata_secret_")
    spans = F.col("_strata_secret_all")
    t = col(text)

    def rewritten(z):
        ends = F.concat(F.array(F.lit(0)), F.transform(z["m"], lambda s: s["end"]))
        starts = F.concat(F.transform(z["m"], lambda s: s["start"]), F.array(F.length(t)))
        return F.array_join(F.zip_with(ends, starts, lambda a, b: _part(z["p"], a, b)), mark)

    both = F.array(F.struct(_merged(spans).alias("m"), _pieces(t).alias("p")))
    clean = F.element_at(F.transform(both, rewritten), 1)
    new = found.withColumn("_strata_secret_text", F.when(F.size(spans) > 0, clean).otherwise(t))
    out = []
    for c in docs.columns:
        if c == text:
            out.append(F.col("_strata_secret_text").alias(c))
        elif c == length:
            kind = docs.schema[c].dataType
            out.append(
                F.when(F.size(spans) > 0, F.length("_strata_secret_text").cast(kind)).otherwise(col(c)).alias(c)
            )
        else:
            out.append(col(c))
    return new.select(*out)


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Query: secrets found in every document."""
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("all")).alias("spans"),
    )
