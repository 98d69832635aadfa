"""Secret scans in DataFrame functions only: fixed patterns and a randomness test battery.

Fixed patterns give the kinds ``assign``, ``access`` and ``hex``. Further spans, of kind ``random``,
come from unbroken tokens of 20 or more credential characters that no fixed pattern touches; ``=`` cuts tokens unless it ends them:

1. The token's encoding is inferred from its characters (hex, lower or upper case with digits, base64).
   Tokens of letters only, or of digits only, have none and are no candidates, and nor are those of one
   case with separators (``+ / _ - =``) that have fewer than ``BODY_CHARS`` letters and digits.
2. Three tests ask whether the token looks drawn at random from that alphabet: chi-squared uniformity
   over cells of the alphabet that expect five characters or more, a runs test about the middle of the
   alphabet, and serial correlation at lag one. Their smallest p-value, times three, is the token's.
   Tokens of one case with separators are tested without these, and by a fourth test, of the share of
   digits, as words set apart by separators have few; parts between separators that are tokens by
   themselves are tested too, and the greatest p-value is the token's.
3. Tokens are told apart from random ones by the Benjamini-Hochberg rule at ``FDR``, within strata of
   encoding and length, over all documents: of the tokens rejected in a stratum, at most that share is
   expected to be random. What is not rejected is reported.

The rule needs counts of p-values per stratum only, rounded up to ``BINS`` steps per factor of ten;
that table has at most a few thousand rows whatever the input.

Spans are in code points, the end exclusive. Defined cases: a null text is empty and has no spans;
repeated rows have the same spans; a null id stays null; an empty table gives an empty result;
further columns are ignored by ``secrets`` and kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwright.session import settle

ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_CHARS = 6
# A greedy run that is long enough is the same match as the run without the bound.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN_CHARS = 20
# What stands between '=' of a run that is long enough; only '=' at the end of the run belongs to it.
TOKEN = (
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_=-]{20})[A-Za-z0-9+/_-]+(?:=+(?![A-Za-z0-9+/_=-]))?"
)
BODY_CHARS = 16
_LONG = r"[A-Za-z0-9+/_=-]{20}"
KINDS = ("assign", "access", "hex", "random")
FDR = 0.05
BINS, DECADES = 8, 12
MASK = "[SECRET]"

_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_ALPHABETS = {
    "hex": _DIGITS + _LOWER[:6],
    "HEX": _DIGITS + _LOWER[:6].upper(),
    "lower": _DIGITS + _LOWER,
    "upper": _DIGITS + _LOWER.upper(),
    "base64": _LOWER.upper() + _LOWER + _DIGITS + "+/-_",
}
# One case with separators: the alphabet of what is between them.
_ALPHABETS |= {f"{kind}-": _ALPHABETS[kind] for kind in ("hex", "HEX", "lower", "upper")}
_SEPARATORS = "[+/_=-]+"

_SPANS = "array<struct<start:int,rank:int,end:int>>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _found(text: Column, pattern: str, rank: int, fits=None) -> Column:
    """Spans of the non-overlapping matches from the left, as ``(start, rank, end)``.

    The text between matches and the matches alternate, so their lengths give the positions.
    ``fits`` chooses among the matches, by index, after all have been placed.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    steps = F.arrays_zip(
        F.transform(hits, lambda h: F.char_length(h)).alias("hit"),
        F.transform(gaps, lambda g: F.char_length(g)).alias("gap"),
    )
    begin = F.struct(
        F.lit(0).alias("at"), F.expr(f"cast(array() as {_SPANS})").alias("spans")
    )

    def place(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + step["hit"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        spans = F.when(step["hit"].isNull(), state["spans"]).otherwise(
            F.concat(state["spans"], F.array(span))
        )
        return F.struct(F.coalesce(end, start).alias("at"), spans.alias("spans"))

    placed = F.aggregate(steps, begin, place)["spans"]
    return placed if fits is None else _let(fits, lambda ok: F.filter(placed, lambda s, i: ok[i]))


def _none() -> Column:
    return F.expr(f"cast(array() as {_SPANS})")


def _base_spans(text: Column) -> Column:
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long_enough = F.transform(values, lambda v: F.char_length(v) >= ASSIGN_CHARS)
    assign = F.when(text.rlike(ASSIGN), _found(text, ASSIGN, 0, long_enough)).otherwise(_none())
    access = F.when(F.contains(text, F.lit("AKIA")), _found(text, ACCESS, 1)).otherwise(_none())
    hexes = F.when(text.rlike(HEX), _found(text, HEX, 2)).otherwise(_none())
    return F.array_sort(F.concat(assign, access, hexes))


def _encoding(token: Column) -> Column:
    digit, lower, upper = (token.rlike(p) for p in ("[0-9]", "[a-z]", "[A-Z]"))
    plain = ~token.rlike("[+/_=-]")
    body = F.char_length(F.regexp_replace(token, _SEPARATORS, "")) >= BODY_CHARS
    return (
        F.when(plain & digit & token.rlike("^[0-9a-f]+$") & lower, "hex")
        .when(plain & digit & token.rlike("^[0-9A-F]+$") & upper, "HEX")
        .when(plain & digit & lower & ~upper, "lower")
        .when(plain & digit & upper & ~lower, "upper")
        .when(digit & lower & upper & token.rlike("^[^=]+=*$"), "base64")
        .when(body & digit & lower & ~upper & token.rlike("^[0-9a-f+/_=-]+$"), "hex-")
        .when(body & digit & upper & ~lower & token.rlike("^[0-9A-F+/_=-]+$"), "HEX-")
        .when(body & digit & lower & ~upper, "lower-")
        .when(body & digit & upper & ~lower, "upper-")
    )


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, by a logistic curve within 0.0002."""
    return 1 / (1 + F.exp(F.least(F.lit(60.0), 1.5976 * z + 0.070565992 * z * z * z)))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z)))


def _uniformity(codes: Column, n: Column, size: Column) -> Column:
    """p-value of the chi-squared test over equal cells of the alphabet."""
    cells = F.greatest(F.lit(2), F.least(size, (n / 5).cast("int")))

    def squares(cells: Column) -> Column:
        counts = F.transform(
            F.sequence(F.lit(0), cells - 1),
            lambda c: F.size(F.filter(codes, lambda x: F.floor(x * cells / size) == c)),
        )
        # Cells of unequal width when the alphabet isn't a multiple of them: expect their share.
        shares = F.transform(
            F.sequence(F.lit(0), cells - 1),
            lambda c: (F.ceil((c + 1) * size / cells) - F.ceil(c * size / cells)) / size,
        )
        parts = F.zip_with(counts, shares, lambda k, p: (k - n * p) * (k - n * p) / (n * p))
        chi = F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)
        df = (cells - 1).cast("double")
        spread = 2 / (9 * df)
        return _upper_tail((F.cbrt(chi / df) - (1 - spread)) / F.sqrt(spread))

    return _let(cells, squares)


def _runs(codes: Column, n: Column, size: Column) -> Column:
    """p-value of the runs test about the middle of the alphabet."""
    high = F.transform(codes, lambda x: (2 * x >= size).cast("int"))

    def test(bits: Column) -> Column:
        ones = F.aggregate(bits, F.lit(0), lambda total, b: total + b).cast("double")
        zeros = n - ones
        runs = 1 + F.aggregate(
            F.zip_with(
                F.slice(bits, F.lit(1), F.size(bits) - 1),
                F.slice(bits, F.lit(2), F.size(bits) - 1),
                lambda a, b: (a != b).cast("int"),
            ),
            F.lit(0),
            lambda total, b: total + b,
        )
        both = 2 * ones * zeros
        variance = both * (both - n) / (n * n * (n - 1))
        z = (runs - both / n - 1) / F.sqrt(F.greatest(variance, F.lit(1e-9)))
        return F.when((ones == 0) | (zeros == 0), F.lit(0.0)).otherwise(_two_sided(z))

    return _let(high, test)


def _serial(codes: Column, n: Column, size: Column) -> Column:
    """p-value of the correlation of each character's code with the next one's."""
    mean = F.aggregate(codes, F.lit(0.0), lambda total, x: total + x) / n

    def test(mean: Column) -> Column:
        spread = F.aggregate(codes, F.lit(0.0), lambda total, x: total + (x - mean) * (x - mean))
        products = F.zip_with(
            F.slice(codes, F.lit(1), F.size(codes) - 1),
            F.slice(codes, F.lit(2), F.size(codes) - 1),
            lambda a, b: (a - mean) * (b - mean),
        )
        shared = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
        z = (shared / F.greatest(spread, F.lit(1e-9)) + 1 / n) * F.sqrt(n)
        return F.when(spread == 0, F.lit(0.0)).otherwise(_two_sided(z))

    return _let(mean, test)


def _digit_share(codes: Column, n: Column, size: Column) -> Column:
    """p-value of the number of digits, which are the first ten of the alphabet."""
    digits = F.size(F.filter(codes, lambda x: x < 10))
    share = 10 / size
    return _two_sided((digits - n * share) / F.sqrt(n * share * (1 - share)))


def randomness(token: Column, encoding: Column) -> Column:
    """The p-value of a token, given the name of its encoding: its parts count if they are tokens."""
    parts = F.filter(F.split(token, _SEPARATORS), lambda t: F.char_length(t) >= TOKEN_CHARS)
    values = F.transform(parts, lambda t: _battery(t, _encoding(t)))
    whole = _battery(token, encoding)
    return F.when(encoding.endswith("-"), F.greatest(whole, F.array_max(values))).otherwise(whole)


def _battery(token: Column, encoding: Column) -> Column:
    """The battery's p-value of a token, given the name of its encoding."""
    separated = encoding.endswith("-")
    alphabet = F.element_at(
        F.create_map(*[F.lit(x) for pair in _ALPHABETS.items() for x in pair]), encoding
    )

    def battery(body: Column) -> Column:
        codes = F.transform(
            F.sequence(F.lit(1), F.char_length(body)),
            lambda i: F.call_function("locate", F.substring(body, i, F.lit(1)), alphabet) - 1,
        )
        n, size = F.char_length(body), F.char_length(alphabet)
        return _let(
            codes,
            lambda x: F.least(
                F.lit(1.0),
                F.when(separated, 4).otherwise(3)
                * F.least(
                    _uniformity(x, n, size),
                    _runs(x, n, size),
                    _serial(x, n, size),
                    F.when(separated, _digit_share(x, n, size)).otherwise(1.0),
                ),
            ),
        )

    ends = F.regexp_replace(token, "=+$", "")
    return _let(F.when(separated, F.regexp_replace(token, _SEPARATORS, "")).otherwise(ends), battery)


def _stratum(encoding: Column, length: Column) -> Column:
    """Encoding and the length to the next lower power of the square root of two."""
    return F.concat(encoding, F.lit(":"), F.floor(F.log2(length) * 2).cast("string"))


def _bin(p: Column) -> Column:
    """Step on a logarithmic scale whose upper edge is at or above p; step 0 ends at 1."""
    return F.least(F.lit(BINS * DECADES), F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * BINS)).cast("int")


def _candidates(text: Column, base: Column) -> Column:
    """Tokens apart from base spans, with encoding, stratum and p-value."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))

    def judge(spans: Column, tokens: Column) -> Column:
        rows = F.zip_with(
            spans,
            tokens,
            lambda s, t: F.struct(s.alias("span"), t.alias("token"), _encoding(t).alias("encoding")),
        )
        free = F.filter(
            rows,
            lambda r: r["encoding"].isNotNull()
            & (F.char_length(r["token"]) >= TOKEN_CHARS)
            & ~F.exists(base, lambda b: (b["start"] < r["span"]["end"]) & (r["span"]["start"] < b["end"])),
        )
        return F.transform(
            free,
            lambda r: F.struct(
                r["span"].alias("span"),
                _stratum(r["encoding"], F.char_length(r["token"])).alias("stratum"),
                _bin(randomness(r["token"], r["encoding"])).alias("bin"),
            ),
        )

    empty = F.expr(
        "cast(array() as array<struct<span:struct<start:int,rank:int,end:int>,stratum:string,bin:int>>)"
    )
    return F.when(text.rlike(_LONG), judge(_found(text, TOKEN, 3), tokens)).otherwise(empty)


def _scanned(docs: DataFrame, *columns: Column) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*columns, text.alias("text")).withColumn("base", _base_spans(F.col("text")))
    return rows.withColumn("tokens", _candidates(F.col("text"), F.col("base")))


def rejected_bins(scanned: DataFrame, fdr: float = FDR) -> DataFrame:
    """``stratum, least``: tokens in bins from ``least`` up are rejected. From all candidates."""
    counts = (
        scanned.select(F.explode("tokens").alias("t"))
        .groupBy("t.stratum", "t.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    strongest = Window.partitionBy("stratum").orderBy(F.col("bin").desc())
    ranked = counts.withColumn(
        "seen", F.sum("n").over(strongest.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("all", F.sum("n").over(Window.partitionBy("stratum")))
    edge = F.pow(F.lit(10.0), -F.col("bin") / BINS)
    return (
        ranked.filter(F.col("all") * edge <= fdr * F.col("seen"))
        .groupBy("stratum")
        .agg(F.min("bin").alias("least"))
    )


def _decided(scanned: DataFrame, bounds: DataFrame) -> DataFrame:
    """Adds ``spans``: base spans and the tokens that are not rejected."""
    # Strata are encodings times powers of a text length: at most a few hundred rows.
    table = bounds.agg(
        F.map_from_entries(F.collect_list(F.struct("stratum", "least"))).alias("bounds")
    )
    least = lambda t: F.coalesce(F.element_at("bounds", t["stratum"]), F.lit(1 << 20))
    random = F.transform(F.filter("tokens", lambda t: t["bin"] < least(t)), lambda t: t["span"])
    return (
        scanned.withColumn("bounds", table.scalar())
        .withColumn("spans", F.array_sort(F.concat("base", random)))
        .drop("bounds")
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", kinds[s["rank"]], s["start"].cast("string"), s["end"].cast("string")),
        ),
    )


def secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """``doc_id``, the ``base`` spans and all ``spans`` of every document."""
    scanned = settle(_scanned(docs, F.col("doc_id")).drop("text"), "secret-candidates")
    return _decided(scanned, settle(rejected_bins(scanned, fdr), "strata")).select(
        "doc_id", "base", "spans"
    )


def redact(docs: DataFrame, fdr: float = FDR, mask: str = MASK) -> DataFrame:
    """The documents with every span replaced by ``mask``; all rows and columns stay."""
    names = docs.columns
    row = F.struct(*[F.col(f"`{n}`") for n in names])
    scanned = _scanned(docs, row.alias("row"))
    bounds = settle(rejected_bins(scanned.select("tokens"), fdr), "strata")
    decided = _decided(scanned, bounds)
    cut = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("text"), F.lit(0).alias("at")),
        lambda state, s: F.when(s["end"] <= state["at"], state).otherwise(
            F.struct(
                F.concat(
                    state["text"],
                    F.when(
                        s["start"] >= state["at"],
                        F.concat(
                            F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"]),
                            F.lit(mask),
                        ),
                    ).otherwise(F.lit("")),
                ).alias("text"),
                s["end"].alias("at"),
            )
        ),
        lambda state: F.concat(
            state["text"], F.substring(F.col("text"), state["at"] + 1, F.char_length("text"))
        ),
    )
    text = F.when(F.size("spans") > 0, cut).otherwise(F.col("row").getField("text"))
    return decided.select(
        *[text.alias(n) if n == "text" else F.col("row").getField(n).alias(n) for n in names]
    )
