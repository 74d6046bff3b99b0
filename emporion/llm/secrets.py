"""Secret scan with a battery of randomness tests; Spark expressions only.

*Base kinds* are fixed patterns (``assign``, ``access``, ``hex``), leftmost
without overlap per kind.  Places come from the lengths of what ``split`` leaves
between matches and of what ``regexp_extract_all`` finds.

*Random strings* (kind ``random``): every run of 20 or more characters that
encodings use (``=`` only as padding at its end), and every part of 20 or more
between its ``/``, its ``-`` and ``_``, or all three, is a candidate; of those
found random the longest counts.  Each is given the smallest encoding that holds
it (hexadecimal, base32, base36, base62, base64).  Three tests ask whether its symbols could be uniform
draws: chi-squared uniformity over the encoding's alphabet, the number of runs
above and below the alphabet's middle, and the serial correlation of neighbours.
Fisher's method combines them to one p-value; identifiers and words get small
ones, keys do not.

*False-discovery control* is by length: in each stratum (encoding, length band)
Storey's estimate of the number of truly random strings (with its one more)
tells, for every threshold, what share of the strings above it is not random; the
lowest threshold with at most ``rate`` is used.  A stratum with few random
strings is also judged together with its neighbours (bands, then encodings), and
the lower threshold counts.  The strata are read from histograms over all
documents.

Every expression works on a text column, so rows keep all their columns and no
name can clash.  Defined results: a null text is empty; an empty text has no
span; repeated rows each get their row; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds, in order, and their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: runs of encoding characters with a digit, or with a small letter before a capital
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9]|[A-Z+/_-]*+[a-z][a-z+/_-]*+[A-Z])[A-Za-z0-9+/_-]{20,}+(?:=+(?![A-Za-z0-9+/_=-]))?"
#: the same of a part of a run
PART = r"^(?=[A-Za-z+/_-]*+[0-9]|[A-Z+/_-]*+[a-z][a-z+/_-]*+[A-Z])[A-Za-z0-9+/_-]{20,}+"
#: what may join words and a key in a run
JOINTS = ("/", "[-_]", "[/_-]")
# Encodings from the smallest alphabet up.
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", r"^[A-Z2-7]+=*$", UPPER + "234567"),
    ("base36", r"^[0-9a-z]+$", DIGITS + LOWER),
    ("BASE36", r"^[0-9A-Z]+$", DIGITS + UPPER),
    ("base62", r"^[0-9A-Za-z]+$", UPPER + LOWER + DIGITS),
    ("base64", r"^[0-9A-Za-z+/]+=*$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^[0-9A-Za-z_-]+=*$", UPPER + LOWER + DIGITS + "-_"),
)
#: lower ends of the length bands
BANDS = (20, 24, 32, 40, 48, 64, 96, 128, 256)
BINS = 100
#: with fewer strings of p >= 0.5 a stratum is judged with its neighbours too
FEW_KEYS = 10
SPAN = "struct<start: int, kind: int, end: int>"
MASK = "[SECRET]"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _places(text: Column, pattern: str, kind: int, extra: Column | None = None, least: int = 0) -> Column:
    """Spans of all matches; with ``extra`` (a column of group values) only
    those whose value has ``least`` characters."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.zip_with(F.split(text, pattern, -1), hits,
                       lambda gap, hit: F.struct(F.char_length(gap).alias("gap"), F.char_length(hit).alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + x["gap"]
        end = begin + F.coalesce(x["hit"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end")).cast(SPAN)
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(span)).alias("out"))

    # the last gap has no match after it
    spans = let(F.aggregate(sizes, start, step, lambda a: a["out"]), lambda s: F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))))
    if extra is None:
        return spans
    both = F.zip_with(spans, extra, lambda s, v: F.when(F.char_length(v) >= least, s))
    return F.filter(both, lambda s: s.isNotNull())


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds, by start, then kind."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.lower(text)
    named = F.lit(False)
    for w in ASSIGN_WORDS:
        named = named | F.contains(low, F.lit(w))
    assign = F.when(named, _places(text, ASSIGN, 1, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), 6)).otherwise(_none())
    access = F.when(F.contains(text, F.lit("AKIA")), _places(text, ACCESS, 2)).otherwise(_none())
    hexes = F.when(text.rlike(HEX), _places(text, HEX, 3)).otherwise(_none())
    return F.array_sort(F.concat(assign, access, hexes))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic approximation)."""
    return F.greatest(1 / (1 + F.exp(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(600.0)))), F.lit(1e-12))


def battery(symbols: Column, text: Column, k: Column) -> Column:
    """Combined p-value of symbol numbers (0 to k - 1) of the string ``text``."""
    n = F.size(symbols).cast("double")
    k = k.cast("double")
    squares = F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0),
                          lambda a, d: a + F.pow((F.char_length(text) - F.char_length(F.replace(text, d, F.lit("")))).cast("double"), F.lit(2.0)))
    chi = k * squares / n - n
    p1 = _tail((chi - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n)))
    nexts = F.slice(symbols, 2, F.greatest(F.size(symbols) - 1, F.lit(1)))
    pairs = F.slice(F.zip_with(symbols, nexts, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), 1, F.greatest(F.size(symbols) - 1, F.lit(1)))
    middle = (k - 1) / 2
    turns = F.aggregate(pairs, F.lit(0), lambda c, x: c + F.when((x["a"] > middle) != (x["b"] > middle), 1).otherwise(0))
    p2 = F.least(2 * _tail(F.abs((turns - (n - 1) / 2) / F.sqrt((n - 1) / 4))), F.lit(1.0))
    spread = (k * k - 1) / 12
    serial = F.aggregate(pairs, F.lit(0.0), lambda c, x: c + (x["a"] - middle) * (x["b"] - middle)) / spread
    p3 = F.least(2 * _tail(F.abs(serial / F.sqrt(n - 1))), F.lit(1.0))
    # Fisher: -2 * sum of logs is chi-squared with 6 degrees of freedom
    return let(-(F.log(p1) + F.log(p2) + F.log(p3)), lambda x: F.exp(-x) * (1 + x + x * x / 2))


def _parts(x: Column, joint: str) -> Column:
    """Parts (start, end, value) of the run ``x`` between ``joint`` characters."""
    kind = "struct<start: int, end: int, value: string>"
    start = F.struct(x["start"].alias("at"), F.array().cast(f"array<{kind}>").alias("out"))

    def step(a: Column, v: Column) -> Column:
        end = a["at"] + F.char_length(v)
        part = F.struct(a["at"].alias("start"), end.alias("end"), v.alias("value")).cast(kind)
        return F.struct((end + 1).alias("at"), F.when(v.rlike(PART), F.concat(a["out"], F.array(part))).otherwise(a["out"]).alias("out"))

    return F.aggregate(F.split(x["value"], joint, -1), start, step, lambda a: a["out"])


def candidates(text: Column) -> Column:
    """Array of (start, end, encoding, band, p) of the random-string candidates,
    runs and their parts."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    kind = "array<struct<start: int, end: int, encoding: string, band: int, p: double>>"
    spans = F.zip_with(_places(text, CANDIDATE, 4), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)),
                       lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), v.alias("value")))

    def encoded(x: Column) -> Column:
        name, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
        for e, pattern, letters in reversed(ENCODINGS):
            name = F.when(x["value"].rlike(pattern), e).otherwise(name)
            alphabet = F.when(x["value"].rlike(pattern), letters).otherwise(alphabet)
        band = F.lit(BANDS[0])
        for b in BANDS[1:]:
            band = F.when(x["end"] - x["start"] >= b, b).otherwise(band)
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), F.rtrim(x["value"], F.lit("=")).alias("value"),
                        name.alias("encoding"), alphabet.alias("alphabet"), band.alias("band"))

    def tested(x: Column) -> Column:
        symbols = F.transform(F.split(x["value"], ""), lambda c: F.instr(x["alphabet"], c) - 1)
        p = let(symbols, lambda s: battery(s, x["value"], F.char_length(x["alphabet"])))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["encoding"].alias("encoding"), x["band"].alias("band"), p.alias("p"))

    def with_parts(x: Column) -> Column:
        parts = F.array_distinct(F.concat(F.array(x), *(_parts(x, joint) for joint in JOINTS)))
        return F.when(x["value"].rlike("[/_-]"), parts).otherwise(F.array(x))

    spans = F.flatten(F.transform(spans, with_parts))
    known = F.filter(F.transform(spans, encoded), lambda x: x["encoding"].isNotNull() & (F.char_length(x["value"]) >= BANDS[0]))
    return F.when(text.rlike(CANDIDATE), F.transform(known, tested)).otherwise(F.array().cast(kind))


def _least(count: list[int], rate: float) -> int:
    """Least bin that counts as random in a histogram of p."""
    # Storey: p-values of random strings are uniform; one more keeps the estimate from being 0
    random = 2 * (sum(count[BINS // 2:]) + 1)
    for least in range(1, BINS // 2):
        above = sum(count[least:])
        if above - random * (1 - least / BINS) <= rate * above:
            return least
    return BINS // 2  # no more than half of ``random`` lie above


def thresholds(found: DataFrame, rate: float = 0.05) -> dict[tuple[str, int], int]:
    """Least bin of p that counts as random, per stratum, from the histogram of
    all candidates in ``found(candidates)``.  Strata are encodings x bands, a
    fixed number; one rule holds for all sizes."""
    one = found.select(F.explode("candidates").alias("c"))
    bins = (one.select("c.encoding", "c.band", F.least(F.floor(F.col("c.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"))
            .groupBy("encoding", "band", "bin").count().collect())  # at most 8 x 9 x 100 rows
    tables: dict[tuple[str, int], list[int]] = {}
    for r in bins:
        tables.setdefault((r["encoding"], r["band"]), [0] * BINS)[r["bin"]] = r["count"]
    out = {}
    for (encoding, band), count in tables.items():
        out[encoding, band] = _least(count, rate)
        # few keys: neighbouring bands, then encodings, until there are enough
        near = sorted(tables, key=lambda s: (s[0] != encoding, abs(BANDS.index(s[1]) - BANDS.index(band)), s))
        pool = [0] * BINS
        for s in near:
            if sum(pool[BINS // 2:]) >= FEW_KEYS:
                break
            pool = [a + b for a, b in zip(pool, tables[s])]
        out[encoding, band] = min(out[encoding, band], _least(pool, rate))
    return out


def all_spans(base: Column, found: Column, least: dict[tuple[str, int], int]) -> Column:
    """Base spans and the random strings beyond their stratum's threshold that
    touch no base span and lie in no longer one, by start, then kind."""
    if not least:
        return base
    limit = F.create_map(*[x for (e, b), v in sorted(least.items()) for x in (F.lit(f"{e}/{b}"), F.lit(v / BINS))])

    def good(x: Column) -> Column:
        clear = ~F.exists(base, lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"]))
        return F.coalesce(x["p"] >= limit[F.concat(x["encoding"], F.lit("/"), x["band"].cast("string"))], F.lit(False)) & clear

    def longest(some: Column) -> Column:
        return F.filter(some, lambda x: ~F.exists(some, lambda y: (y["start"] <= x["start"]) & (x["end"] <= y["end"])
                                                  & (y["end"] - y["start"] > x["end"] - x["start"])))

    more = F.transform(let(F.filter(found, good), longest), lambda x: F.struct(x["start"].alias("start"), F.lit(4).alias("kind"), x["end"].alias("end")).cast(SPAN))
    return F.array_sort(F.concat(base, more))


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"]), s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones once) replaced by ``MASK``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        piece = F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(MASK))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], piece).otherwise(a["out"]).alias("out"))

    whole = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def without_secrets(docs: DataFrame, **how) -> DataFrame:
    """``docs`` (all columns) with every secret in ``text`` masked; ``n_chars``,
    where there is one, follows the text."""
    text = F.col("text")
    least = thresholds(docs.select(candidates(text).alias("candidates")), **how)
    found = F.struct(base_spans(text).alias("base"), candidates(text).alias("candidates"))
    spans = let(found, lambda x: all_spans(x["base"], x["candidates"], least))
    clean = F.when(text.isNotNull(), let(spans, lambda s: masked(text, s)))
    out = docs.withColumn("text", clean)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(kind))
    return out
