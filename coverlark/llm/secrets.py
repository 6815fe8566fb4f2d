"""Secret scans by a battery of randomness tests, in built-in functions only (operator 8).

Base spans come from three patterns and always stay. Every base value, and every other run of at least 20 characters of
the alphabets in which keys are written, is tested: its encoding is inferred from its characters, and three tests ask
whether it could be drawn uniformly from that alphabet, chi-squared over all its symbols, Wald-Wolfowitz runs about the
alphabet's middle, and serial correlation of neighbours. The least p-value counts three times over.

A secret looks random, so a high p-value speaks for it. How often ordinary text reaches it is measured, not assumed:
every document gives one string of each length band that has a candidate, cut from its letters and digits outside all
candidates at a place chosen by a hash, and these go through the same tests. A candidate's level is the share of such strings of its band and
encoding (of its band, where an encoding has under ``LEAST_ORDINARY``) that look at least as random. Benjamini-Hochberg
on these levels, by length band, encoding and origin, decides which are called random, so that at most ``FALSE_RATE`` of
them are ordinary. Short strings need high p-values, for much ordinary text reaches low ones; long strings need little.

Positions come from the lengths of the pieces between matches. The driver holds histograms of p-values by band, encoding
and origin: a fixed number of counts, whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import materialize, only, table, text_or_empty

#: Kinds in order with pattern, capturing group that is measured, and its least length.
KINDS = {
    "assign": (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
}
LOOSE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
#: Encodings in the order of trial: the pattern of the whole string and the alphabet in order.
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = {
    "decimal": ("^[0-9]+$", DIGITS),
    "hex": ("^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef"),
    "lower26": ("^[a-z]+$", LOWER),
    "upper26": ("^[A-Z]+$", UPPER),
    "base32": ("^[A-Z2-7]+$", UPPER + "234567"),
    "upper36": ("^[A-Z0-9]+$", UPPER + DIGITS),
    "lower36": ("^[a-z0-9]+$", LOWER + DIGITS),
    "base62": ("^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    "base64": ("^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    "base64url": ("^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    "mixed": ("", UPPER + LOWER + DIGITS + "+/-_.="),
}
#: Least lengths of the bands; shorter base values are in band 0, whose ordinary strings have SHORTEST characters.
LENGTH_BANDS = (20, 24, 32, 40, 48, 64, 96, 128)
SHORTEST = 6
FALSE_RATE = 0.1
BINS = 200
LEAST_ORDINARY = 1000
#: Where a tested string is from: a base kind, a loose run, or ordinary text.
ORIGINS = (*KINDS, "random", "ordinary")


def erfc(z: Column) -> Column:
    """The complementary error function (Abramowitz and Stegun 7.1.26, absolute error below 1.5e-7)."""
    x = F.abs(z)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = poly * F.exp(-x * x)
    return F.when(z < 0, 2 - tail).otherwise(tail)


def _normal_p(z: Column) -> Column:
    return erfc(F.abs(z) / F.sqrt(F.lit(2.0)))


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, x: s + x)


def _spans(kind: str, least: int) -> Column:
    """array<struct(start, end, hit)> of the matches whose measured group has ``least`` characters, from their gaps."""
    none = F.expr("cast(array() as array<struct<start:int,end:int,hit:string>>)")
    zipped = F.arrays_zip(f"{kind}_gap", f"{kind}_hit", f"{kind}_value")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x[f"{kind}_gap"])
        end = start + F.coalesce(F.char_length(x[f"{kind}_hit"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), x[f"{kind}_value"].alias("hit"))
        spans = F.when(F.char_length(x[f"{kind}_value"]) >= least, F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    found = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(F.col(f"{kind}_any"), found).otherwise(none)


def _then(array: Column, *steps) -> Column:
    """Apply steps to each struct of an array. Each step gives named columns that later steps see, so none is computed twice."""

    def each(step):
        return lambda x: F.struct(*[c.alias(name) for name, c in step(x).items()])

    for step in steps:
        array = F.transform(array, each(step))
    return array


KEPT = ("start", "end", "origin", "name", "band", "id", "n", "alphabet")


def _encoding(x: Column) -> dict[str, Column]:
    name = F.lit("mixed")
    for encoding, (pattern, _) in reversed([*ENCODINGS.items()][:-1]):
        name = F.when(x["hit"].rlike(pattern), F.lit(encoding)).otherwise(name)
    band = sum((F.when(F.char_length(x["hit"]) >= b, 1).otherwise(0) for b in LENGTH_BANDS), F.lit(0))
    return {"start": x["start"], "end": x["end"], "origin": x["origin"], "hit": x["hit"], "name": name, "band": band}


def _symbols(x: Column) -> dict[str, Column]:
    alphabets = F.create_map(*[F.lit(v) for name, (_, letters) in ENCODINGS.items() for v in (name, letters)])
    shown = F.when(x["name"] == "hex", F.lower(x["hit"])).otherwise(x["hit"])
    keep = {name: x[name] for name in ("start", "end", "origin", "name", "band")}
    return keep | {"id": F.xxhash64(x["hit"]), "n": F.char_length(x["hit"]).cast("double"), "letters": alphabets[x["name"]], "signs": F.split(shown, "")}


def _values(x: Column) -> dict[str, Column]:
    keep = {name: x[name] for name in ("start", "end", "origin", "name", "band", "id", "n")}
    return keep | {"alphabet": F.char_length(x["letters"]).cast("double"), "values": F.transform(x["signs"], lambda c: (F.instr(x["letters"], c) - 1).cast("double"))}


def _counted(x: Column) -> dict[str, Column]:
    """Squares of the symbols' counts from the sorted values: the r-th of equal ones adds 2 r - 1."""
    step = lambda acc, v: F.struct(v.alias("v"), F.when(acc["v"] == v, acc["r"] + 2).otherwise(1.0).alias("r"), (acc["sum"] + F.when(acc["v"] == v, acc["r"] + 2).otherwise(1.0)).alias("sum"))
    start = F.struct(F.lit(-2.0).alias("v"), F.lit(0.0).alias("r"), F.lit(0.0).alias("sum"))
    half, last = x["alphabet"] / 2, x["n"].cast("int") - 1
    return {name: x[name] for name in (*KEPT, "values")} | {
        "squares": F.aggregate(F.array_sort(x["values"]), start, step, lambda acc: acc["sum"]),
        "above": _sum(F.transform(x["values"], lambda v: F.when(v >= half, 1.0).otherwise(0.0))),
        "mean": _sum(x["values"]) / x["n"],
        "behind": F.slice(x["values"], F.lit(1), last),
        "ahead": F.slice(x["values"], F.lit(2), last),
    }


def _sums(x: Column) -> dict[str, Column]:
    half, mean = x["alphabet"] / 2, x["mean"]
    return {name: x[name] for name in (*KEPT, "squares")} | {
        "both": 2 * x["above"] * (x["n"] - x["above"]),
        "runs": 1 + _sum(F.zip_with(x["behind"], x["ahead"], lambda a, b: F.when((a >= half) != (b >= half), 1.0).otherwise(0.0))),
        "power": _sum(F.transform(x["values"], lambda v: (v - mean) * (v - mean))),
        "product": _sum(F.zip_with(x["behind"], x["ahead"], lambda a, b: (a - mean) * (b - mean))),
    }


def _p_value(x: Column) -> dict[str, Column]:
    """The least of three p-values, three times over, at most 1.

    Chi-squared has k - 1 degrees of freedom, scaled to its exact variance for n symbols, with the cube-root approximation
    of Wilson and Hilferty; runs and serial correlation have two normal tails.
    """
    n, both = x["n"], x["both"]
    degrees = (x["alphabet"] - 1) * n / (n - 1)
    chi = (x["alphabet"] * x["squares"] / n - n) * n / (n - 1)
    z = (F.pow(chi / degrees, F.lit(1 / 3)) - 1 + 2 / (9 * degrees)) / F.sqrt(2 / (9 * degrees))
    p_chi = erfc(z / F.sqrt(F.lit(2.0))) / 2
    spread = both * (both - n) / (n * n * (n - 1))
    p_runs = F.when(spread > 0, _normal_p((x["runs"] - both / n - 1) / F.sqrt(spread))).otherwise(0.0)
    p_serial = F.when(x["power"] > 0, _normal_p((x["product"] / x["power"] + 1 / n) * F.sqrt(n))).otherwise(0.0)
    return {name: x[name] for name in ("start", "end", "origin", "name", "band", "id")} | {"p": F.least(F.lit(1.0), 3 * F.least(p_chi, p_runs, p_serial))}


#: The tests of a string, step by step.
BATTERY = (_encoding, _symbols, _values, _counted, _sums, _p_value)


def _ordinary(plain: str, bands: list[int]) -> Column:
    """One string of each of the length bands from the letters and digits of ``plain``, at places chosen by a hash."""
    size = F.char_length(plain)
    cut = lambda n: F.substr(F.col(plain), 1 + F.pmod(F.xxhash64(plain, F.lit(n)), F.greatest(size - n + 1, F.lit(1))).cast("int"), F.lit(n))
    strings = [F.when(size >= n, F.struct(F.lit(0).alias("start"), F.lit(n).alias("end"), cut(n).alias("hit"), F.lit("ordinary").alias("origin"))) for n in [(SHORTEST, *LENGTH_BANDS)[b] for b in bands]]
    return F.filter(F.array(*strings), lambda s: s.isNotNull())


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base spans by kind (arrays of start, end, hit) and tested strings (start, end, origin, name, band, id, p) of every text."""
    patterns = {kind: (p, g, n) for kind, (p, g, n) in KINDS.items()} | {"loose": (LOOSE, 0, 20)}
    text = F.col("text")
    rows = only(docs, ["doc_id", "text"]).select("doc_id", text_or_empty().alias("text"))
    rows = rows.select("*", *[text.rlike(p).alias(f"{kind}_any") for kind, (p, _, _) in patterns.items()])
    split = []
    for kind, (p, group, _) in patterns.items():
        there = F.col(f"{kind}_any")
        split += [
            F.when(there, F.split(text, p, -1)).alias(f"{kind}_gap"),
            F.when(there, F.regexp_extract_all(text, F.lit(p), F.lit(0))).alias(f"{kind}_hit"),
            F.when(there, F.regexp_extract_all(text, F.lit(p), F.lit(group))).alias(f"{kind}_value"),
        ]
    rows = rows.select("doc_id", "text", *[f"{kind}_any" for kind in patterns], *split)
    rows = rows.select("doc_id", *[_spans(kind, least).alias(kind) for kind, (_, _, least) in patterns.items()])
    taken = lambda s: F.exists(F.concat(*[F.col(k) for k in KINDS]), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    of = lambda array, origin: F.transform(array, lambda s: F.struct(s["start"], s["end"], s["hit"], F.lit(origin).alias("origin")))
    strings = F.concat(*[of(F.col(kind), kind) for kind in KINDS], of(F.filter("loose", lambda s: ~taken(s)), "random"))
    return rows.select("doc_id", *KINDS, _then(strings, *BATTERY).alias("tested"))


def ordinary_strings(docs: DataFrame, bands: list[int]) -> DataFrame:
    """tested, as of ``scan``, of strings of the length bands from each text outside all loose runs."""
    text = F.col("text")
    rows = only(docs, ["text"]).select(text_or_empty().alias("text"))
    outside = F.when(text.rlike(LOOSE), F.array_join(F.split(text, LOOSE, -1), " ")).otherwise(text)
    rows = rows.select(F.regexp_replace(outside, "[^A-Za-z0-9]+", "").alias("plain"))
    return rows.select(_then(_ordinary("plain", bands), *BATTERY).alias("tested"))


def least_bin(own: list[int], ordinary: list[int], false_rate: float = FALSE_RATE) -> int | None:
    """Benjamini-Hochberg over binned p-values: the least bin from which on strings are called random, or None.

    The level of a bin is (1 + ordinary strings in it or above) / (1 + all ordinary strings).
    """
    every, all_ordinary = sum(own), sum(ordinary)
    above = over = 0
    found = None
    for at in range(BINS - 1, -1, -1):
        above, over = above + own[at], over + ordinary[at]
        if own[at] and (1 + over) / (1 + all_ordinary) <= false_rate * above / every:
            found = at
    return found


def _bin(p: str) -> Column:
    return F.least(F.floor(F.col(p) * BINS), F.lit(BINS - 1)).cast("int")


def _counts(scanned: DataFrame) -> dict[tuple[str, str, int], list[int]]:
    """By origin, encoding and band how many distinct strings have their p-value in each bin."""
    # Not explode, for which the planner adds a filter that works out the whole array once more.
    x = scanned.select(F.explode_outer("tested").alias("x")).where("x is not null").select("x.origin", "x.name", "x.band", "x.id", _bin("x.p").alias("bin"))
    counts: dict[tuple[str, str, int], list[int]] = {}
    for origin, name, band, at, n in x.distinct().groupBy("origin", "name", "band", "bin").count().collect():
        counts.setdefault((origin, name, band), [0] * BINS)[at] += n
    return counts


def least_bins(scanned: DataFrame, docs: DataFrame, false_rate: float = FALSE_RATE) -> dict[str, int]:
    """By ``origin/encoding/band`` the bin of p-values from which on a string is called random; families without one are left out.

    A string that occurs often counts once. Ordinary strings are drawn from ``docs`` for the bands that have a candidate, and for no others.
    """
    counts = _counts(scanned)
    if bands := sorted({band for _, _, band in counts}):
        counts |= _counts(ordinary_strings(docs, bands))
    ordinary = {(name, band): n for (origin, name, band), n in counts.items() if origin == "ordinary"}
    of_band: dict[int, list[int]] = {}
    for (_, band), n in ordinary.items():
        of_band[band] = [a + b for a, b in zip(of_band.get(band, [0] * BINS), n, strict=True)]
    found = {}
    for (origin, name, band), own in counts.items():
        if origin != "ordinary":
            null = ordinary.get((name, band), [])
            at = least_bin(own, null if sum(null) >= LEAST_ORDINARY else of_band.get(band, [0] * BINS), false_rate)
            if at is not None:
                found[f"{origin}/{name}/{band}"] = at
    return found


def find_secrets(docs: DataFrame, false_rate: float = FALSE_RATE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_tested, n_confirmed, n_random, base_sha256, spans and tests for every row of ``docs``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start, then kind in the order assign, access, hex,
    random; those of the kind random are the loose runs that are called random. n_tested counts tested strings,
    n_confirmed base values that are called random too. tests has ``kind:start:end:encoding:p:decision`` of each, with
    decision 1 for random. Null and empty texts have none; their base_sha256 is that of the empty string. Very long texts
    and strings are tested whole. Ties share a bin and a decision. Repeated rows repeat; a string counts once for the
    false-discovery control. An empty table gives no rows.
    """
    scanned = materialize(scan(docs), "secrets")
    limit = least_bins(scanned, docs, false_rate)
    known = F.create_map(*[F.lit(x) for pair in limit.items() for x in pair]) if limit else F.lit(None).cast("map<string,int>")

    def judged(s: Column) -> Column:
        at = F.coalesce(known[F.concat_ws("/", s["origin"], s["name"], s["band"].cast("string"))], F.lit(BINS))
        called = F.least(F.floor(s["p"] * BINS), F.lit(BINS - 1)) >= at
        rank = F.array_position(F.array(*[F.lit(o) for o in ORIGINS]), s["origin"]).cast("int") - 1
        place = F.concat_ws(":", s["origin"], s["start"].cast("string"), s["end"].cast("string"))
        return F.struct(s["start"], rank.alias("rank"), place.alias("said"), F.concat_ws(":", place, s["name"], F.format_string("%.6f", s["p"]), called.cast("int").cast("string")).alias("test"), called.alias("called"))

    joined = lambda array, name: F.array_join(F.transform(F.array_sort(array), lambda s: s[name]), ",")
    judgements = F.transform("tested", judged)
    rows = scanned.select("doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS], judgements.alias("_tested"))
    is_base = lambda s: s["rank"] < len(KINDS)
    counted = lambda f: F.size(F.filter("_tested", f)).cast("long")
    return rows.select(
        "doc_id",
        *[f"n_{kind}" for kind in KINDS],
        F.size("_tested").cast("long").alias("n_tested"),
        counted(lambda s: is_base(s) & s["called"]).alias("n_confirmed"),
        counted(lambda s: ~is_base(s) & s["called"]).alias("n_random"),
        F.sha2(joined(F.filter("_tested", is_base), "said"), 256).alias("base_sha256"),
        joined(F.filter("_tested", lambda s: is_base(s) | s["called"]), "said").alias("spans"),
        joined(F.col("_tested"), "test").alias("tests"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
