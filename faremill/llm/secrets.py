"""Secret scans on Spark's own functions: fixed patterns and a battery of randomness tests.

The patterns find what names itself. The battery looks at the other long tokens. From a
token's characters it infers the encoding (base 32, base 64 or its URL form) and
tests the symbols: chi-squared for uniform use of the alphabet, runs above and below its
middle, lag-one serial correlation, and changes between character classes. A random token
passes the first three; ordinary identifiers and words fail. How likely an ordinary token
of the same length would look as random is its p-value, and discoveries are controlled at
a false-discovery rate within each band of lengths over the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])"
KINDS = ("assign", "access", "hex", "random")

BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
BASE64_URL = BASE64[:-2] + "-_"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass(frozen=True)
class Battery:
    """Parameters of the tests.

    rate: false-discovery rate; most_z: beyond this a test of randomness rejects;
    coincidence, cubes: sums of squared and of cubed symbol shares of ordinary tokens;
    changes: how often ordinary tokens change between upper case, lower case, digits and
    signs; bands: where the bands of lengths begin.
    """

    rate: float = 0.01
    most_z: float = 3.3
    coincidence: float = 0.055
    cubes: float = 0.006
    changes: float = 0.2
    bands: tuple[int, ...] = (20, 32, 48, 96)


SPAN = "array<struct<start:int,end:int>>"
_STEP = 20  # histogram bins for each power of ten


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches of a pattern that do not overlap, in text order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def let(value: Column, then) -> Column:
    """then(value), with the value computed once for a row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def places(hits: Column, pieces: Column) -> Column:
    """Start and end of each match in characters, from the matches and what lies between."""

    def step(state: Column, i: Column) -> Column:
        start = state["at"] + F.length(F.element_at(pieces, i))
        end = start + F.length(F.element_at(hits, i))
        found = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.concat(state["out"], found).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.size(hits)), zero, step, lambda s: s["out"])


def placed(text: Column, pattern: str, maybe: Column) -> Column:
    """(start, end, match) of each match. maybe: a cheap test that holds wherever there is one."""

    def given(hits: Column) -> Column:
        spans = let(
            F.struct(hits.alias("hits"), F.split(text, pattern, -1).alias("pieces")),
            lambda x: F.zip_with(
                x["hits"],
                places(x["hits"], x["pieces"]),
                lambda hit, at: F.struct(
                    at["start"].alias("start"), at["end"].alias("end"), hit.alias("hit")
                ),
            ),
        )
        return F.when(F.size(hits) > 0, spans)

    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    return F.coalesce(F.when(maybe, let(matches(text, pattern), given)), none)


def spans_of(found: Column) -> Column:
    return F.transform(
        found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))
    )


def tail(z: Column) -> Column:
    """Chance that a standard normal value is above z (a logistic form, within 1e-4 up to 4)."""
    return 1 / (1 + F.exp(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(500.0))))


def infer(token: Column) -> Column:
    """The alphabet of the narrowest encoding that holds the token; null if there is none."""
    mixed = token.rlike("[A-Z]") & token.rlike("[a-z]") & token.rlike("[0-9]")
    return (
        F.when(token.rlike("^[A-Z2-7]+$") & token.rlike("[2-7]"), BASE32)
        .when(mixed & token.rlike("^[A-Za-z0-9+/]+$"), BASE64)
        .when(mixed & token.rlike("^[A-Za-z0-9_-]+$"), BASE64_URL)
    )


def symbols_of(bare: Column, alphabet: Column) -> Column:
    """Length, alphabet size, symbol values, squared counts and class changes of a token."""
    squares = F.aggregate(
        F.array_sort(F.split(bare, "")),
        F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0.0).alias("sum")),
        lambda s, c: F.struct(
            c.alias("last"),
            F.when(c == s["last"], s["run"] + 1).otherwise(1).alias("run"),
            (s["sum"] + F.when(c == s["last"], 2 * s["run"] + 1).otherwise(1)).alias("sum"),
        ),
        lambda s: s["sum"],
    )
    classes = bare
    for pattern, sign in (("[A-Z]+", "\u0001"), ("[a-z]+", "\u0002"), ("[0-9]+", "\u0003")):
        classes = F.regexp_replace(classes, pattern, sign)
    return F.struct(
        F.length(bare).cast("double").alias("n"),
        F.length(alphabet).cast("double").alias("k"),
        F.transform(
            F.split(bare, ""), lambda c: (F.position(c, alphabet) - 1).cast("double")
        ).alias("values"),
        squares.alias("squares"),
        (F.length(classes) - 1).cast("double").alias("changes"),
    )


def sums_of(s: Column) -> Column:
    """What the runs and serial tests need, from the symbols of a token."""
    count = F.size(s["values"]) - 1
    nexts = F.zip_with(
        F.slice(s["values"], 1, count),
        F.slice(s["values"], 2, count),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    middle = s["k"] / 2
    mean = (s["k"] - 1) / 2  # of a uniform symbol
    turned = F.filter(nexts, lambda p: (p["a"] >= middle) != (p["b"] >= middle))
    return F.struct(
        F.size(F.filter(s["values"], lambda v: v >= middle)).cast("double").alias("high"),
        (F.size(turned) + 1).cast("double").alias("turns"),
        F.aggregate(s["values"], F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)).alias("power"),
        F.aggregate(
            nexts, F.lit(0.0), lambda a, p: a + (p["a"] - mean) * (p["b"] - mean)
        ).alias("lagged"),
    )


def verdict(s: Column, t: Column, battery: Battery) -> Column:
    n, k = s["n"], s["k"]
    chi = (k * s["squares"] / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    expected = 2 * t["high"] * (n - t["high"]) / n + 1
    spread = F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9)))
    runs = (t["turns"] - expected) / spread
    serial = t["lagged"] / F.greatest(t["power"], F.lit(1e-9)) * F.sqrt(n)
    pairs = n * (n - 1)
    likely = n + pairs * battery.coincidence
    varied = F.sqrt(
        2 * pairs * (battery.coincidence - battery.coincidence**2)
        + 4 * n * n * n * (battery.cubes - battery.coincidence**2)
    )
    even = tail((likely - s["squares"]) / varied)
    change = battery.changes * (n - 1)
    classes = tail((s["changes"] - change) / F.sqrt(change * (1 - battery.changes)))
    # Fisher's combination of two p-values
    joint = let(F.greatest(even * classes, F.lit(1e-300)), lambda x: x * (1 - F.log(x)))
    passes = (
        (chi <= battery.most_z)
        & (F.abs(runs) <= battery.most_z)
        & (F.abs(serial) <= battery.most_z)
    )
    return F.when(passes, joint)


def p_value(token: Column, battery: Battery) -> Column:
    """Chance that an ordinary token of this length looks as random; null if it does not."""

    def tested(t: Column) -> Column:
        bare, alphabet = t["bare"], t["alphabet"]
        return F.when(
            alphabet.isNotNull(),
            let(
                symbols_of(bare, alphabet),
                lambda s: let(sums_of(s), lambda sums: verdict(s, sums, battery)),
            ),
        )

    bare = F.regexp_replace(token, "=+$", "")
    return let(F.struct(bare.alias("bare"), infer(bare).alias("alphabet")), tested)


def band(length: Column, battery: Battery) -> Column:
    out = F.lit(0)
    for i, least in enumerate(battery.bands):
        out = F.when(length >= least, i).otherwise(out)
    return out


def scan(documents: DataFrame, battery: Battery = Battery(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Base spans and tested tokens of each document row.

    assign, access, hex: arrays of (start, end); tested: arrays of (start, end, p, band) of
    random-looking tokens that touch no base span. No shuffle, no limit on length.
    """
    rows = documents.select(
        *(F.col(c) for c in keep),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"),
    )
    text = F.col("_text")
    named = F.lower(text)
    maybe = (
        named.contains("secret")
        | named.contains("token")
        | named.contains("passw")
        | named.contains("api")
    )
    rows = rows.withColumns(
        {
            "assign": spans_of(
                F.filter(
                    placed(text, ASSIGN, maybe),
                    lambda x: F.length(F.regexp_extract(x["hit"], ASSIGN, 2)) >= ASSIGN_LEAST,
                )
            ),
            "access": spans_of(placed(text, ACCESS, text.contains("AKIA"))),
            "hex": spans_of(placed(text, HEX, F.lit(True))),
            # every encoding that infer() accepts has digits in its tokens
            "_tokens": placed(text, TOKEN, text.rlike("[0-9]")),
        }
    )

    def apart(base: Column) -> Column:
        return F.filter(
            "_tokens",
            lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
        )

    tested = F.transform(
        let(F.concat("assign", "access", "hex"), apart),
        lambda t: F.struct(
            t["start"].alias("start"),
            t["end"].alias("end"),
            p_value(t["hit"], battery).alias("p"),
            band(t["end"] - t["start"], battery).alias("band"),
        ),
    )
    rows = rows.withColumn("tested", F.when(F.size("_tokens") > 0, tested).otherwise(F.array()))
    return rows.select(*keep, "_text", "assign", "access", "hex", "tested")


def limits(scanned: DataFrame, battery: Battery = Battery()) -> list[float]:
    """For each band of lengths, the largest p-value that still counts as a discovery.

    Benjamini and Hochberg's rule over all tokens of the table that look random or not,
    on counts of p-values in fixed bins: a few hundred rows at any table size. All tokens
    of the band count as tests; those that fail a randomness test have a p-value of 1.
    """
    bins = F.floor(-_STEP * F.log10(F.greatest(F.coalesce("t.p", F.lit(1.0)), F.lit(1e-30))))
    counts = (
        scanned.filter(F.size("tested") > 0)
        .select(F.explode("tested").alias("t"))
        .groupBy(F.col("t.band").alias("band"), bins.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    out = []
    for i in range(len(battery.bands)):
        own = sorted(((r["bin"], r["n"]) for r in counts if r["band"] == i), reverse=True)
        tests, found, limit = sum(n for _, n in own), 0, -1.0
        for bin_, n in own:
            found += n
            largest = 10 ** (-bin_ / _STEP)
            if largest * tests <= battery.rate * found:
                limit = largest
        out.append(limit)
    return out


def with_discoveries(scanned: DataFrame, battery: Battery = Battery()) -> DataFrame:
    """scan()'s rows with random: (start, end) of the tokens that the rule accepts."""
    most = F.array(*(F.lit(float(x)) for x in limits(scanned, battery)))
    accepted = F.filter("tested", lambda t: t["p"] <= F.element_at(most, t["band"] + 1))
    return scanned.withColumn(
        "random",
        F.transform(
            accepted, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))
        ),
    )


def ranked(kind: str, rank: int) -> Column:
    return F.transform(
        kind,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("kind"), s["end"].alias("end")
        ),
    )


def listed(kinds: tuple[str, ...]) -> Column:
    """All spans of the kinds as (start, rank of kind, end), in order."""
    return F.array_sort(F.concat(*(ranked(k, i) for i, k in enumerate(kinds))))


def joined(kinds: tuple[str, ...]) -> Column:
    names = F.array(*(F.lit(k) for k in kinds))
    return F.array_join(
        F.transform(
            listed(kinds),
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def find(documents: DataFrame, battery: Battery = Battery()) -> DataFrame:
    """One row per document row: counts of base spans, their digest and all spans.

    Null text is empty and has no spans; a null doc_id and repeated rows stay as they are;
    on an empty table the result is empty. Other columns are not read. The table is
    scanned twice: once for the false-discovery limits, once for the result.
    """
    rows = with_discoveries(scan(documents, battery, ("doc_id",)), battery)
    return rows.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(KINDS[:3]), 256).alias("base_sha256"),
        joined(KINDS).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )


def redact(documents: DataFrame, battery: Battery = Battery(), mark: str = "[SECRET]") -> DataFrame:
    """The documents, each run of spans in their text replaced by a mark."""
    columns = documents.columns
    whole = documents.select(F.struct(*columns).alias("_row"), "text")
    rows = with_discoveries(scan(whole, battery, ("_row",)), battery)

    def step(state: Column, s: Column) -> Column:
        ahead = s["start"] > state["at"]
        fresh = s["start"] >= state["at"]
        between = F.when(
            ahead, F.substr(F.col("_text"), state["at"] + 1, s["start"] - state["at"])
        ).otherwise("")
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.concat(
                state["out"], F.when(fresh, F.array(F.concat(between, F.lit(mark)))).otherwise(F.array().cast("array<string>"))
            ).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    text = F.aggregate(
        listed(KINDS),
        zero,
        step,
        lambda s: F.concat(
            F.array_join(s["out"], ""),
            F.substr(F.col("_text"), s["at"] + 1, F.greatest(F.length("_text") - s["at"], F.lit(0))),
        ),
    )
    found = F.size(F.concat(*KINDS)) > 0
    changed = {"text": F.when(found, text).otherwise(F.col("_row.text"))}
    if "n_chars" in columns:
        kind = documents.schema["n_chars"].dataType
        changed["n_chars"] = F.when(found, F.length("text").cast(kind)).otherwise(
            F.col("_row.n_chars")
        )
    rows = rows.withColumn("text", changed.pop("text"))
    return rows.select(*(changed.get(c, F.col("text" if c == "text" else f"_row.`{c}`")).alias(c) for c in columns))
