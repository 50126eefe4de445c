"""Secret scans: three base patterns and a battery of randomness tests.

Candidates of the battery are runs of 16 or more characters of
[A-Za-z0-9+/_=-].  Each gets the narrowest encoding that holds it (decimal,
hex in either case, lower or upper letters, base 32 of
A-Z and 2-7, upper letters with digits, base 64).  Three statistics are taken
over its symbols: chi-squared of a uniform alphabet, the number of runs of
letter class (or of low and high symbols), and the serial correlation of
neighbouring symbols.

* Against "the symbols are random" none may be extreme (z beyond ``Z_RANDOM``).
* Against "an ordinary string" (``ORDINARY``: its excess chi-squared per
  character, its rate of class changes, its correlation) the three one-sided
  scores, all of which grow with length, are combined to one p-value.
* The Benjamini-Hochberg procedure at rate ``RATE`` chooses among these
  p-values within strata of length, over all candidates of the table.  p is
  rounded up to a grid of 200 steps, so only counts per grid step are gathered.

Base matches stay whatever the battery says.  Null and empty texts have no
span; repeated rows give repeated results.  Positions are code points, end
exclusive.  Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# Fixed values of the contract: kind, pattern, group whose length counts, least length.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
# What a text must hold for the kind to be looked for at all (saves the spans of plain texts).
_HOLDS = {"assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "access": "AKIA[A-Z0-9]{14}", "hex": "[0-9a-f]{16}"}
_RUN, _RUN_HOLDS = r"[A-Za-z0-9+/_=-]{16,}", r"[A-Za-z0-9+/_=-]{16}"

_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# encoding: alphabet, and which of its symbols count as class 1 of the runs test
ENCODINGS = {
    "decimal": (_DIGITS, "56789"),
    "hex": (_DIGITS + "abcdef", "abcdef"),
    "lower": (_LOW, _LOW[13:]),
    "upper": (_UP, _UP[13:]),
    "upperhex": (_DIGITS + "ABCDEF", "ABCDEF"),
    "base32": (_UP + "234567", "234567"),
    "base36": (_UP + _DIGITS, _DIGITS),
    "base64": (_UP + _LOW + _DIGITS + "+/_-=", _LOW),
}
# excess chi-squared per character, class changes per step, correlation of neighbours in ordinary strings (set by hand)
ORDINARY = {"decimal": (0.6, 0.35, 0.5), "hex": (0.9, 0.2, 0.5), "upperhex": (0.9, 0.2, 0.5), "lower": (0.8, 0.5, 0.3),
            "upper": (0.8, 0.5, 0.3), "base32": (1.1, 0.1, 0.5), "base36": (1.1, 0.1, 0.5), "base64": (3.0, 0.15, 0.5)}
STRATA = (16, 24, 32, 48, 96)
Z_RANDOM, RATE, STEPS = 3.5, 0.01, 200


def _located(text: Column, pattern: str, group: int, least: int, holds: str) -> Column:
    """array<struct<start, end, s>> of the matches, left to right, whose group is long enough."""
    pat = F.lit(pattern)
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, pat, F.lit(0))
    parts = F.regexp_extract_all(text, pat, F.lit(group)) if group else hits
    found = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"), parts.alias("part"))
    placed = F.aggregate(
        found, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,s:string>>").alias("out")),
        lambda acc, m: F.struct(
            (acc["at"] + F.length(m["gap"]) + F.length(m["hit"])).alias("at"),
            F.when(F.length(m["part"]) >= least, F.array_append(acc["out"], F.struct(
                (acc["at"] + F.length(m["gap"])).alias("start"),
                (acc["at"] + F.length(m["gap"]) + F.length(m["hit"])).alias("end"), m["hit"].alias("s"))))
            .otherwise(acc["out"]).alias("out")))
    return F.when(text.rlike(holds), placed["out"]).otherwise(F.array().cast("array<struct<start:int,end:int,s:string>>"))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, by the logistic form 1 / (1 + exp(1.5976 z + 0.07056 z^3))."""
    z = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _tested(s: Column, encoding: str) -> Column:
    """The grid step of the p-value of string s (0: p near 1), or -1 where it does not look random."""
    alphabet, ones = ENCODINGS[encoding]
    excess, changing, corr = ORDINARY[encoding]
    a, n = len(alphabet), F.length(s).cast("double")
    chi = sum(((F.length(s) - F.length(F.replace(s, F.lit(c)))) ** 2 for c in alphabet), F.lit(0)) * a / n - n
    bits = F.translate(s, alphabet, "".join("1" if c in ones else "0" for c in alphabet))
    n1 = F.length(F.replace(bits, F.lit("0"))).cast("double")
    changes = (F.length(bits) - F.length(F.replace(bits, F.lit("01"))) + F.length(bits)
               - F.length(F.replace(bits, F.lit("10")))) / 2.0
    x = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(alphabet), c).cast("double"))
    sums = F.aggregate(
        x, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("ss"), F.lit(0.0).alias("lag"), F.lit(0.0).alias("last")),
        lambda acc, v: F.struct((acc["s"] + v).alias("s"), (acc["ss"] + v * v).alias("ss"),
                                (acc["lag"] + acc["last"] * v).alias("lag"), v.alias("last")))

    def moments(t: Column) -> Column:
        mean = t["sums"]["s"] / t["n"]
        return F.struct(t["n"].alias("n"), t["chi"].alias("chi"), t["n1"].alias("n1"), t["changes"].alias("changes"),
                        (t["sums"]["lag"] / (t["n"] - 1) - mean * mean).alias("cov"),
                        (t["sums"]["ss"] / t["n"] - mean * mean).alias("var"))

    def judged(t: Column) -> Column:
        n, chi, n1, changes = t["n"], t["chi"], t["n1"], t["changes"]
        r = F.when(t["var"] > 0, t["cov"] / t["var"]).otherwise(1.0)
        # random symbols
        share = len(ones) / a
        flip = 2 * share * (1 - share)
        z_chi = (F.cbrt(F.greatest(chi, F.lit(0.0)) / (a - 1)) - (1 - 2 / (9 * (a - 1)))) / (2 / (9 * (a - 1))) ** 0.5
        z_one = (n1 - n * share) / F.sqrt(n * share * (1 - share))
        z_runs = (changes - (n - 1) * flip) / F.sqrt((n - 1) * flip * (1 - flip))
        z_corr = r * F.sqrt(n)
        random = (z_chi <= Z_RANDOM) & (F.abs(z_one) <= Z_RANDOM) & (F.abs(z_runs) <= Z_RANDOM) & (F.abs(z_corr) <= Z_RANDOM)
        # ordinary strings
        y_chi = (a - 1 + n * excess - chi) / F.sqrt(2.0 * (a - 1) + 4 * excess * n)
        y_runs = (changes - (n - 1) * changing) / F.sqrt((n - 1) * changing * (1 - changing))
        y_corr = (corr - F.abs(r)) * F.sqrt(n)
        p = _let((y_chi + F.least(y_runs, F.lit(6.0)) + F.least(y_corr, F.lit(6.0))) / 3 ** 0.5, _upper_tail)
        return F.when(random, F.least(F.floor(-F.log10(p) * 20), F.lit(STEPS))).otherwise(-1).cast("int")

    seen = F.struct(n.alias("n"), chi.alias("chi"), n1.alias("n1"), changes.alias("changes"), sums.alias("sums"))
    return _let(_let(seen, moments), judged)


def _step(s: Column) -> Column:
    out = F.when(s.rlike("^[0-9]+$"), _tested(s, "decimal"))
    for enc, pat in (("hex", "^[0-9a-f]+$"), ("upperhex", "^[0-9A-F]+$"), ("lower", "^[a-z]+$"), ("upper", "^[A-Z]+$"),
                     ("base32", "^[A-Z2-7]+$"), ("base36", "^[A-Z0-9]+$")):
        out = out.when(s.rlike(pat), _tested(s, enc))
    return out.otherwise(_tested(s, "base64"))


def _as_span(kind: str):
    return lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind"))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with base spans (``_assign``, ``_access``, ``_hex``) and tested candidates (``_random``)."""
    df = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    for kind, pattern, group, least in BASE:
        df = df.withColumn(f"_{kind}", F.transform(
            _located(F.col("_text"), pattern, group, least, _HOLDS[kind]), _as_span(kind)))
    runs = _located(F.col("_text"), _RUN, 0, 16, _RUN_HOLDS)
    stratum = lambda n: sum(((n >= s).cast("int") for s in STRATA), F.lit(0))     # noqa: E731
    return df.withColumn("_random", F.transform(runs, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), stratum(F.length(m["s"])).alias("stratum"),
        _step(m["s"]).alias("step")))).drop("_text")


def thresholds(found: DataFrame) -> dict[int, int]:
    """For each stratum of length the smallest grid step that the Benjamini-Hochberg procedure accepts.

    Gathers a count per stratum and grid step: at most 5 * 202 rows.
    """
    cells = found.select(F.explode("_random").alias("c")).groupBy("c.stratum", "c.step").agg(F.count(F.lit(1)).alias("n"))
    least_p = F.pow(F.lit(10.0), -F.col("step") / 20.0)                 # p rounded up to its grid step
    upto = F.sum(F.when(F.col("step") >= 0, F.col("n")).otherwise(0)).over(Window.partitionBy("stratum").orderBy(F.desc("step")))
    tests = F.sum("n").over(Window.partitionBy("stratum"))
    ok = cells.withColumn("fits", (F.col("step") >= 0) & (least_p <= RATE * upto / tests)).where("fits")
    return {r["stratum"]: r["step"] for r in ok.groupBy("stratum").agg(F.min("step").alias("step")).collect()}


def with_spans(found: DataFrame, accepted: dict[int, int]) -> DataFrame:
    """Adds ``_base`` and ``_spans``, sorted by start, then kind as listed (random last)."""
    rank = F.create_map(*[x for i, k in enumerate(("assign", "access", "hex", "random")) for x in (F.lit(k), F.lit(i))])
    order = lambda a: F.transform(F.array_sort(F.transform(a, lambda s: F.struct(      # noqa: E731
        s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind")))), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    enough = lambda c: F.coalesce(*[F.when(c["stratum"] == k, c["step"] >= v) for k, v in accepted.items()],
                                  F.lit(False))
    random = F.transform(F.filter("_random", enough), lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), F.lit("random").alias("kind")))
    return (found.withColumn("_base", order(F.concat("_assign", "_access", "_hex")))
            .withColumn("_spans", order(F.concat("_assign", "_access", "_hex", random))))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """The digest of every row: counts of base spans, their hash, all spans."""
    found = stored(candidates(docs.select("doc_id", "text")).drop("text"), "secrets")
    return with_spans(found, thresholds(found)).select(
        "doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(written(F.col("_base")), 256).alias("base_sha256"), written(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mask``; n_chars follows, where it exists.

    The columns are those of ``docs``.  Rows and their candidates are written
    once; one pass over them gathers the counts of the false-discovery control,
    the other rewrites the texts.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = stored(candidates(docs.select(row, "text")).drop("text"), "secrets")
    df = with_spans(found, thresholds(found)).select("row", "_spans")
    old = F.col("row")["text"]
    cut = F.aggregate(
        "_spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"], F.concat(
                acc["out"], F.substring(old, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)))
            .otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at")),
        lambda acc: F.concat(acc["out"], F.substring(old, acc["at"] + 1, F.length(old))))
    hit = F.size("_spans") > 0
    df = df.withColumn("_new", F.when(hit, cut).otherwise(old)).withColumn("_hit", hit)
    values = {c: F.col("row")[c] for c in docs.columns}
    values["text"] = F.col("_new")
    if "n_chars" in values:
        values["n_chars"] = F.when(F.col("_hit"), F.char_length("_new").cast(docs.schema["n_chars"].dataType)) \
            .otherwise(values["n_chars"])
    return df.select(*[v.alias(c) for c, v in values.items()])
