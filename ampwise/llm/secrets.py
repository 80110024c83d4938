"""Secret scans: patterns, and a battery of randomness tests. DataFrame functions only.

Base kinds are found by pattern, leftmost and non-overlapping per kind: assigned
values, access keys, long hexadecimal runs. Their spans come from splitting the
text at the matches: the lengths of pieces and matches, summed, give positions.

The battery looks at every further run of ``[A-Za-z0-9+/_=-]`` of at least
``LEAST`` characters that mixes letters and digits. Its encoding (hexadecimal,
base 32, base 36, base 62, base 64) is inferred from the characters it holds. Three
tests are made of its symbols' numbers in that alphabet:

* chi-squared: how evenly the symbols fall into eighths of the alphabet;
* runs: how often the kind of character changes (lower, upper, digit, plus sign);
* serial correlation of neighbouring symbols.

The hypothesis to be rejected is that the run is words, names and numbers joined
together. Of such text the symbols crowd into few eighths (chi-squared grows with
the length by ``TEXT_CROWDING`` a symbol: a non-central distribution), kinds change
at a share of ``TEXT_CHANGES``, and neighbours resemble each other (a correlation of
``TEXT_SERIAL``, as each kind has its own stretch of the alphabet). Each test's normal
tail on the random side is its p-value; Fisher's method combines the three. A run
that fits random symbols no better than text does, because a test rejects uniform,
independent symbols at ``REJECT`` standard scores, keeps p-value 1.

False discoveries are controlled by Benjamini and Hochberg's step-up rule within
strata of length (a longer run is judged among its like), over all runs of all
texts: p-values are counted in bins of their negative logarithm, the counts of a
stratum are summed from the strong end, and the least strict bin that holds the
rate becomes the stratum's threshold. The table of counts has at most
``STRATA * BINS`` rows whatever the corpus.

Defined cases: a null text counts as empty and has no span; repeated rows get
equal results; without texts there are no thresholds and no rows; columns beyond
those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



#: The base patterns and least lengths. A keyword's letters count in either case.
_WORDS = ("password", "passwd", "secret", "token")
_EITHER = "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in _WORDS) + "|[aA][pP][iI]_?[kK][eE][yY]"
ASSIGN = f"({_EITHER})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: Candidates of the battery: least length, false discovery rate, what joined words look like to the
#: three tests, standard scores beyond which a test rejects randomness, and the strata and bins of
#: the control.
LEAST = 20
RATE = 0.01
TEXT_CROWDING, TEXT_CHANGES, TEXT_SERIAL = 0.8, 0.08, 0.3
REJECT = 4.0
STRATA, BINS, BIN_WIDTH = 8, 400, 0.25
CANDIDATE = f"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{{{LEAST},}}"


_NONE = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Structs (start, kind, end) of the matches of ``pattern`` whose ``group`` has at least
    ``least`` characters; positions in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    sizes = F.zip_with(F.zip_with(F.split(text, pattern, -1), found, lambda p, m: F.struct(F.char_length(p).alias("p"), F.char_length(m).alias("m"))),
                       parts, lambda s, g: F.struct(s["p"].alias("p"), s["m"].alias("m"), F.char_length(g).alias("g")))
    walked = F.aggregate(
        sizes, F.struct(F.lit(0).alias("upto"), F.array().cast(_NONE).alias("all")),
        lambda acc, x: F.struct(
            (acc["upto"] + x["p"] + F.coalesce(x["m"], F.lit(0))).alias("upto"),
            F.when(x["g"] >= least, F.concat(acc["all"], F.array(F.struct((acc["upto"] + x["p"]).alias("start"), F.lit(kind).alias("kind"), (acc["upto"] + x["p"] + x["m"]).alias("end")))))
            .otherwise(acc["all"]).alias("all")))
    return walked["all"]


def _where(cond: Column, spans: Column) -> Column:
    """``spans`` where the text can hold any, else none: most texts skip the work."""
    return F.when(cond, spans).otherwise(F.array().cast(_NONE))


def base_spans(text: Column) -> dict[str, Column]:
    long_hex = f"[0-9a-f]{{{LEAST_HEX},}}"  # the same spans as longer matches of HEX
    return {
        "assign": _where((text.contains("=") | text.contains(":")) & text.rlike(f"({_EITHER})[\"']?\\x20*[:=]"), _spans(text, ASSIGN, 0, 2, LEAST_ASSIGN)),
        "access": _where(text.contains("AKIA"), _spans(text, ACCESS, 1, 0, LEAST_ACCESS)),
        "hex": _where(text.rlike(long_hex), _spans(text, long_hex, 2)),
    }


def _bound(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _sum(values: Column, zero=0.0) -> Column:
    return F.aggregate(values, F.lit(zero), lambda a, x: a + x)


def _neighbours(values: Column, both) -> Column:
    """``both(a, b)`` of neighbouring values."""
    return _bound(F.greatest(F.size(values) - 1, F.lit(0)), lambda k: F.zip_with(F.slice(values, 1, k), F.slice(values, 2, k), both))


#: Alphabets by encoding; letters of a base without case are folded first.
ALPHABETS = {"hex": "0123456789abcdef", "base32": "abcdefghijklmnopqrstuvwxyz234567", "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
             "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}


def _encoding(token: Column) -> Column:
    return (F.when(token.rlike("^([0-9a-f]+|[0-9A-F]+)=*$"), "hex").when(token.rlike("^[A-Z2-7]+=*$"), "base32")
            .when(token.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), "base36").when(token.rlike("^[0-9A-Za-z]+$"), "base62").otherwise("base64"))


def battery(token: Column) -> Column:
    """struct(encoding, chi, runs, serial, even, changes, alike) of a run of characters: standard
    scores against uniform, independent symbols, then against joined words (large: unlike these)."""
    def in_alphabet(encoding: Column) -> Column:
        plain = F.translate(F.regexp_replace(token, "=+$", ""), "-_", "+/")
        folded = F.when(encoding.isin("base62", "base64"), plain).otherwise(F.lower(plain))
        alphabet = F.element_at(F.create_map(*(F.lit(x) for kv in ALPHABETS.items() for x in kv)), encoding)
        # symbols' places scaled to 0..1
        return _bound(F.struct(folded.alias("t"), alphabet.alias("of")), lambda s: _bound(
            F.transform(F.filter(F.split(s["t"], ""), lambda c: F.length(c) > 0), lambda c: (F.instr(s["of"], c) - F.lit(0.5)) / F.length(s["of"])),
            lambda u: _statistics(token, encoding, u, F.length(s["of"]))))

    return _bound(_encoding(token), in_alphabet)


def _statistics(token: Column, encoding: Column, u: Column, size: Column) -> Column:
    def edge(k: Column) -> Column:
        return F.floor(k * size / 8 + 0.5)

    def with_counts(c: Column) -> Column:
        n = c["n"]
        # chi-squared over eighths of the alphabet; Wilson and Hilferty's normal score with 7 degrees of freedom
        eighth = F.transform(u, lambda x: F.least(F.lit(7), F.floor(x * 8).cast("int")))
        return _bound(_sum(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: _bound(
            F.greatest(n * (edge(k + 1) - edge(k)) / size, F.lit(1e-9)),
            lambda e: F.pow(F.size(F.filter(eighth, lambda x: x == k)) - e, F.lit(2.0)) / e))), lambda chi2: with_chi2(c, chi2))

    def with_chi2(c: Column, chi2: Column) -> Column:
        n, mean = c["n"], c["mean"]
        chi = (F.pow(chi2 / 7, F.lit(1 / 3)) - (1 - 2 / 63)) / F.sqrt(F.lit(2 / 63))
        # runs above and below the middle
        n1, n0 = c["high"], n - c["high"]
        changes = _sum(_neighbours(u, lambda a, b: ((a >= 0.5) != (b >= 0.5)).cast("int")), 0)
        runs = _bound(2 * n0 * n1 / n + 1, lambda m: (changes + 1 - m) / F.sqrt(F.greatest((m - 1) * (m - 2) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.25))))
        # correlation of neighbours
        var = _sum(F.transform(u, lambda x: (x - mean) * (x - mean)))
        serial = F.sqrt(n) * _sum(_neighbours(u, lambda a, b: (a - mean) * (b - mean))) / F.greatest(var, F.lit(1e-9))
        # against joined words: non-central chi-squared with 7 degrees of freedom, lower side
        crowd = n * TEXT_CROWDING
        even = (7 + crowd - chi2) / F.sqrt(2 * (7 + 2 * crowd))
        # changes between kinds of characters, signs that join words left out
        kinds = F.transform(F.split(F.translate(token, "=-_/", ""), ""), lambda x: F.when(x.rlike("[a-z]"), 0).when(x.rlike("[A-Z]"), 1).when(x.rlike("[0-9]"), 2).otherwise(3))
        kind_changes = _bound(kinds, lambda ks: (_sum(_neighbours(ks, lambda a, b: (a != b).cast("int")), 0) - (F.size(ks) - 1) * TEXT_CHANGES)
                              / F.sqrt(F.greatest((F.size(ks) - 1) * F.lit(TEXT_CHANGES * (1 - TEXT_CHANGES)), F.lit(1e-9))))
        alike = (TEXT_SERIAL * F.sqrt(n) - serial) / (1 - TEXT_SERIAL ** 2) ** 0.5
        return F.struct(encoding.alias("encoding"), chi.alias("chi"), runs.alias("runs"), serial.alias("serial"),
                        even.alias("even"), kind_changes.alias("changes"), alike.alias("alike"))

    counts = F.struct(F.size(u).cast("double").alias("n"), (_sum(u) / F.size(u)).alias("mean"), F.size(F.filter(u, lambda x: x >= 0.5)).cast("double").alias("high"))
    return _bound(counts, with_counts)


def _tail(x: Column) -> Column:
    """Negative natural logarithm of the upper normal tail: beyond 1.5 by its usual bound
    x*x/2 + ln(x) + ln(sqrt(2 pi)), below by the logistic curve near it."""
    return F.when(x > 1.5, x * x / 2 + F.log(x) + 0.9189385332046727).otherwise(F.log1p(F.exp(F.least(x, F.lit(1.5)) * 1.702)))


def _neg_log_p(test: Column) -> Column:
    """Negative natural logarithm of the combined p-value: of three independent tails, minus the
    sum s of their logarithms is half a chi-squared of 6 degrees of freedom, whose tail is
    exp(-s) (1 + s + s*s/2). 0 for a run that a test rejects as random."""
    rejected = (test["chi"] > REJECT) | (F.abs(test["runs"]) > REJECT) | (F.abs(test["serial"]) > REJECT)
    s = _tail(test["even"]) + _tail(test["changes"]) + _tail(test["alike"])
    return F.when(rejected, F.lit(0.0)).otherwise(_bound(s, lambda x: F.greatest(F.lit(0.0), x - F.log(1 + x + x * x / 2))))


def scan(docs: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """Append ``out``: array of structs (start, kind, end) sorted by start, then kind; ``kind``
    is the place in KINDS. All spans of the base kinds, and those the battery adds."""
    names = set(docs.columns)
    row = next(n for n in (f"_row{i}" for i in range(len(names) + 1)) if n not in names)
    work = docs.drop(out)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = base_spans(text)
    # both columns are computed from the text in the one pass over the documents
    flagged = _where(text.rlike("[0-9]") & text.rlike(CANDIDATE), _spans(text, CANDIDATE, 3))
    scanned = work.select("*", F.array_sort(F.concat(*base.values())).alias(out), flagged.alias(row))
    # the battery judges candidates outside base spans
    outside = F.filter(F.col(row), lambda c: ~F.exists(F.col(out), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    judged = F.transform(outside, lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"),
        F.least(F.lit(STRATA - 1), F.floor(F.log2(((c["end"] - c["start"]) / LEAST).cast("double")) * 2).cast("int")).alias("stratum"),
        F.least(F.lit(BINS - 1), F.floor(_bound(battery(F.substring(F.col(text_col), c["start"] + 1, c["end"] - c["start"])), _neg_log_p) / BIN_WIDTH).cast("int")).alias("bin")))
    tested = scanned.withColumn(row, F.when(F.size(row) > 0, judged))
    found = tested.select(F.explode(row).alias("c")).groupBy("c.stratum", "c.bin").agg(F.count("*").alias("n"))
    limits = thresholds(found)
    keep = F.filter(F.coalesce(F.col(row), F.array().cast(f"array<struct<start:int,kind:int,end:int,stratum:int,bin:int>>")),
                    lambda c: c["bin"] >= F.element_at(F.lit(limits), c["stratum"] + 1))
    added = F.transform(keep, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return tested.withColumn(out, F.array_sort(F.concat(F.col(out), added))).drop(row)


def thresholds(found: DataFrame) -> list[int]:
    """Least bin that the step-up rule accepts, for each stratum (BINS: none). ``found`` has one
    row per stratum and bin; the rule compares p (the bin's weakest) with rate * rank / runs."""
    import math
    counts: dict[int, dict[int, int]] = {}
    for r in found.collect():  # at most STRATA * BINS rows
        counts.setdefault(r["stratum"], {})[r["bin"]] = r["n"]
    out = []
    for s in range(STRATA):
        own = counts.get(s, {})
        total, rank, least = sum(own.values()), 0, BINS
        for b in sorted(own, reverse=True):
            rank += own[b]
            if b and b * BIN_WIDTH >= -math.log(RATE * rank / total):
                least = b
        out.append(least)
    return out


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")





def redacted(text: Column, spans: Column, marker: str) -> Column:
    """``text`` with the union of the spans replaced, each stretch by one ``marker``."""
    done = F.aggregate(
        spans, F.struct(F.lit(0).alias("upto"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["end"]).alias("upto"),
            F.when(s["start"] < acc["upto"], acc["out"]).otherwise(F.concat(acc["out"], F.substring(text, acc["upto"] + 1, s["start"] - acc["upto"]), F.lit(marker))).alias("out")))
    return F.concat(done["out"], F.substring(text, done["upto"] + 1, F.char_length(text)))
