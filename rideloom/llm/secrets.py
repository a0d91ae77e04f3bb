"""Secrets in text: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

Both models give the chance of a character after the one before; a token is a secret where the log-likelihood
ratio of the two, summed over its characters, passes the log of the odds against it. Everything that reads
documents is built from Spark's own functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideloom.functions.once import computed_once

KINDS = ("assign", "access", "hex", "random")
#: Fixed patterns. A whole run fails or passes by its length, so the lengths of the last two stand in the pattern.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGNED = 6
#: What the models judge: long tokens of letters, digits and the signs of encodings.
TOKEN = r"[\p{L}\p{N}+/_=-]{16,}"

SYMBOLS = 95  # the printable ASCII characters but the blank; 0 stands for all others
ODDS = 1e6  # tokens to one secret
SAMPLE_DOCS = 1000
_BLOCK = 512
_SPAN = "array<struct<start: bigint, kind: int, end: bigint>>"


@dataclass(frozen=True)
class Markov:
    """Log ratio of the chances of each character after each other, row by row, and the sum that makes a secret."""

    log_ratio: list[float]
    threshold: float


def _symbol(char: Column) -> Column:
    code = F.ascii(char)
    return F.when((code > 32) & (code < 127), code - 32).otherwise(0)


def labelled_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, text_column: str = "text") -> DataFrame:
    """``text`` and ``random``: strings labelled by how they are made, two for each word of a sample of documents.

    About ``sample_docs`` rows are drawn by a hash; a model needs no more, and only training is bounded so.
    Ordinary: words of 4 to 64 characters outside of the fixed patterns, names that programs make of them (joined by
    signs or capitals, numbered), decimal numbers, and one character over and over. Random: digests as hexadecimal, base 64, and its upper-case or
    lower-case letters and digits.
    """
    total = max(docs.count(), 1)
    share = F.pmod(F.xxhash64(*docs.columns), F.lit(1 << 40)) < int((1 << 40) * min(sample_docs / total, 1.0))
    bare = F.regexp_replace(text_column, f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    words = F.filter(F.split(bare, r"[^\p{L}\p{N}+/_=-]+"), lambda w: F.char_length(w).between(4, 64))
    drawn = computed_once(docs.filter(share & F.col(text_column).isNotNull()).select(text_column), {"words": words})
    named = drawn.select(F.xxhash64(text_column).alias("name"), F.posexplode("words").alias("i", "w"), "words")
    named = named.select("name", "i", "w", F.coalesce(F.get("words", F.col("i") + 1), F.col("w")).alias("v"))
    digest = F.sha2(F.concat_ws(":", "name", "i"), 256)
    made = computed_once(named, {"d": digest, "turn": F.col("i") % 10})
    w, v, d, turn = F.col("w"), F.col("v"), F.col("d"), F.col("turn")
    code = F.regexp_replace(F.base64(F.unhex(d)), "=", "")
    number = F.translate(d, "abcdef", "")
    ordinary = (
        F.when(turn == 1, F.concat(w, F.lit("_"), v)).when(turn == 2, F.concat(F.lower(w), F.initcap(v)))
        .when(turn == 3, F.concat(F.upper(w), F.lit("_"), F.upper(v))).when(turn == 4, F.concat(w, F.substring(number, 1, 3)))
        .when(turn == 5, F.concat(w, F.lit("-"), v)).when(turn == 6, F.substring(number, 1, 16))
        .when(turn == 7, F.concat(w, F.lit("/"), v)).when(turn == 8, F.repeat(F.substring(w, 1, 1), F.lit(12)))
        .when(turn == 9, F.repeat(F.substring(F.lit("=-_/+"), F.pmod("name", F.lit(5)).cast("int") + 1, F.lit(1)), F.lit(12))).otherwise(w))
    plain = F.regexp_replace(code, "[+/]", "")
    random = (
        F.when(turn % 4 == 1, code).when(turn % 4 == 2, F.upper(plain)).when(turn % 4 == 3, F.lower(plain))
        .otherwise(F.substring(d, 1, 40)))
    both = F.array(F.struct(ordinary.alias("text"), F.lit(False).alias("random")),
                   F.struct(random.alias("text"), F.lit(True).alias("random")))
    return made.select(F.inline(both))


def _kind(symbol: int) -> int:
    """Digits, capitals, small letters, signs, and what is not ASCII."""
    char = chr(symbol + 32)
    return 0 if not symbol else 1 if char.isdigit() else 2 if char.isupper() else 3 if char.islower() else 4


def chances(counts: list[int], weight: float) -> list[float]:
    """Chance of each symbol after each other from counts of pairs.

    The share among the pairs seen, ``weight``, is mixed with the chance of the symbol's kind after the other's kind
    times its share in its kind, so that a pair not seen in training costs no more than it should.
    """
    n, kinds, half = SYMBOLS, [_kind(i) for i in range(SYMBOLS)], 0.5
    after, moves = [half] * n, [[half] * 5 for _ in range(5)]
    for pair, count in enumerate(counts):
        after[pair % n] += count
        moves[kinds[pair // n]][kinds[pair % n]] += count
    members = [sum(a for a, k in zip(after, kinds, strict=True) if k == kind) for kind in range(5)]
    out = []
    for a in range(n):
        row, move = counts[a * n : (a + 1) * n], moves[kinds[a]]
        seen = sum(row)
        own = weight if seen else 0.0
        out += [own * c / max(seen, 1) + (1 - own) * move[kinds[b]] / sum(move) * after[b] / members[kinds[b]] for b, c in enumerate(row)]
    return out


def fit(samples: DataFrame, odds: float = ODDS, weight: float = 0.8) -> Markov:
    """Both models from labelled strings (``text``, ``random``); rows with a null are left out.

    The driver gets counts of pairs of characters, ``SYMBOLS`` ** 2 rows at most. Without samples every ratio is 0,
    and nothing is a secret.
    """
    chars = F.transform(F.split("text", ""), _symbol)
    coded = computed_once(samples.select("text", "random").dropna(), {"c": chars})
    pairs = coded.select("random", F.explode(F.zip_with(
        F.slice("c", 1, F.greatest(F.size("c") - 1, F.lit(0))), F.slice("c", 2, F.size("c")),
        lambda a, b: a * SYMBOLS + b)).alias("pair"))
    counts = [[0] * SYMBOLS ** 2 for _ in (0, 1)]
    for row in pairs.groupBy("random", "pair").count().collect():
        counts[row.random][row.pair] += row["count"]
    ordinary, random = (chances(c, weight) for c in counts)
    return Markov([round(math.log(r / o), 6) for r, o in zip(random, ordinary, strict=True)], math.log(odds))


def log_likelihood_ratio(token: Column, model: Markov) -> Column:
    """Sum over the characters of a token, its first one left out; 0 for an empty one."""
    table = F.split(F.lit(",".join(map(str, model.log_ratio))), ",").cast("array<double>")  # folded into one literal
    start = F.struct(F.lit(-1).alias("before"), F.lit(0.0).alias("sum"))
    step = lambda s, c: F.struct(
        _symbol(c).alias("before"),
        F.when(s["before"] < 0, 0.0).otherwise(s["sum"] + F.get(table, s["before"] * SYMBOLS + _symbol(c))).alias("sum"))
    return F.aggregate(F.split(token, ""), start, step, lambda s: s["sum"])


def _sizes(text: Column, pattern: str, matches: Column) -> Column:
    """Code points from each match's end, or the text's begin, to the next match's end or the text's end."""
    gaps = F.split(text, pattern, -1)
    return F.zip_with(gaps, matches, lambda g, m: (F.char_length(g) + F.coalesce(F.char_length(m), F.lit(0))).cast("long"))


def _ends(sizes: Column) -> Column:
    """Running sums, block by block: the blocks keep the work in proportion to the array."""
    total = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(sizes) / _BLOCK).cast("int")), lambda b: F.slice(sizes, b * _BLOCK + 1, _BLOCK))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<array<bigint>>").alias("out"))
    step = lambda s, block: F.struct(
        (s["at"] + total(block)).alias("at"),
        F.array_append(s["out"], F.transform(block, lambda _, i: s["at"] + total(F.slice(block, F.lit(1), i + 1)))).alias("out"))
    return F.aggregate(blocks, start, step, lambda s: F.flatten(s["out"]))


def _spans(kind: int, ends: Column, matches: Column, good: Column) -> Column:
    """Spans of the matches that are ``good`` (an array of booleans)."""
    placed = F.zip_with(ends, F.arrays_zip(matches.alias("m"), good.alias("good")), lambda e, x: F.struct(
        (e - F.char_length(x["m"])).alias("start"), F.lit(kind).alias("kind"), e.alias("end"), x["good"].alias("good")))
    return F.transform(F.filter(placed, lambda s: F.coalesce(s["good"], F.lit(False))), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))).cast(_SPAN)


def find(docs: DataFrame, model: Markov | None = None, text_column: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: lists of (start, kind, end) in code points, kind as in ``KINDS``.

    ``base`` are the matches of the fixed patterns, leftmost and non-overlapping by kind; ``spans`` adds the tokens that
    the models take for secrets and that no base span touches. Without a model one is trained on ``docs``. A null text
    counts as empty. Other columns stay, those named like the new ones are replaced; repeated rows get the
    same spans each. Texts are read whole, in time in proportion to their length.
    """
    model = model or fit(labelled_samples(docs, text_column=text_column))
    kept = [c for c in docs.columns if c not in ("base", "spans")]
    text = F.coalesce(F.col("_t.text"), F.lit(""))
    patterns = (ASSIGN, ACCESS, HEX, TOKEN)
    every = lambda matches, test: F.transform(matches, test)
    found = computed_once(
        docs.select(F.struct(*kept).alias("_row"), F.struct(F.col(text_column).alias("text")).alias("_t")),
        {f"_m{k}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, p in enumerate(patterns)})
    tests = (
        lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 1)) >= LEAST_ASSIGNED,
        lambda m: F.lit(True), lambda m: F.lit(True),
        lambda m: log_likelihood_ratio(m, model) >= model.threshold)
    judged = computed_once(found, {f"_g{k}": every(F.col(f"_m{k}"), test) for k, test in enumerate(tests)})
    some = [F.exists(f"_g{k}", lambda x: x) for k in range(len(KINDS))]
    sized = computed_once(judged, {
        f"_s{k}": F.when(some[k], _sizes(text, p, F.col(f"_m{k}"))) for k, p in enumerate(patterns)})
    none = F.array().cast(_SPAN)
    placed = computed_once(sized, {f"_p{k}": F.coalesce(F.when(
        F.col(f"_s{k}").isNotNull(), _spans(k, _ends(F.col(f"_s{k}")), F.col(f"_m{k}"), F.col(f"_g{k}"))), none)
        for k in range(len(KINDS))})
    based = computed_once(placed, {"_base": F.array_sort(F.concat("_p0", "_p1", "_p2"))})
    added = F.filter("_p3", lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return based.select("_row.*", F.col("_base").alias("base"), F.array_sort(F.concat("_base", added)).alias("spans"))


def counted(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, the digest of their list, and all spans as text."""
    names = F.array(*map(F.lit, KINDS))
    text_of = lambda column: F.array_join(F.transform(
        column, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:-1])],
        F.sha2(text_of("base"), 256).alias("base_sha256"), text_of("spans").alias("spans"))
