"""Secret scans: patterns, and a battery of randomness tests for what patterns do not name.

Candidates are runs of 20 or more characters of the encodings' alphabets, with the padding that ends them. The narrowest encoding that spells a candidate
is inferred. Against the null hypothesis that the characters are drawn at random from its alphabet stand a chi-squared
test of uniformity, a runs test about the alphabet's middle and a test of the serial correlation of neighbours; Fisher's
sum of the three gives one p-value. Short candidates give weak tests, so false discoveries are controlled apart for each
encoding and length band (Benjamini-Hochberg over counts of binned p-values): candidates that are found not to be random
leave, the others are secrets if they could hold 80 bits (digits alone hold log2(10) each).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlake.llm.shared import settle

# fixed values: the base kinds' patterns and least lengths. Runs of one class are maximal, so the least length may stand
# in the pattern of access and hex; a look-behind spares the engine the inner starts of shorter runs.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
# A candidate may follow '=', as in NAME=value, and holds it only as padding at its end.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,6}+"
# fixed values: encodings from the narrowest to the widest, their alphabets
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "hex_lower": DIGITS + "abcdef", "hex_upper": DIGITS + "ABCDEF", "base32": UPPER + "234567", "base36_lower": DIGITS + LOWER, "base36_upper": DIGITS + UPPER,
    "base62": DIGITS + UPPER + LOWER, "base64": UPPER + LOWER + DIGITS + "+/", "base64_url": UPPER + LOWER + DIGITS + "-_",
}
MARK, OTHER = "\\u0001", "\\u0002"  # never part of a match; a mark in the text is taken for the other one
BITS, RATE = 80.0, 0.05
KINDS = ("assign", "access", "hex", "random")


def _literal(pattern: str) -> str:
    return "r\"" + pattern.replace('"', "\\x22") + "\""


def _spans(pattern: str, kind: int, keep: str = "true") -> str:
    """SQL: array of (start, kind, end, word) of the matches in ``clean`` for which ``keep`` holds of the match ``x``."""
    quoted = _literal(pattern)
    parts = f"split(regexp_replace(clean, {quoted}, '{MARK}$0{MARK}'), '{MARK}', -1)"
    none = "cast(array() as array<struct<start:int,kind:int,end:int,word:string>>)"
    step = f"struct(a.at + length(x) as at, not a.hit as hit, if(a.hit and {keep}, concat(a.got, array(struct(a.at as start, {kind} as kind, a.at + length(x) as end, x as word))), a.got) as got)"
    found = f"aggregate({parts}, struct(0 as at, false as hit, {none} as got), (a, x) -> {step}, a -> a.got)"
    return f"if(clean rlike {quoted}, {found}, {none})"


def _joined(spans: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, s -> concat(element_at({names}, s.kind + 1), ':', s.start, ':', s.end)), ',')"


def _tail(z: str) -> str:
    """SQL: the chance that a standard normal exceeds z (logistic form, within 2e-4)."""
    return f"(1.0 / (1.0 + exp(least(700.0, 1.5976 * ({z}) + 0.07056 * power({z}, 3)))))"


def tested(candidates: DataFrame) -> DataFrame:
    """Candidates (word and others) of which an encoding is inferred, with encoding, band, p and bits."""
    body = "rtrim('=', word)"
    spelled = "case " + " ".join(f"when body rlike '^[{a.replace('-', '') + ('-' if '-' in a else '')}]+$' then '{n}'" for n, a in ALPHABETS.items()) + " end"
    alphabet = "case encoding " + " ".join(f"when '{n}' then '{a}'" for n, a in ALPHABETS.items()) + " end"
    rows = candidates.withColumn("body", F.expr(body))
    rows = rows.withColumn("encoding", F.expr(spelled)).where("encoding is not null").withColumn("alphabet", F.expr(alphabet))
    rows = rows.withColumns({
        "n": F.expr("cast(length(body) as double)"), "k": F.expr("cast(length(alphabet) as double)"),
        "at": F.expr("transform(split(body, ''), c -> cast(instr(alphabet, c) - 1 as double))"),
        "squares": F.expr("aggregate(split(alphabet, ''), 0D, (a, c) -> a + power(length(body) - length(replace(body, c, '')), 2))"),
    })
    rows = rows.withColumns({
        "mean": F.expr("aggregate(at, 0D, (a, x) -> a + x) / n"),
        "high": F.expr("aggregate(at, 0D, (a, x) -> a + if(x >= k / 2, 1, 0))"),
        "turns": F.expr("1 + aggregate(zip_with(slice(at, 1, size(at) - 1), slice(at, 2, size(at) - 1), (x, y) -> if((x >= k / 2) = (y >= k / 2), 0D, 1D)), 0D, (a, x) -> a + x)"),
    })
    rows = rows.withColumns({
        "spread": F.expr("aggregate(at, 0D, (a, x) -> a + power(x - mean, 2))"),
        "shift": F.expr("aggregate(zip_with(slice(at, 1, size(at) - 1), slice(at, 2, size(at) - 1), (x, y) -> (x - mean) * (y - mean)), 0D, (a, x) -> a + x)"),
        "excess": F.expr("greatest(0D, k / n * squares - n)"), "pairs": F.expr("2 * high * (n - high)"),
    })
    rows = rows.withColumns({
        # Wilson and Hilferty's cube root makes chi-squared normal
        "z1": F.expr("(power(excess / (k - 1), 1D / 3) - (1 - 2 / (9 * (k - 1)))) / sqrt(2 / (9 * (k - 1)))"),
        "z2": F.expr("if(pairs = 0, 10D, abs(turns - pairs / n - 1) / sqrt(greatest(1e-9D, pairs * (pairs - n) / (n * n * (n - 1)))))"),
        "z3": F.expr("if(spread = 0, 10D, abs(shift / spread + 1 / n) * sqrt(n))"),
    })
    fisher = f"-(ln(greatest(1e-300D, {_tail('z1')})) + ln(greatest(1e-300D, least(1D, 2 * {_tail('z2')}))) + ln(greatest(1e-300D, least(1D, 2 * {_tail('z3')}))))"
    rows = rows.withColumn("half", F.expr(fisher)).withColumn("p", F.expr("least(1D, exp(-half) * (1 + half + half * half / 2))"))
    return rows.withColumns({"band": F.expr("cast(floor(2 * log2(n)) as int)"), "bits": F.expr("n * log2(if(body rlike '^[0-9]+$', 10, k))"), "bin": F.expr("cast(least(3000, floor(-20 * log10(greatest(p, 1e-150D)))) as int)")})


def random_ones(candidates: DataFrame) -> DataFrame:
    """The candidates that pass for random: those that false-discovery control does not find to be otherwise."""
    rows = tested(candidates)
    counts = rows.groupBy("encoding", "band", "bin").agg(F.count("*").alias("held"))
    of = W.partitionBy("encoding", "band")  # at most 3001 rows each
    reach = counts.withColumns({"total": F.sum("held").over(of), "upto": F.sum("held").over(of.orderBy(F.desc("bin")))})
    # a bin's largest p stands for all of it
    rejected = reach.where(f"power(10D, -bin / 20D) <= {RATE} * upto / total").groupBy("encoding", "band").agg(F.min("bin").alias("least"))
    return rows.join(rejected, ["encoding", "band"], "left").where(f"bits >= {BITS} and (least is null or bin < least)")


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_assign, n_access, n_hex, base_sha256, spans), one for each row of ``docs`` with an id.

    Spans are ``kind:start:end`` in code points, by start, then kind. A random span within a base span adds nothing and
    is left out. Null and empty texts have no spans. Rows with equal id and text give equal rows; other texts of one id
    have spans of their own. Other columns are not
    read. An empty table gives no rows.
    """
    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("clean"))
    rows = rows.withColumn("form", F.xxhash64("clean"))  # tells texts of one id apart
    rows = rows.withColumn("clean", F.expr(f"replace(clean, '{MARK}', '{OTHER}')"))
    longest = f"length(regexp_extract(x, {_literal(ASSIGN)}, 2)) >= 6"
    found = rows.select("doc_id", "form", *[F.expr(e).alias(n) for n, e in (("assign", _spans(ASSIGN, 0, longest)), ("access", _spans(ACCESS, 1)), ("hex", _spans(HEX, 2)), ("words", _spans(CANDIDATE, 3)))])
    found = found.withColumn("base", F.expr("array_sort(concat(assign, access, hex))")).select(
        "doc_id", "form", *[F.expr(f"cast(size({k}) as long)").alias(f"n_{k}") for k in KINDS[:3]], F.expr("transform(base, s -> struct(s.start, s.kind, s.end))").alias("base"),
        F.expr("filter(words, w -> not exists(base, b -> b.start <= w.start and b.end >= w.end))").alias("words"),
    )
    found = settle(found, "secret-spans")
    named = settle(random_ones(found.select("doc_id", "form", F.explode("words").alias("w")).select("doc_id", "form", "w.start", "w.kind", "w.end", "w.word")).select("doc_id", "form", "start", "kind", "end").distinct(), "secret-random")
    added = named.groupBy("doc_id", "form").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))
    whole = found.join(added, ["doc_id", "form"], "left")
    every = "array_sort(concat(base, coalesce(added, cast(array() as array<struct<start:int,kind:int,end:int>>))))"
    return whole.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.expr(_joined("base")).cast("binary"), 256).alias("base_sha256"), F.expr(_joined(every)).alias("spans"))
