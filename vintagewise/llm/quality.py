"""Quality rules kept as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule; a policy is a
mask over those bits, so another version, or what a version would keep without one of its rules, is a bitwise
expression over the ledger and never reads a text again.

Defined results: a null or empty text has no words and fails `few_words`; repeated rows get equal ledger rows; an
empty table gives an empty ledger; further columns of the input are not looked at.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .common import words

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines",
            "n_repeat_words"]
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
POSITION_BITS = 24  # words per text that a window's position can count: 16 million

# Order is the bit number: only ever append.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 4 * n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 10 * n_words",
    "bullets": "10 * n_bullet_lines > 9 * n_lines",
    "ellipses": "10 * n_ellipsis_lines > 3 * n_lines",
}
BASE = ("few_words", "repeated_windows")
POLICIES: dict[int, tuple[str, ...]] = {
    1: BASE,
    2: (*BASE, "symbols", "duplicate_lines"),
    3: tuple(RULES),
}
PRODUCTION = 3


def mask_of(rules: tuple[str, ...]) -> int:
    order = list(RULES)
    return sum(1 << order.index(rule) for rule in rules)


def _windows(w: str) -> Column:
    """The 3-word windows of a text as sorted numbers: 40 bits of hash, then the window's position."""
    at = lambda i, k: F.element_at(w, i + k)
    number = lambda i: F.shiftleft(F.xxhash64(at(i, 1), at(i, 2), at(i, 3)), POSITION_BITS) + i
    starts = F.sequence(F.lit(0).cast("long"), (F.size(w) - 3).cast("long"))
    none = F.array().cast("array<bigint>")
    return F.when(F.size(w) >= 3, F.sort_array(F.transform(starts, lambda i: number(i.cast("int"))))).otherwise(none)


def _repeated(s: str, w: str) -> Column:
    """Ascending positions of windows found twice or more; equal hashes are confirmed on the words."""
    place = lambda x: x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")

    def same_words(pair):
        p, q = place(pair["a"]), place(pair["b"])
        equal = [F.element_at(w, p + k) == F.element_at(w, q + k) for k in (1, 2, 3)]
        return equal[0] & equal[1] & equal[2]

    # neighbours of the sorted numbers whose hashes agree; the last has no neighbour
    pairs = F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.when(
        F.shiftright(a.bitwiseXOR(b), POSITION_BITS) == 0, F.struct(a.alias("a"), b.alias("b"))))
    found = F.filter(F.array_compact(pairs), same_words)
    return F.sort_array(F.array_distinct(F.flatten(F.transform(
        found, lambda pair: F.array(place(pair["a"]), place(pair["b"]))))))


def _covered(p: str) -> Column:
    """Words inside the windows at ascending positions `p`."""
    steps = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(3)), F.lit(3)).cast("long"))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """`keep` and the measurements, one row per input row, without a shuffle."""
    raw = F.coalesce(F.col(text), F.lit(""))
    w = docs.select(*keep, raw.alias("_t")).withColumns({
        "_w": words("_t"),
        "_l": F.filter(F.split("_t", "\n"), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0),
    })
    s = w.withColumn("_s", _windows("_w"))
    p = s.withColumn("_p", _repeated("_s", "_w"))
    spaces = F.lit(BLANKS)
    bullet = lambda line: F.substring(F.ltrim(line, spaces), 1, 1).isin("-", "*", "•")
    dots = lambda line: F.rtrim(line, spaces).endswith("...") | F.rtrim(line, spaces).endswith("…")
    out = {
        "n_words": F.size("_w"),
        "word_chars": F.length(F.array_join("_w", "")),
        "n_symbols": F.regexp_count("_t", F.lit(SYMBOLS)),
        "n_lines": F.size("_l"),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_bullet_lines": F.size(F.filter("_l", bullet)),
        "n_ellipsis_lines": F.size(F.filter("_l", dots)),
        "n_repeat_words": _covered("_p"),
    }
    # handed on as a generated row: a later filter on a measure stays above it, and is not rewritten in terms of the text
    measured = F.struct(*[out[name].cast("long").alias(name) for name in MEASURES])
    return p.select(*keep, F.explode(F.array(measured)).alias("_m")).select(*keep, *[f"_m.{name}" for name in MEASURES])


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           rules: Mapping[str, str] = RULES) -> DataFrame:
    """`keep`, every measurement, and `fail_bits` with bit i set if rule i fails."""
    bits = None
    for i, rule in enumerate(rules.values()):
        bit = F.when(F.expr(rule), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return measure(docs, text, keep).withColumn("fail_bits", bits)


def passes(version: int = PRODUCTION, bits: str = "fail_bits") -> Column:
    """Whether a ledger row breaks no rule of the policy."""
    return F.col(bits).bitwiseAND(F.lit(mask_of(POLICIES[version]))) == 0


def ablation(entries: DataFrame, version: int = PRODUCTION) -> DataFrame:
    """Per rule of a policy: rows that fail it, rows that only it rejects, rows kept with and without it.

    The ledger is first folded to its distinct bit patterns, at most 2 to the number of rules.
    """
    rules, order = POLICIES[version], list(RULES)
    mask = mask_of(rules)
    patterns = entries.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("_b")).agg(F.count("*").alias("_n"))
    named = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << order.index(r)).cast("long").alias("bit"))
                                for r in rules])).alias("_r")
    counted = lambda hit: F.sum(F.when(hit, F.col("_n")).otherwise(F.lit(0))).alias
    bit, b = F.col("_r.bit"), F.col("_b")
    return patterns.select("*", named).groupBy(F.col("_r.rule").alias("rule")).agg(
        counted(b.bitwiseAND(bit) != 0)("n_failed"),
        counted(b == bit)("n_only"),
        counted(b == 0)("n_kept"),
        counted(b.bitwiseAND(F.bitwise_not(bit)) == 0)("n_kept_without"),
    )


def keep_good(docs: DataFrame, version: int = PRODUCTION, text: str = "text") -> DataFrame:
    """The input rows, columns unchanged, that the policy keeps."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    entries = ledger(docs.select(row, F.col(f"`{text}`").alias("_text")), "_text", ("_row",))
    return entries.where(passes(version)).select("_row.*")
