"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Four kinds of identifiers are found by pattern. Each found value is a protected entity, and so is its holder (domain,
network, issuer or block of numbers), which pools values that are seen once each. The corpus tells which words reveal an
entity: with documents as events, a term whose pointwise mutual information with an entity comes within REMOVE_BITS of the
entity's whole information content (that is, the entity follows from the term with probability 2 ** -REMOVE_BITS or more)
is removed from the entity's documents, one within GENERALISE_BITS is generalised. The probability is smoothed: of the
different surroundings in which the term is seen beside the entity, DISCOUNTS are taken off, so that copies of one passage
are one observation, and one observation is little evidence.

A pattern's matches and the pieces between them give every match's place; nothing is searched twice.

Defined results: a null or empty text has no spans; repeated rows have equal spans; rows of one id and text count as
documents each; an empty table gives an empty one; further columns are not looked at. Spans count code points, the end
exclusive. A term span that meets an identifier's is left out.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored

NEAR_WORDS = 8  # terms on each side of an entity that count as beside it
NEAR_CHARS = 400  # of text looked at for them
DISCOUNTS = {1: 0.9, 2: 0.5}  # taken off so many different surroundings; from three on the share counts as it is
REMOVE_BITS, GENERALISE_BITS = 1.0, 3.0
LEAST_LETTERS = 3  # of a term
FEW_TERMS = 1 << 18  # so many, of NEAR_CHARS at most, every task can hold; more are counted with all others

# Same matches as the plain patterns; possessive repeats and the look behind keep long runs from being tried again from
# every place inside them.
_NAME, _LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{_NAME})|\G){_NAME}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SIGNS = {"email": "@", "ip": ".", "card": None, "phone": "+"}  # a text without it has no match
TERMS = ("removed", "generalised")
KINDS = (*PATTERNS, *TERMS)
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "removed": "[REMOVED]", "generalised": "[WORD]"}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_SPANS = "array<struct<start:int,end:int>>"
_LETTERS = r"[\p{L}\p{N}]"


def _luhn(digits: Column) -> Column:
    def value(i):
        digit = F.substring(digits, -i, 1).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return digit - F.when(digit > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    """The condition a match must meet."""
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        digits = F.translate(match, " -", "")
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def places(text: str, pattern: str, holds, sign: str | None = None) -> Column:
    """Array of (start, end) of the matches for which `holds`, left to right, from what lies between the matches."""
    none = F.array().cast(_SPANS)
    matches, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    zipped = F.zip_with(matches, between, lambda m, before: F.struct(m.alias("m"), before.alias("before")))

    def step(held, x):
        start = held["at"] + F.length(x["before"])
        end = start + F.length(x["m"])
        more = F.array_append(held["spans"], F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(holds(x["m"]), more).otherwise(held["spans"]).alias("spans"))

    # the piece behind the last match has no match beside it
    begun = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    found = F.aggregate(F.filter(zipped, lambda x: x["m"].isNotNull()), begun, step, lambda held: held["spans"])
    may = F.contains(F.col(text), F.lit(sign)) if sign else F.lit(True)
    return F.when(may & F.col(text).rlike(pattern), found).otherwise(none)


def identifiers(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, the text as `text` (null: empty) and one array of spans per kind. No shuffle."""
    raw = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("text"))
    return raw.withColumns({kind: places("text", pattern, lambda m, kind=kind: _holds(kind, m), SIGNS[kind])
                            for kind, pattern in PATTERNS.items()})


def terms(text: Column) -> Column:
    """The words of a text in lower case, in order."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) >= LEAST_LETTERS)


def _surroundings(span: Column) -> Column:
    """Up to NEAR_WORDS terms before and behind a span; a word cut by the look's border is not taken."""
    text, start, end = F.col("text"), span["start"], span["end"]
    left = F.substring(text, F.greatest(start - NEAR_CHARS, F.lit(0)) + 1, F.least(start, F.lit(NEAR_CHARS)))
    left = F.when(start > NEAR_CHARS, F.regexp_replace(left, rf"^{_LETTERS}+", "")).otherwise(left)
    right = F.substring(text, end + 1, F.lit(NEAR_CHARS))
    right = F.when(F.length(text) - end > NEAR_CHARS, F.regexp_replace(right, rf"{_LETTERS}+$", "")).otherwise(right)
    before, behind = terms(left), terms(right)
    return F.concat(F.slice(before, F.greatest(F.size(before) - NEAR_WORDS, F.lit(0)) + 1, F.lit(NEAR_WORDS)),
                    F.slice(behind, 1, NEAR_WORDS))


def disclosing_terms(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """Rows (entity, term, kind): terms that reveal an entity, and whether to remove or to generalise them.

    `found` has entity, doc, surroundings. Terms are counted over all documents, each once per document and summed before
    the shuffle. Information less mutual information is log2(n_term / both), whatever the number of documents; the smoothed
    share is never above `trust`, so pairs it alone rules out are not joined.
    """
    trust = F.lit(1.0)
    for places, off in DISCOUNTS.items():
        trust = F.when(F.col("places") == places, 1 - off / places).otherwise(trust)
    beside = found.select("entity", "doc", F.xxhash64("surroundings").alias("place"), F.explode(F.array_distinct("surroundings")).alias("term"))
    pairs = beside.groupBy("entity", "term").agg(
        F.count_distinct("place").alias("places"), F.count_distinct("doc").alias("both")).withColumn("trust", trust)
    pairs = stored(pairs.where(-F.log2("trust") <= GENERALISE_BITS), "beside")
    wanted = stored(pairs.select("term").distinct(), "terms")
    every = docs.select(F.explode(F.array_distinct(terms(F.coalesce(F.col(text), F.lit(""))))).alias("term"))
    if wanted.count() <= FEW_TERMS:
        every = every.join(F.broadcast(wanted), "term", "left_semi")
    counts = every.groupBy("term").agg(F.count("*").alias("n_term"))
    joined = pairs.join(counts, "term")
    short = F.log2(F.col("n_term") / (F.col("both") * F.col("trust")))
    return joined.where(short <= GENERALISE_BITS).select(
        "entity", "term", F.when(short <= REMOVE_BITS, TERMS[0]).otherwise(TERMS[1]).alias("kind"))


def _entities(kind: Column, value: Column) -> Column:
    """A found value and its holder: domain, network of 256 addresses, issuer's six digits, block of 10,000 numbers."""
    holder = F.when(kind == "email", F.regexp_extract(value, "@.*", 0)).when(kind == "ip", F.regexp_extract(value, r"^.*\.", 0)).when(
        kind == "card", F.substring(value, 1, 6)).otherwise(F.expr("left(value, length(value) - 4)"))
    return F.array(F.concat_ws(":", kind, value), F.concat_ws(":", F.lit("holder"), kind, holder))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _terms_of(kind: str) -> Column:
    return F.transform(F.filter("telling", lambda t: t["kind"] == kind), lambda t: t["term"])


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, `text`, and `spans`, an array of (kind, start, end) by kind, then start."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    key = F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("doc")
    marked = identifiers(rows).withColumn("base", F.concat(*[_of_kind(F.col(kind), kind) for kind in PATTERNS]))
    holders = stored(marked.where(F.size("base") > 0).select(key, "text", "base"), "holders")
    value = F.substring(F.col("text"), F.col("span.start") + 1, F.col("span.end") - F.col("span.start"))
    value = F.when(F.col("span.kind") == "email", F.lower(value)).otherwise(F.regexp_replace(value, r"[^0-9.+]", ""))
    valued = holders.select("doc", "text", F.explode("base").alias("span")).select(
        "doc", "span.kind", value.alias("value"), _surroundings(F.col("span")).alias("surroundings"))
    found = stored(valued.select("doc", F.explode(_entities(F.col("kind"), F.col("value"))).alias("entity"), "surroundings"), "entities")
    telling = stored(disclosing_terms(rows, found, "text"), "telling")
    # by the terms a document has, since an entity of many documents has many terms that most of them lack
    held = holders.select("doc", F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    hidden = stored(held.join(telling, "term").join(found.select("doc", "entity").distinct(), ["doc", "entity"]).groupBy("doc").agg(
        F.collect_set(F.struct("term", "kind")).alias("telling")), "hidden")
    joined = marked.withColumn("doc", key).join(hidden, "doc", "left")

    clear = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    for kind in TERMS:
        joined = joined.withColumn(f"_{kind}", _terms_of(kind))
    # a term that one entity has removed and another generalised is removed
    joined = joined.withColumn(f"_{TERMS[1]}", F.array_except(f"_{TERMS[1]}", f"_{TERMS[0]}"))
    for kind in TERMS:
        at = places("text", f"{_LETTERS}+", lambda m, kind=kind: F.array_contains(f"_{kind}", F.lower(m)))
        joined = joined.withColumn(kind, F.when(F.size(f"_{kind}") > 0, _of_kind(F.filter(at, clear), kind)))
    more = [F.coalesce(kind, F.array().cast("array<struct<kind:string,start:int,end:int>>")) for kind in TERMS]
    return joined.select("doc_id", "text", F.concat("base", *more).alias("spans"))


def sanitised(found: DataFrame) -> DataFrame:
    """The rows of `spans` with each span replaced by its kind's label; of spans that meet, the first is."""
    label = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])

    def step(held, s):
        kept = F.substring(F.col("text"), held["at"] + 1, s["start"] - held["at"])
        out = F.concat(held["out"], kept, label[s["kind"]])
        return F.when(s["start"] >= held["at"], F.struct(s["end"].alias("at"), out.alias("out"))).otherwise(held)

    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begun = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda held: F.concat(held["out"], F.substring(F.col("text"), held["at"] + 1, F.length("text")))
    return found.withColumn("sanitised", F.when(F.size("spans") > 0, F.aggregate(ordered, begun, step, rest)).otherwise(F.col("text")))
