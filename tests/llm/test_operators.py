"""Each operator against a plain version on odd texts, on repeated rows, and on an empty table."""

import functools
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vintagewise.llm import bpe, common, ctw, digest, minhash, mixing, pii, quality, secrets, token_file, warc
from vintagewise.llm.lexicon import Lexicon, compile_lexicon

PATH = public_tokenizers.path("word_bpe_49k.json")


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def shingles(text):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def reach(texts):
    """Smallest id each document reaches, by comparing all pairs."""
    sets, low = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            least = min(low[a], low[b])
            if {low[a], low[b]} != {least}:
                low[a] = low[b] = least
                changed = True
    return low


def test_minhash_groups(odd, by_id):
    got = {r.doc_id: r for r in minhash.linked(odd).collect()}
    low = reach(by_id)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(shingles(t)), low[i], low[i] == i) for i, t in by_id.items()}


def test_minhash_of_a_chain_and_a_crowd(spark):
    """Neighbours of a chain are alike, its ends are not; a crowd of near copies, some too far from each other."""
    base = [f"w{i}" for i in range(200)]
    texts = {i: " ".join(base[4 * i:] + [f"t{j}" for j in range(4 * i)]) for i in range(12)}
    for i in range(60):
        words_ = [f"c{j}" for j in range(150)]
        for k in range(i % 6):
            words_[(17 * i + 23 * k) % 150] = f"e{i}x{k}"
        texts[100 + i] = " ".join(words_)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    low = reach(texts)
    assert {r.doc_id: r.component_id for r in minhash.linked(df).collect()} == low
    assert {r.doc_id for r in minhash.deduplicated(df).collect()} == {i for i in low if low[i] == i}


def test_minhash_nulls_and_nothing(spark, nothing):
    assert minhash.linked(nothing).count() == 0 and minhash.deduplicated(nothing).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f")],
                               "doc_id bigint, text string")
    got = [(r.doc_id, r.component_id, r.kept) for r in minhash.linked(df).collect()]
    assert sorted(got, key=str) == [(2, 2, True), (2, 2, True), (None, None, True), (None, None, True)]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    shared, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    x, y = (minhash.signature(np.unique(np.concatenate([shared, own])), 1024) for own in (a, b))
    assert abs((x == y).mean() - 0.6) < 0.06


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("lexicon_words", [0, 50, 100_000])
def test_bpe_equals_the_library(odd, by_id, tokenizer, lexicon_words):
    ids = bpe.encode(odd, PATH, lexicon_words=lexicon_words)
    assert ids.columns == [*odd.columns, "ids"]
    for r in bpe.decode(ids, PATH).collect():
        want = tokenizer.encode(by_id[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == want
        assert r.decoded == tokenizer.decode(want, skip_special_tokens=False)


def test_bpe_of_nothing_and_of_a_taken_name(odd, nothing):
    assert bpe.decode(bpe.encode(nothing, PATH), PATH).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(odd, PATH, column="row")


def test_lexicon_is_small_and_exact(tmp_path):
    stems = [f"{a}{b}".encode() for a in "abcdefgh" for b in "klmnop"]
    entries = sorted((s + e, [len(s), i]) for s in stems for i, e in enumerate([b"", b"ing", b"ings", b"ed"]))
    file = tmp_path / "lexicon"
    file.write_bytes(compile_lexicon(entries))
    found = Lexicon(str(file))
    assert found.find([w for w, _ in entries] + [b"zz", b"a", b"akin"]).tolist() == [*range(len(entries)), -1, -1, -1]
    assert found.final.size < 20  # endings are shared
    assert [found.ids[found.offsets[i]:found.offsets[i + 1]].tolist() for i in range(3)] == [c for _, c in entries[:3]]
    with pytest.raises(ValueError):
        compile_lexicon([(b"b", []), (b"a", [])])


def measures(text):
    w = words(text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(quality.SYMBOLS, text or "")), len(lines), len(lines) - len(set(lines)), len(covered))


def test_quality_measures_and_policies(odd, by_id):
    entries = quality.ledger(odd)
    for r in entries.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == measures(by_id[r.doc_id])
        env = r.asDict()
        for i, rule in enumerate(quality.RULES.values()):
            assert bool(r.fail_bits >> i & 1) == eval(rule, {}, env)
    kept = {r.doc_id for r in entries.where(quality.passes()).collect()}
    good = quality.keep_good(odd)
    assert good.columns == odd.columns and {r.doc_id for r in good.collect()} == kept and 0 < len(kept) < len(by_id)
    for r in quality.ablation(entries).collect():
        without = [n for n in quality.POLICIES[quality.PRODUCTION] if n != r.rule]
        mask = quality.mask_of(tuple(without))
        assert r.n_kept == len(kept)
        assert r.n_kept_without == sum(x.fail_bits & mask == 0 for x in entries.collect()) == r.n_kept + r.n_only


def test_quality_of_nothing(nothing):
    assert quality.ledger(nothing).count() == quality.keep_good(nothing).count() == quality.ablation(quality.ledger(nothing)).count() == 0


def test_token_files(odd, by_id, tokenizer, tmp_path):
    manifest = token_file.write_tokens(odd, PATH, end=2, folder=str(tmp_path / "tokens"), length=16, rows=4)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_file.read_documents(manifest).collect()}
    start, want = 0, {}
    for i in sorted(by_id):
        ids = [*tokenizer.encode(by_id[i] or "", add_special_tokens=False).ids, 2]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want
    shard = manifest.orderBy("shard").first()
    file = token_file.TokenFile(shard.file)
    n, rows = shard.n_tokens, -(-shard.n_tokens // 16)
    flat = np.concatenate(list(file.pieces(0, n)))
    laid = np.concatenate([file.sequence(k) for k in range(rows)])
    mask = np.concatenate([file.mask(k) for k in range(rows)])
    assert (laid[:n] == flat).all() and not laid[n:].any() and mask.sum() == n and mask[:n].all()
    assert not file.sequence(0).flags.owndata


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_units_of_slices_encode_as_the_library_does(tokenizer, kind):
    draw = random.Random(7)
    letters = [*"abXYZ019.,;'s<|>\t\n\x0b\x0c\x00\x1c\x7f\x85\xa0éÉßΣσİĸ\u0338\u0307\u3000中文한😀", "<|endoftext|>", "'re", "'LL", "<|", " ", "  "]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(30))) for _ in range(4000)] + [None, "", " ", "\u0338>"]
    encoder = token_file.UnitEncoder(PATH, 2)
    for part in common.slices([pa.record_batch({"text": pa.array(texts, kind)})], limit=20_000):
        counts, ids = encoder(part.column("text"))
        cut = np.split(ids, np.cumsum(counts)[:-1])
        wanted = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in part.column("text").to_pylist()]
        assert [c.tolist() for c in cut] == wanted


def test_token_files_of_nothing_and_repeats(spark, nothing):
    assert token_file.read_documents(token_file.write_tokens(nothing, PATH, end=2)).count() == 0
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id bigint, text string")
    got = token_file.read_documents(token_file.write_tokens(df, PATH, end=2)).collect()
    assert sorted((r.doc_id or 0, r.start, r.n_tokens) for r in got) == [(0, 0, 1), (1, 1, 2), (1, 3, 2)]


def test_context_tree_scores(odd, by_id):
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter()
    for i, t in by_id.items():
        if not out(i):
            counts.update([*(t or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    total = 0.0
    for r in ctw.score(odd, ctw.fold("doc_id") == 1).collect():
        tokens = [*(by_id[r.doc_id] or "").encode().lower().split(), None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(r.doc_id), len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens))
        assert r.score < 0 and r.n_bytes == len(ctw.spelled((by_id[r.doc_id] or "").encode()))
        total += r.bits_per_byte
    assert total / len(by_id) < 8


def test_context_tree_of_nothing(nothing):
    assert ctw.score(nothing, F.lit(False)).count() == 0


def plain_tree(learnt, text, depth=5):
    """log10 probability of the text by the recursion: the weight of the root with one more decision, over that without."""
    counts, children = Counter(), {}

    def steps(spelled):
        for i, byte in enumerate(spelled):
            context = (b"\n" * depth + spelled)[i:i + depth][::-1]
            for level in range(8):
                yield 1 << level | byte >> 8 - level, context, byte >> 7 - level & 1

    for t in learnt:
        for node, context, bit in steps(t):
            for d in range(depth + 1):
                counts[node, context[:d], bit] += 1
                if d:
                    children.setdefault((node, context[:d - 1]), set()).add(context[:d])

    def own(node, context, more=(0, 0)):
        a, b = counts[node, context, 0] + more[0], counts[node, context, 1] + more[1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @functools.cache
    def below(node, context):
        return sum(weight(node, c) for c in children.get((node, context), ()))

    @functools.cache
    def weight(node, context):
        if len(context) == depth:
            return own(node, context)
        return np.logaddexp(own(node, context), below(node, context)) - math.log(2)

    def told(node, context, bit, d=0):
        mine = own(node, context[:d], (1 - bit, bit))
        if d == depth:
            return mine
        rest = below(node, context[:d]) - weight(node, context[:d + 1])
        return np.logaddexp(mine, rest + told(node, context, bit, d + 1)) - math.log(2)

    return sum(told(*step) - weight(step[0], b"") for step in steps(text)) / math.log(10)


@pytest.mark.parametrize("strings, group", [(0, 8), (20, 1), (1 << 20, 1 << 16)])
def test_context_tree_scores_are_the_recursion_over_bytes(spark, strings, group):
    texts = ["call 1500 then 1600", "call 2500 then  2600 ok", "call 1500 then 1600", None, "", "Größe ΑΣ größe αβ", "call 1501 then 2600",
             "one more 日本語", "call 1500 now"]
    rows = [*enumerate(texts), (0, texts[0]), (None, "call 15")]
    out = lambda i: i in (6, 7, 8)
    learnt = [ctw.spelled((t or "").encode()) for i, t in rows if not out(i)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    scores = ctw.score(df, F.coalesce(F.col("doc_id"), F.lit(0)).isin(6, 7, 8), strings=strings, group=group).collect()
    assert len(scores) == len(rows)
    by_id = dict(rows)
    for r in scores:
        assert r.held_out == out(r.doc_id)
        assert r.score == pytest.approx(plain_tree(learnt, ctw.spelled((by_id[r.doc_id] or "").encode())), rel=1e-9)


def test_context_tree_tells_five_bytes_back_and_sums_to_one(spark):
    learnt = [(0, f"{d}abcd{d} " * 40) for d in "0123456789é"]
    asked = [(1, "7abcd7"), (1, "7abcd8")]
    rows = ctw.score(spark.createDataFrame(learnt + asked, "doc_id int, text string"), F.col("doc_id") == 1).where("held_out").collect()
    seven, eight = sorted((r.score for r in rows), reverse=True)
    assert seven - eight > 1  # merged classes told all digits alike
    cell = np.sort(ctw.cells([b"abcdefg\n"]))[:1] >> 8 << 8 | np.arange(256)
    n = np.arange(256) % 7
    total = np.zeros(256)
    for level in range(8):
        code, zeros, ones, place, bit = ctw._decisions(cell, n, level)
        levels = ctw.climb(code, zeros, ones, ctw._estimate(zeros, ones), ctw.DEPTH)[4]
        going, found = ctw.descend(levels, np.ones(code.size), np.zeros(code.size))
        one = (found + going * (ones + 0.5) / (zeros + ones + 1))[place]
        total += np.log(np.where(bit == 1, one, 1 - one))
    assert np.exp(total).sum() == pytest.approx(1)


def test_warc_round_trip(spark):
    rows = [(3, "http://a/ b\r\nX: y", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (4, "u", ""), (5, "u", "\r\n\r\nWARC/1.1" * 9),
            (None, "u", "<p>é</p>"), (1, None, "<p>é</p>"), (9, "u", "z" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("file", F.lit(1))
    index = warc.write_archives(pages)
    got = warc.read_records(index).collect()
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = min(x for x, _, h in rows if x is not None and (h or "") == (html or ""))
        again = i != first
        want.append((i, len(data), "revisit" if again else "response", first if again else None, None if again else data))
    assert sorted(map(str, want)) == sorted(str((r.page_id, r.payload_bytes, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload is not None else None)) for r in got)
    some = index.where("page_id in (5, 9)")
    assert {r.page_id for r in warc.read_records(some).collect()} == {5, 9}
    kept = warc.deduplicated(pages, least=1).where("record_type = 'revisit'").collect()
    assert {r.page_id for r in kept} == {3, None}
    assert warc.read_records(warc.write_archives(pages.limit(0))).count() == 0


def test_mix_follows_the_targets(spark, odd, by_id, nothing):
    got = mixing.mix(odd, keep=["doc_id", "source"]).collect()
    assert len(got) == len(by_id) and all(r.size == len(words(by_id[r.row.doc_id])) for r in got)
    targets = {r.row.source: (r.source_size, r.target) for r in got}
    assert sum(t for _, t in targets.values()) == pytest.approx(sum(s for s, _ in targets.values()))
    assert all(t <= 3 * s + 1e-9 for s, t in targets.values()) and all(0 <= r.copies <= 3 for r in got)
    for source, (size, target) in targets.items():
        own = [r for r in got if r.row.source == source]
        assert sum(r.copies for r in own) == pytest.approx(len(own) * target / size, abs=1)
    rows = mixing.mixed(odd)
    assert rows.columns == odd.columns and rows.count() == sum(r.copies for r in got)
    assert sorted(map(str, mixing.mix(odd.repartition(5), keep=["doc_id", "source"]).collect())) == sorted(map(str, got))
    assert mixing.mix(nothing).count() == mixing.mixed(nothing).count() == 0


def test_mix_words_come_near_targets(spark):
    rows = [(i, "w " * (i * 37 % 90 + 10), f"s{i % 4 if i % 3 else 0}") for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), keep=["source"])
    for r in got.groupBy("row.source").agg(F.sum(F.col("copies") * F.col("size")).alias("n"), F.max("target").alias("t")).collect():
        assert abs(r.n - r.t) <= 300


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in match.split("."))
    if kind == "card":
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def test_identifiers_equal_plain_patterns(odd, by_id):
    for r in pii.identifiers(odd).collect():
        for kind, pattern in BASE.items():
            want = [] if (by_id[r.doc_id] or "")[:9] == "x" * 9 else [
                (m.start(), m.end()) for m in re.finditer(pattern, by_id[r.doc_id] or "") if holds(kind, m[0])]
            assert [(s.start, s.end) for s in r[kind]] == want, (kind, r.doc_id)


def test_terms_that_reveal_an_entity_are_hidden(spark, nothing):
    filler = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod"
    rows = [(i, f"{filler} wide{i} call zanzibar about ann@x.org please kind{i} {filler}") for i in range(6)]
    rows += [(100 + i, f"{filler} plain text number {i} call please about {filler}") for i in range(60)]
    rows += [(200 + i, "copied opalescent bob@y.org words") for i in range(5)]  # one surrounding only
    found = {r.doc_id: r for r in pii.sanitised(pii.spans(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()}
    text = dict(rows)
    named = lambda i: {(s.kind, text[i][s.start:s.end]) for s in found[i].spans}
    assert named(0) == {("email", "ann@x.org"), ("removed", "zanzibar")}
    assert found[0].sanitised == text[0].replace("ann@x.org", "[EMAIL]").replace("zanzibar", "[REMOVED]")
    assert named(100) == set() and found[100].sanitised == text[100]
    assert named(200) == {("email", "bob@y.org")}
    assert pii.spans(nothing).count() == 0


def test_terms_that_reveal_rare_entities_are_hidden(spark):
    rows = [(i, f"plain{i} words quixotic of eve@z.org more{i} text") for i in range(2)]  # two surroundings
    rows += [(10 + i, f"plain{i} words umbrella of person{i}@q.org more{i} text") for i in range(3)]  # each value once
    rows += [(20 + i, f"call plain{i} words of 10.{i}.0.1 more{i} text") for i in range(9)]  # too many entities
    rows += [(30 + i, "copied opalescent bob@y.org passage") for i in range(5)]
    text = dict(rows)
    found = pii.spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    named = {r.doc_id: {(s.kind, text[r.doc_id][s.start:s.end]) for s in r.spans} for r in found}
    assert all(named[i] == {("email", "eve@z.org"), ("removed", "quixotic")} for i in range(2))
    # umbrella reveals q.org for certain; other terms beside it may be generalised too
    assert all(named[10 + i] >= {("email", f"person{i}@q.org"), ("removed", "umbrella")} for i in range(3))
    assert all(named[20 + i] == {("ip", f"10.{i}.0.1")} for i in range(9))
    assert all(named[30 + i] == {("email", "bob@y.org")} for i in range(5))


def test_sanitised_keeps_rows(odd, by_id):
    assert {r.doc_id for r in pii.sanitised(pii.spans(odd)).collect()} == set(by_id)


def test_digest_classes_are_window_entropies():
    rng = np.random.default_rng(0)
    for n, k in ((64, 1), (65, 3), (500, 30), (700, 256)):
        data = rng.integers(0, k, n).astype(np.uint8)
        found = digest.entropy_classes(data)
        for i in range(n - 63):
            c = np.bincount(data[i:i + 64], minlength=256)
            c = c[c > 0] / 64
            assert abs(found[i] - 1023 * -(c * np.log2(c)).sum() / 6) <= 1.001


def test_digests(odd, by_id):
    order = sorted(by_id, reverse=True)
    got = {r.doc_id: r for r in digest.compared(odd, buckets=5).collect()}
    assert set(got) == set(by_id)
    assert {i: r.fingerprint for i, r in got.items()} == {r.doc_id: r.fingerprint for r in digest.fingerprints(odd.select("doc_id", "text")).collect()}
    for i, following in zip(order, [*order[1:], order[0]], strict=True):
        text, other, r = by_id[i] or "", by_id[following] or "", got[i]
        half = len(text) // 2
        new = text[:len(text) - half] + other[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if new == text:
            assert r.fingerprint == r.edited_fingerprint and r.near_edited == 1
    alike = [r.fingerprint for i, r in got.items() if by_id[i] == by_id[35]]
    assert len(alike) == 2 and len(set(alike)) == 1


def test_digests_of_one_and_of_nothing(spark, nothing):
    assert digest.compared(nothing, buckets=3).count() == 0
    one = spark.createDataFrame([(None, "a" * 200)], "doc_id bigint, text string")
    assert digest.compared(one, buckets=3).count() == 1
    one = spark.createDataFrame([(4, "abcdefg " * 40)], "doc_id bigint, text string")
    assert digest.compared(one, buckets=3).first().near_next == 1


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def test_secrets_equal_plain_patterns(odd, by_id, nothing):
    for r in secrets.secret_spans(odd).collect():
        assert [tuple(s) for s in r.secrets if s.kind in secrets.BASE] == base_secrets(by_id[r.doc_id] or "")
    assert secrets.secret_spans(nothing).count() == secrets.masked(nothing).count() == 0
    with pytest.raises(ValueError):
        secrets.secret_spans(odd, column="row")


def test_secrets_are_masked(spark):
    key = "ghp_" + "a1" * 18
    rows = [(1, f"é {key} and token='{key}' x", 9), (2, "clean", 5), (3, None, None)]
    got = {r.doc_id: r for r in secrets.masked(spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")).collect()}
    assert got[1].text == "é [SECRET] and [SECRET]' x" and got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[2].n_chars, got[3].text, got[3].n_chars) == ("clean", 5, None, None)
