"""Lexical search, collocations and merge rounds against plain versions on odd texts, ties, repeats and nothing."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from vintagewise.llm import bit_slices, collocations, piece_bpe

PATH = public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(docs, items, top):
    """docs: (id, text) rows; items: id -> text. Rows (item, rank, id, score), by scoring every document."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    counted = [(i, Counter(cut(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items.items():
        found = []
        for i, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in cut(text) if c[t])
            if score:
                found.append((-score, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:top], 1)]
    return out


@pytest.fixture(scope="module")
def items(spark, texts):
    rnd = random.Random(4)
    words = " ".join(t for t in texts if t and len(t) < 3000).split()
    asked = {n: " ".join(rnd.choices(words, k=rnd.randint(1, 30))) for n in range(30)}
    asked |= {100: None, 101: "", 102: "nowhereinanytext", 103: "x" * 50_000, 104: "日本語 Jörg same SAME same", 105: "!!"}
    return asked


def test_search_equals_scoring_everything(spark, odd, texts, items):
    rows = [(7 * i % 101, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(n, t, 1) for n, t in items.items()], "item_id int, text string, rank int")
    for top in (3, 20):
        got = [tuple(r) for r in bit_slices.search(odd, frame, top).collect()]
        assert sorted(got) == sorted(plain_search(rows, items, top))


def test_search_takes_ties_repeats_and_null_ids(spark):
    rows = [(i % 40, "one two three" if i % 3 else "one two three four one") for i in range(120)] + [(None, "two five"), (None, "six two")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    items = {1: "one two", 2: "five", 3: "four three"}
    frame = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    got = sorted(tuple(r) for r in bit_slices.search(docs, frame).collect())
    want = plain_search([(-1 if i is None else i, t) for i, t in rows], items, 20)
    assert got == sorted((a, b, None if c == -1 else c, d) for a, b, c, d in want)


def test_search_in_groups_of_items_and_in_nothing(spark, odd, texts, items, nothing, monkeypatch):
    frame = spark.createDataFrame(list(items.items()), "item_id int, text string")
    monkeypatch.setattr(bit_slices, "ITEMS", 20)
    rows = [(7 * i % 101, t) for i, t in enumerate(texts)]
    assert sorted(map(tuple, bit_slices.search(odd, frame, 5).collect())) == sorted(plain_search(rows, items, 5))
    assert bit_slices.search(nothing, frame).count() == 0 and bit_slices.search(odd, frame.limit(0)).count() == 0


def test_bounds_never_fall_below_scores():
    rnd = random.Random(2)
    texts = [" ".join(rnd.choices([f"w{j}" for j in range(80)], k=rnd.choice([3, 40, 900]))).encode() for _ in range(200)]
    counts = [Counter(bit_slices.terms(t)) for t in texts]
    total = sum(sum(c.values()) for c in counts)
    weights = {f"w{j}".encode(): 100 + j for j in range(80)} | {b"absent": 77}
    asked = [(n, [rnd.choice(list(weights)) for _ in range(12)]) for n in range(20)]
    group, tight = bit_slices._Item(asked, weights), []
    for width, inside, lengths, rows, _, _ in bit_slices._blocks(texts):
        m = bit_slices.measure(lengths, len(texts), total)
        bounds = group.bounds(width, rows, lengths, m)
        for i, (_, found) in enumerate(asked):
            for j, d in enumerate(inside.tolist()):
                exact = sum(weights[t] * bit_slices.gain(counts[d][t], int(m[j])) for t in found if counts[d][t])
                assert bounds[i, j] >= exact
                tight.append((exact, bounds[i, j]))
    exact, bound = np.sum(tight, axis=0)
    assert exact > 0.9 * bound


def test_only_documents_that_may_rank_are_scored(spark):
    """Of 400 documents that all hold the common word, few are scored exactly."""
    rnd = random.Random(8)
    rows = [(i, "common " + " ".join(f"v{rnd.randint(0, 3000)}" for _ in range(100)) + (" rare" * (i % 7) if i % 50 == 1 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame = spark.createDataFrame([(1, "rare common v7")], "item_id int, text string")
    seen = spark.sparkContext.accumulator(0)
    real = bit_slices.terms

    def counting(text):
        seen.add(1)
        return real(text)

    index = bit_slices.build_index(docs)
    bit_slices.terms = counting
    try:
        got = sorted(map(tuple, bit_slices.search(docs, frame, 3, index=index).collect()))
    finally:
        bit_slices.terms = real
    assert got == sorted(plain_search(rows, {1: "rare common v7"}, 3)) and seen.value < 100


def plain_collocations(rows, longest, least, top):
    """rows: (text, lang). Tuples as the operator's rows."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i:i + size])] += 1
    out = []
    for lang, found in counts.items():
        kept = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        longer = defaultdict(int)
        for p, a in kept.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i:i + size]] = max(longer[p[i:i + size]], a)
        ranked = []
        for p, a in kept.items():
            score, _, l, r = min((10**6 * a * a // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            if 100 * longer[p] < 50 * a:
                ranked.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, rank, p.decode(), -a, l, r, totals[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(ranked)[:top], 1)]
    return out


@pytest.fixture(scope="module")
def chatter():
    rnd = random.Random(9)
    words = ["New", "york", "city", "a", "b", "é", "日本", "x\x00y", "\x1c", "long" * 400]
    rows = [(" ".join(rnd.choices(words, weights=[9, 8, 7, 5, 5, 3, 3, 2, 2, 1], k=rnd.randint(0, 60))).replace("a b", rnd.choice(["a b", "a, b", "a\tb", "a\n\nb"])),
             rnd.choice(["en", "en", "de", None, "und"])) for _ in range(150)]
    return rows + [(None, "en"), ("", None), (" . , ", "de"), ("one two three " * 3000, "fr")] + rows[:20]


@pytest.mark.parametrize(("longest", "shard"), [(3, 400_000), (3, 40), (4, 400_000), (2, 400_000)])
def test_collocations_equal_counting_everything(spark, chatter, longest, shard):
    docs = spark.createDataFrame([(t, c, 1, 2) for t, c in chatter], "text string, lang string, n int, phrase int").repartition(4)
    for least, top in ((10, 2000), (3, 15)):
        got = [tuple(r) for r in collocations.mine(docs, longest, least, top, shard=shard).collect()]
        assert sorted(got) == sorted(plain_collocations(chatter, longest, least, top)) and got


def test_collocations_of_odd_texts_and_of_nothing(spark, odd, nothing, texts):
    got = sorted(tuple(r) for r in collocations.mine(odd, least=2).collect())
    assert got == sorted(plain_collocations([(t, "en") for t in texts], 3, 2, 2000))
    assert collocations.mine(nothing).count() == 0


def test_maps_admit_every_frequent_phrase_when_cells_are_few(spark, chatter, monkeypatch):
    monkeypatch.setattr(collocations, "MOST_CELLS", 64)
    docs = spark.createDataFrame(chatter, "text string, lang string")
    assert sorted(map(tuple, collocations.mine(docs).collect())) == sorted(plain_collocations(chatter, 3, 10, 2000))


def test_small_slices_and_numberings_change_nothing(spark, chatter, monkeypatch):
    for name, value in {"SLICE_BYTES": 300, "NUMBERED": 6, "TOLD": 5, "AT_ONCE": 2, "COUNTED": 3}.items():
        monkeypatch.setattr(collocations, name, value)
    docs = spark.createDataFrame(chatter, "text string, lang string").coalesce(2)
    assert sorted(map(tuple, collocations.mine(docs, shard=30).collect())) == sorted(plain_collocations(chatter, 3, 10, 2000))


def test_double_array_finds_its_keys_and_nothing_else():
    rnd = np.random.default_rng(1)
    keys = list({tuple(rnd.integers(1, 60, rnd.integers(1, 5)).tolist()) for _ in range(4000)} | {(59,) * 6})
    trie = collocations.DoubleArray(np.array([k + (0,) * (6 - len(k)) for k in keys]), 60)
    place = {k: i for i, k in enumerate(keys)}
    probes = keys + [tuple(rnd.integers(0, 60, rnd.integers(1, 7)).tolist()) for _ in range(8000)]
    for size in range(1, 7):
        group = [p for p in probes if len(p) == size]
        states = np.zeros(len(group), np.int64)
        alive = np.ones(len(group), bool)
        for k in range(size):
            states = np.where(alive, trie.step(np.maximum(states, 0), np.array([p[k] for p in group])), -1)
            alive = states >= 0
        got = np.where(alive, trie.accept[np.maximum(states, 0)], -1)
        assert got.tolist() == [place.get(p, -1) for p in group]
    # no two states share a slot
    assert np.count_nonzero(trie.check >= 0) == len({k[:i] for k in keys for i in range(1, len(k) + 1)})


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_pieces_equal_the_library(odd, by_id, library):
    rows = piece_bpe.decode(piece_bpe.encode(odd, PATH), PATH)
    assert rows.columns == [*odd.columns, "ids", "decoded"]
    for r in rows.select("doc_id", "ids", "decoded").collect():
        want = library.encode(by_id[r.doc_id] or "", num_threads=1, add_eos=True)
        assert (r.ids, r.decoded) == (want, library.decode(want))


def strange_texts(library):
    rnd = random.Random(6)
    letters = ["a", "e", "r", "s", "t", "i", "n", " ", "  ", "▁", "\n", "\r", "\t", ".", ",", "é", "日", "\U0001f600", "²", "_", "0", "9", "(", ";", "\x00", "́", "the"]
    pieces = [library.id_to_piece(i) for i in range(259, 32000)]
    yield from ("".join(rnd.choices(letters, k=rnd.randint(0, 40))) for _ in range(6000))
    yield from ("".join(rnd.choices(letters[:rnd.randint(1, len(letters))], k=rnd.randint(100, 500))) for _ in range(150))
    yield from ("".join(rnd.choices(pieces, k=rnd.randint(1, 12))) for _ in range(6000))
    yield from ("".join(rnd.choices(pieces, k=rnd.randint(60, 150))).replace("▁", "") for _ in range(100))
    yield from ("x" * 5000, " " * 3001, "abc" * 2000, "=" * 2000 + " " * 77, "ab ab" * 50, "aye" * 300, "\t" * 300, " ", "\n", "▁", "-" * 999)


@pytest.mark.parametrize("remembered", [32 << 20, 1 << 16])
def test_merge_rounds_equal_the_library_on_strange_texts(library, monkeypatch, remembered):
    monkeypatch.setattr(piece_bpe, "REMEMBERED_BYTES", remembered)
    texts = list(strange_texts(library))
    encoder = piece_bpe._Encoder(piece_bpe.Pieces(PATH))
    for i in range(0, len(texts), 400):
        part = texts[i:i + 400]
        offsets, ids = encoder([t.encode() for t in part])
        for text, a, b in zip(part, offsets, offsets[1:], strict=False):
            assert ids[a:b].tolist() == [*library.encode(text, num_threads=1), 2], text


def test_any_ids_decode_as_in_the_library(spark, library):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([rnd.randint(0, 258), rnd.randint(259, 31999)]) for _ in range(rnd.randint(0, 12))]) for i in range(3000)]
    rows += [(-1, [1, 1, library.piece_to_id("▁the"), 2]), (-2, [library.piece_to_id("▁"), library.piece_to_id("▁the")]), (-3, [])]
    frame = spark.createDataFrame(rows, "doc_id int, ids array<int>")
    for r in piece_bpe.decode(frame, PATH).collect():
        assert r.decoded == library.decode(list(r.ids)), r.ids


def test_pieces_of_nothing_and_of_clashing_columns(spark, nothing):
    assert piece_bpe.decode(piece_bpe.encode(nothing, PATH), PATH).count() == 0
    with pytest.raises(ValueError, match="ids"):
        piece_bpe.encode(nothing.withColumn("ids", F.lit(1)), PATH)


@pytest.mark.parametrize("least", [1, 10, 300])
def test_packed_cells_are_counted_whole(least):
    """Counts travel in two bytes for a cell (three for high counts); their sums decide as plain sums do."""
    rng, bits = np.random.default_rng(least), 17
    dealt = [rng.integers(0, 1 << bits, 40_000), rng.integers(0, 300, 40_000), np.array([0, 511, 512, 1 << 16, (1 << bits) - 1] * 400),
             np.zeros(0, np.int64)]
    packed = [collocations._packed_counts([cells.astype(np.uint32)], bits, least) for cells in dealt]
    for cells, batch in zip(dealt, packed, strict=True):
        parts = np.unique(cells >> bits - collocations.PART_BITS).size
        assert batch.num_rows == parts and sum(len(g) for g in batch.column("gaps").to_pylist()) <= np.unique(cells).size + 3 * parts
    rows = pa.Table.from_batches(packed).sort_by("part")
    got = np.zeros(1 << bits, bool)
    for batch in collocations._frequent_cells(iter(rows.to_batches(max_chunksize=7)), bits, least):
        for part, words in zip(batch.column("part").to_pylist(), batch.column("words").to_pylist(), strict=True):
            got.reshape(1 << collocations.PART_BITS, -1)[part] = np.unpackbits(np.frombuffer(words, np.uint8), bitorder="little")
    assert (got == (np.bincount(np.concatenate(dealt), minlength=1 << bits) >= least)).all()


def test_candidates_as_one_number():
    numbers = np.array([3, 1, 2, 3, 1, 2, 0, (1 << collocations.PLACE) - 1, 1, 2])
    keys = collocations._keys(numbers, np.array([0, 3, 7]), 3)
    parts = [[int(k) >> collocations.PLACE * i & (1 << collocations.PLACE) - 1 for i in range(3)] for k in keys]
    assert sorted(parts) == sorted(collocations._distinct(numbers, np.array([0, 3, 7]), 3)) == [[3, 1, 2], [(1 << 21) - 1, 1, 2]]


@pytest.mark.parametrize("text", ["", ".", " \t ", "A b\tB..c ,d\n\x0be", "a  b;", "\u00c9t\u00e9 \u00a0x\x1cy\x85 z", "x" * 70_000 + " y"])
def test_words_are_cut_without_objects(text):
    """As bytes.split cuts them, but as one array: six passes over the text spent a third of their time on Python words."""
    data = text.encode()
    plain = re.sub(rb"[.,;:!?\n\x0b\x0c\r]", b" . ", data.lower()).split()
    cut = collocations.tokens(data)
    assert isinstance(cut, pa.LargeBinaryArray) and cut.to_pylist() == plain
    numbered = collocations._Numbered("en")
    numbers, spelled = numbered(cut), list(numbered.number)
    assert [spelled[i] for i in numbers.tolist()] == plain and (numbered(cut) == numbers).all()
    assert (numbered.hashes[1:] == collocations._hashes(spelled[1:], numbered.seed)).all()
