"""The registered queries against their SQL, and the pipeline against a plain version."""

import hashlib
import re

import corpus_pipeline
import public_tokenizers
import pytest
from oracle import compare, connect
from test_operators import base_secrets, measures, reach
from tokenizers import Tokenizer

from vintagewise.llm import mixing, quality, secrets
from vintagewise.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_matches_sql(spark, name):
    assert compare(QUERIES[name].run(spark, SF), connect(SF), QUERIES[name].sql) == []


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_every_document_once(spark, name):
    ids = [r.doc_id for r in QUERIES[name].run(spark, SF).select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())


def test_pipeline_equals_plain_python(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {}
    for i, r in docs.items():
        n, chars, symbols, lines, again, repeated = measures(r.text)
        if not (n < 50 or 100 * repeated > 50 * n or 10 * symbols > n or 10 * again > 4 * lines or not 3 * n <= chars <= 10 * n):
            good[i] = r.text
    low = reach(good)
    kept = {i: t for i, t in good.items() if low[i] == i}
    for i, text in kept.items():
        for _, a, b in reversed(base_secrets(text)):
            text = text[:a] + "[SECRET]" + text[b:]
        kept[i] = text
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    frame = spark.createDataFrame([(i, t, docs[i].source) for i, t in kept.items()], "doc_id bigint, text string, source string")
    copies = {r.row.doc_id: r.copies for r in mixing.mix(frame, keep=["doc_id"]).collect()}
    want = []
    for i, text in kept.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        want += [(i, ids, hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())] * copies[i]
    got = [(r.doc_id, r.ids, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want) and len(got) > 50


def test_stages_keep_the_columns_and_take_odd_rows(spark, odd, nothing):
    for docs in (odd, nothing):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
            assert docs.columns == columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_rules_of_the_plain_version_are_all_rules():
    assert len(quality.RULES) == 8 and not re.search("bullet|ellips", str(quality.BASE)) and len(secrets.RULES) == 7
