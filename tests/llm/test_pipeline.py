from __future__ import annotations

import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from public_tokenizers import path
from tokenizers import Tokenizer

import __spark_entry__ as registered
import corpus_pipeline
from tamis.llm import mixing, ngram_join, packing, pii, quality_rules
from tamis.llm.oracle import ORACLE
from tests.llm.frames import documents, text_of
from tests.llm.test_ngram_join import _brute
from tests.llm.test_pii import _base

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _corpus():
    texts = {i: text_of(i, 60 + i % 90) for i in range(60)}
    texts |= {100 + i: texts[i] + " end" for i in range(0, 60, 6)}  # near copies
    texts |= {200 + i: "short one" for i in range(5)}
    texts[300] = text_of(300, 80) + " mail me@example.org or 10.0.0.1"
    return texts


def test_stages_work_on_what_the_one_before_kept(spark, folder):
    texts = _corpus()
    documents(spark, [(i, t, "en", f"s{i % 3}") for i, t in texts.items()]).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        kept.append({r.doc_id: r.text for r in docs.collect()})
    clean, distinct, redacted, mixed = kept
    assert clean.keys() == {i for i in texts if not 200 <= i < 300}
    assert distinct.keys() == clean.keys() - {i for i in clean if 100 <= i < 200}
    assert redacted.keys() == distinct.keys()
    assert redacted[300] == texts[300].replace("me@example.org", "<email>").replace("10.0.0.1", "<ip>")
    assert {i: t for i, t in redacted.items() if i != 300} == {i: distinct[i] for i in distinct if i != 300}
    assert mixed.items() <= redacted.items()

    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == mixed.keys()
    for r in rows:
        assert r.doc_tokens == len(tokenizer.encode(redacted[r.doc_id], add_special_tokens=False).ids) + 1
    ends = {}
    for r in rows:
        ends[r.sequence_id] = ends.get(r.sequence_id, 0) + r.length
    assert all(np.log2(n) % 1 == 0 for n in ends.values())


def _plain_redaction(text):
    """Base spans, overlapping ones as one, by the kind of the first."""
    out, end = [], 0
    for start, kind, stop in _base(text or ""):
        if start >= end:
            out += [text[end:start], f"<{pii.KINDS[kind]}>"]
        end = max(end, stop)
    return "".join(out) + text[end:] if out else text


def test_run_equals_the_plain_versions(spark, folder):
    """All stages over all given documents: DuckDB for the rules and the mix, brute force for near
    copies, plain patterns for personal data, the tokenizer itself for the packed ids."""
    rows = pq.read_table(f"{SF_DIR}/documents.parquet")

    def judged(query):
        pq.write_table(rows, f"{folder}/documents.parquet")
        duck = duckdb.connect()
        duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
        result = duck.execute(ORACLE[query])
        names = [column[0] for column in result.description]
        return [dict(zip(names, row)) for row in result.fetchall()]

    clean = {r["doc_id"] for r in judged("op9_quality_rules") if r["kept"]}
    rows = rows.filter(pa.array([i in clean for i in rows["doc_id"].to_pylist()]))
    _, roots = _brute(dict(zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist())), ngram_join.Rule(5, 80))
    rows = rows.filter(pa.array([roots[i] == i for i in rows["doc_id"].to_pylist()]))
    texts = [_plain_redaction(text) for text in rows["text"].to_pylist()]
    rows = rows.set_column(1, "text", pa.array(texts)).set_column(4, "n_chars", pa.array([*map(len, texts)]))
    copies = {r["doc_id"]: r["taken"] // r["size"] for r in judged("op1_mixing") if r["taken"]}
    assert 20 < len(copies) < len(texts) < pq.read_metadata(f"{SF_DIR}/documents.parquet").num_rows

    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    ids = {
        i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID], dtype="<u4")
        for i, t in zip(rows["doc_id"].to_pylist(), texts)
    }
    held = Counter()
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        held.update((r.doc_id, at) for at in range(r.start, r.start + r.length))
    assert held == Counter({(i, at): n for i, n in copies.items() for at in range(len(ids[i]))})


def test_the_stages_are_the_operators(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_join", "pii", "mixing", "packing"]
    assert registered.queries()["pipeline"] is corpus_pipeline.run
    empty = documents(spark, [])
    for operator in (quality_rules.keep_clean, ngram_join.distinct_documents, pii.redact, mixing.mixed):
        assert operator(empty).columns == empty.columns


def test_every_operator_is_registered():
    names = [n for n in registered.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
