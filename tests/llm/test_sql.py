"""Every corpus query against its SQL, or against brute force where SQL cannot express it."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

from tabkit.llm.queries import QUERIES, SQL
from tests.support import same_rows

TABLES = ["documents", "embeddings", "pages", "conversations", "benchmark"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(name, spark, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    assert same_rows(QUERIES[name](spark, sf).toPandas(), con.sql(SQL[name]).df()) is None


def texts(spark, sf):
    return {r[0]: r[1] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


def test_token_counts_as_the_library(spark, sf):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in QUERIES["op2_token_counts"](spark, sf).collect()}
    every = texts(spark, sf)
    assert got.keys() == every.keys()
    for i, t in every.items():
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len(t.encode()), n > 2048)


def test_byte_pairs_as_the_library(spark, sf):
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in QUERIES["op5_byte_bpe"](spark, sf).collect()}
    for i, t in texts(spark, sf).items():
        ids = library.encode_ordinary(t)
        raw = np.array(ids, "<u4").tobytes()
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_packing_whole_dense_and_small(spark, sf):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = QUERIES["op9_best_fit_packing"](spark, sf).toPandas()
    expected = {}
    for i, t in texts(spark, sf).items():
        ids = [*library.encode(t, add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k : k + 4096], "<u4").tobytes()
            expected[i, k // 4096] = (k, len(part) // 4, zlib.crc32(part))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == expected
    got = got.sort_values(["sequence_id", "offset"])
    sizes = got.groupby("sequence_id")["length"]
    assert (sizes.cumsum() - got["length"] == got["offset"]).all() and sizes.sum().max() <= 4096
    assert len(sizes) <= 1.02 * -(-int(got["length"].sum()) // 4096) + 1


def test_languages_held_out(spark, sf):
    got = QUERIES["op3_language_id"](spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    assert (both.held_out == both.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    assert (both.lang == both.lang_pred)[both.held_out].mean() > 0.97
    assert both.score.between(0, 1).all()
