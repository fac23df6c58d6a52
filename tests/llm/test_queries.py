"""Registered queries that SQL cannot express, against brute force on the smallest data."""

import hashlib
import zlib

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

from carelattice.llm import queries
from tests.llm import test_pii, test_simhash


@pytest.fixture(scope="module")
def docs(sf_dir):
    return pd.read_parquet(f"{sf_dir}/documents.parquet")


def test_op3(spark, sf_dir, docs):
    got = queries.op3_simhash(spark, sf_dir).toPandas()
    prints = {i: test_simhash.naive(t) for i, t in zip(docs.doc_id, docs.text)}
    roots = test_simhash.brute(set(prints.values()), 4)
    least = {}
    for i, p in sorted(prints.items()):
        least.setdefault(roots[p], i)
    want = sorted((i, f"{p:016x}", least[roots[p]]) for i, p in prints.items())
    assert sorted(got[["doc_id", "fingerprint", "component_id"]].itertuples(index=False, name=None)) == want


def test_op7(spark, sf_dir, docs):
    got = queries.op7_packing(spark, sf_dir).toPandas()
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    texts = tokenizer.encode_batch(docs.text.tolist(), add_special_tokens=False)
    ids = {i: np.array([*e.ids, 2], "<u4") for i, e in zip(docs.doc_id, texts)}
    for r in got.itertuples():
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
    assert got.groupby("doc_id").length.sum().to_dict() == {i: len(x) for i, x in ids.items()}
    windows = got.sort_values("offset").groupby("sequence_id").length
    assert (windows.cumsum() - got.length == got.offset).all()
    assert all(n == 4096 or (n < 4096 and n & (n - 1) == 0) for n in windows.sum())


def test_op8(spark, sf_dir, docs):
    got = queries.op8_pii(spark, sf_dir).toPandas().set_index("doc_id")
    for i, text in zip(docs.doc_id, docs.text):
        base = test_pii.naive(text)
        row, listed = got.loc[i], [f"{('email', 'ip', 'card', 'phone')[k]}:{s}:{e}" for k, s, e in base]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == n for k, _, _ in base) for n in range(4)]
        assert set(listed) <= set(row.spans.split(",")) | {""}
