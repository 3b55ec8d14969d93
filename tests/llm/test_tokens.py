"""Token operators against the tokenizers library, document by document."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from rategrid.llm import bpe, packing, token_output
from rategrid.llm.queries import QUERIES
from rategrid.llm.tokens import VOCABULARY, Words
from rategrid.plans.registry import table

SF = "/root/testdata/sf0.001"
ODD = [
    "", None, " \n\t", "Hello,   WORLD's é don't<|endoftext|> xİİ 12", "a\x0bb\x0cc\x1cd\x85e f\xa0g \x85",
    "Å Å Å é ́x ΑΣ ΟΔΟΣ ẞ K", "<|ENDOFTEXT|> hi<|startoftext|>", "'s 't x's !,. don't, we'll.",
    "日本語 テキスト 🙂🙂 a🙂b", "word " * 3000, "x" * 5000, "été, ÉTÉ. naïve! TRE!! %%% a1b2",
]
SCHEMA = "doc_id bigint, text string, ids string, key int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def odd_docs(spark):
    rows = [(i if i != 2 else None, t, "clash", 1) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[3], rows[3]], SCHEMA)


def test_word_table(library):
    for table_ in (Words(VOCABULARY), Words(VOCABULARY, words=3)):
        for text in ODD:
            assert np.frombuffer(table_.ids(text or ""), "<u4").tolist() == ids_of(library, text)


def test_cuts():
    for n in [*range(1, 5000), 10**6 + 17]:
        found = packing.cuts(n)
        assert sum(found) == n and max(found) <= 2048 and min(found) >= 1
        assert len(found) <= n // 2048 + 6


def check_packing(rows, wanted):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for doc, found in by_doc.items():
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            ids = np.array(wanted[doc], "<u4")
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(wanted[doc])
    filled = []
    for found in by_seq.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        filled.append(at)
    return filled


def test_packing_query(spark, library):
    docs = {r["doc_id"]: ids_of(library, r["text"]) + [1] for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op1_packing"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(docs)
    filled = check_packing(rows, docs)
    padding = sum(2048 - n for n in filled if n & (n - 1)) / sum(map(len, docs.values()))
    assert padding < 0.03


def test_packing_over_many_workers(spark, library):
    docs = table(spark, SF, "documents")
    filled = [
        sum(2048 - n for n in check_packing(
            packing.pack(docs.repartition(n)).collect(),
            {r["doc_id"]: ids_of(library, r["text"]) + [1] for r in docs.collect()},
        )) for n in (1, 13)
    ]
    assert max(filled) - min(filled) < 4 * 2048


def test_packing_odd_rows(spark):
    rows = packing.pack(odd_docs(spark)).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 0) == 1
    assert sum(r["length"] for r in rows if r["doc_id"] is None) == 1
    assert sum(r["start"] == 0 for r in rows if r["doc_id"] == 3) == 3
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_codes():
    rng = random.Random(1)
    for n in (0, 1, 3, 4, 5, 1000):
        given = np.array([rng.choice([rng.randrange(256), rng.randrange(1 << 16), rng.randrange(1 << 32)]) for _ in range(n)], np.uint32)
        control, data = token_output.code(given)
        back = token_output.decode(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
        assert back.tolist() == given.tolist() and len(control) == -(-n // 4)
    with pytest.raises(ValueError):
        token_output.read_block(b"none of ours, not at all")


def test_token_output_query(spark, library, monkeypatch):
    start, wanted = 0, []
    for r in table(spark, SF, "documents").orderBy("doc_id").collect():
        ids = np.array(ids_of(library, r["text"]) + [1], "<u4")
        wanted.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op3_token_output"](spark, SF).collect()) == wanted


def test_token_output_odd_rows(spark, library):
    written = token_output.write(odd_docs(spark))
    found = sorted(token_output.read(written).collect(), key=lambda r: r["start"])
    assert found[0]["doc_id"] is None and [r["doc_id"] or 0 for r in found] == sorted(r["doc_id"] or 0 for r in found)
    at = 0
    for r in found:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert r["start"] == at and r["n_tokens"] == len(ids)
        assert ids == ids_of(library, ODD[2 if r["doc_id"] is None else r["doc_id"]]) + [1]
        at += len(ids)
    none = token_output.write(spark.createDataFrame([], SCHEMA))
    assert token_output.read(none).count() == 0 and token_output.read(none, checks=True).count() == 0


def digest(ids, text):
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_bpe_query(spark, library):
    wanted = {}
    for r in table(spark, SF, "documents").collect():
        ids = ids_of(library, r["text"])
        wanted[r["doc_id"]] = digest(ids, library.decode(ids, skip_special_tokens=False))
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op5_bpe"](spark, SF).collect()}
    assert found == wanted


def test_bpe_odd_rows(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 20)
    found = bpe.encode_and_decode(odd_docs(spark).repartition(3)).collect()
    assert len(found) == len(ODD) + 2 and sum(r["doc_id"] == 3 for r in found) == 3
    for r in found:
        ids = ids_of(library, ODD[2 if r["doc_id"] is None else r["doc_id"]])
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode_and_decode(spark.createDataFrame([], SCHEMA)).count() == 0


def test_files_are_read_by_another_session(spark, tmp_path):
    docs = spark.createDataFrame([(2, "two words"), (1, None), (None, "x"), (2, "two words")], "doc_id bigint, text string")
    folder = str(tmp_path / "out")
    own = token_output.read(token_output.write(docs, folder=folder)).collect()
    other = token_output.read(token_output.load(spark.newSession(), folder)).collect()
    assert sorted(map(tuple, own), key=repr) == sorted(map(tuple, other), key=repr) and len(own) == 4
    again = token_output.read(token_output.write(docs)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, own), key=repr)
