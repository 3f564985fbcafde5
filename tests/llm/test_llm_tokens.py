"""Token ids, packing and token files against the tokenizer itself, and exact round trips."""

import zlib

import numpy as np
import pytest
from cases import DOCS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderloom.llm import packing, token_files, tokens
from orderloom.llm.queries import tokenizer_path

PLAIN = Tokenizer.from_file(tokenizer_path())


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aAbB.,'sS \t\n\x01\x0b\x1c\x85̱́hHİΣςé!?1½<|endoftext|>\U0001f600", max_size=25), max_size=4))
def test_words_encoded_apart_give_the_ids_of_the_whole(texts):
    found = tokens.encoder(tokenizer_path()).encode(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in found] == [plain_ids(t) for t in texts]


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    own = tokens.Encoder(tokenizer_path())
    for _, text, _ in DOCS:
        assert np.frombuffer(own.encode([text])[0], "<u2").tolist() == plain_ids(text)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("window", [2048, 64])
def test_pieces_cover_each_document_and_each_window(spark, window):
    docs = [(i, t, s) for i, t, s in DOCS if i not in (6, None)]
    found = packing.pieces(documents(spark, docs).repartition(5), tokenizer_path(), end_id=1, window=window).collect()
    by_doc, by_window = {}, {}
    for r in found:
        by_doc.setdefault(r.id, []).append((r.start, r.length, r.ids))
        by_window.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for i, text, _ in docs:
        pieces, ids = sorted(by_doc[i]), [*plain_ids(text), 1]
        assert [s for s, _, _ in pieces] == [sum(n for _, n, _ in pieces[:k]) for k in range(len(pieces))]
        assert np.frombuffer(b"".join(x for _, _, x in pieces), "<u4").tolist() == ids
    for k, pieces in by_window.items():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:j]) for j in range(len(pieces))]
        assert sum(n for _, n in pieces) == window or k == max(by_window)
    assert sorted(by_window) == list(range(len(by_window)))


def test_sequences_are_padded_except_at_a_power_of_two(spark):
    docs = documents(spark, [(1, "a " * 20, "x"), (2, "b " * 9, "x")])  # 21 + 10 ids
    found = packing.pieces(docs, tokenizer_path(), end_id=1, window=16).cache()
    filled = {r.sequence_id: (r.n_tokens, len(r.ids) // 4) for r in packing.sequences(found, 16, pad_id=0).collect()}
    assert filled == {0: (16, 16), 1: (15, 16)}
    four = packing.pieces(documents(spark, [(1, "a " * 19, "x")]), tokenizer_path(), end_id=1, window=16)
    assert {r.sequence_id: (r.n_tokens, len(r.ids) // 4) for r in packing.sequences(four, 16).collect()} == {0: (16, 16), 1: (4, 4)}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**16 - 1), min_size=1, max_size=70), st.booleans(), st.sampled_from(["<u2", "<u4"]))
def test_planes_round_trip(ids, bits, kind):
    ids = np.array(ids, kind)
    assert (token_files.from_planes(token_files.to_planes(ids, bits), len(ids), ids.dtype, bits) == ids).all()


@pytest.mark.parametrize("bits", [True, False])
def test_file_round_trip_by_blocks(tmp_path, monkeypatch, bits):
    monkeypatch.setattr(token_files, "BLOCK", 100)
    import pyarrow as pa

    rng, docs = np.random.default_rng(3), []
    out = token_files.Writer(f"{tmp_path}/x.planes", np.dtype("<u2"), bits, 3)
    for k in range(12):
        ids = [rng.integers(0, 49408, rng.integers(1, 260)).astype("<u2") for _ in range(k)]
        if ids:
            out.add(pa.array(range(len(docs), len(docs) + k), pa.int64()), [x.tobytes() for x in ids])
        docs += ids
    assert out.close()[:2] == (len(docs), sum(map(len, docs)))
    reader, whole = token_files.Reader(f"{tmp_path}/x.planes"), np.concatenate(docs)
    assert reader.docs.column("n").to_pylist() == [len(x) for x in docs]
    for a, b in [(0, len(whole)), (99, 101), (250, 250), (1234, 1301)]:
        assert (reader.ids(a, b) == whole[a:b]).all()
    (tmp_path / "cut").write_bytes((tmp_path / "x.planes").read_bytes()[:-9])
    with pytest.raises(ValueError, match="cut short"):
        token_files.Reader(f"{tmp_path}/cut")


def test_files_hold_all_ids_in_order_of_ids(spark):
    docs = [(i, t, s) for i, t, s in DOCS if i not in (6, None)]
    manifest = token_files.write(documents(spark, docs[::-1]).repartition(4), tokenizer_path(), end_id=2)
    found = {r.id: tuple(r)[1:] for r in token_files.read(manifest, documents(spark).schema["doc_id"].dataType).collect()}
    start = 0
    for i, text, _ in sorted(docs):
        ids = [*plain_ids(text), 2]
        assert found[i] == (start, len(ids), crc(ids))
        start += len(ids)
    assert sum(r.n_ids for r in manifest.collect()) == start
