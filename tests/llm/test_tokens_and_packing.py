"""Operators 4, 5 and 7 against the tokenizers library and exact round trips."""

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from llm_cases import EDGES, SF, edges  # noqa: F401

from forecastry.llm import packing, tokens

WORD, BYTE = path("word_bpe_49k.json"), path("byte_bpe_50k.json")
ALPHABET = st.sampled_from([*"abcXYZ019 .,'!\n\t  éé́ßİΣς漢\U0001f600\x1c\x85 ", "<|endoftext|>", "'s", " the"])
TEXTS = st.lists(ALPHABET, max_size=40).map("".join)


def test_counts_equal_the_library(spark, edges):
    t = Tokenizer.from_file(WORD)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(edges.select("doc_id", "text"))
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(t.encode(r.text or "", add_special_tokens=False).ids))
                  for r in docs.collect())
    got = tokens.token_counts(docs, WORD).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


@settings(max_examples=200, deadline=None, derandomize=True)
@given(TEXTS)
def test_counter_and_encoder_on_any_text(text):
    if not hasattr(test_counter_and_encoder_on_any_text, "made"):
        test_counter_and_encoder_on_any_text.made = (
            tokens.ChunkCounts(WORD, tokens.proven_whole_tokens(WORD)), Tokenizer.from_file(WORD),
            packing.Encoder(BYTE), Tokenizer.from_file(BYTE))
    counter, word, encoder, byte = test_counter_and_encoder_on_any_text.made
    assert counter.text_tokens(text) == len(word.encode(text, add_special_tokens=False).ids)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == byte.encode(text, add_special_tokens=False).ids


def test_every_compared_character():
    encoder, byte = packing.Encoder(BYTE), Tokenizer.from_file(BYTE)
    assert encoder.fast is not None
    for c in map(chr, range(0x250)):
        for text in (c, f"a{c}b", f" {c}", f"{c} x", f"a {c}{c}\n  {c}1"):
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == byte.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None, derandomize=True)
@given(st.lists(st.integers(1, 15), max_size=60))
def test_best_fit_decreasing_against_a_plain_search(lengths):
    where, offset, n = packing.best_fit_decreasing(lengths, 16)
    free: list[int] = []
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [f for f in free if f >= lengths[k]]
        if fits:
            free[free.index(min(fits))] -= lengths[k]
        else:
            free.append(16 - lengths[k])
    used = defaultdict(list)
    for w, o, size in zip(where, offset, lengths):
        used[w].append((o, size))
    assert sorted(16 - sum(s for _, s in v) for v in used.values()) == sorted(free) and n == len(free)
    for v in used.values():
        assert [o for o, _ in sorted(v)] == np.cumsum([0] + [s for _, s in sorted(v)])[:-1].tolist()


def _expected_ids():
    byte = Tokenizer.from_file(BYTE)
    return lambda text: byte.encode(text or "", add_special_tokens=False).ids + [0]


def test_pieces_hold_every_id_once(spark, edges):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id > 10").union(
        edges.select("doc_id", "text").dropDuplicates(["doc_id"]))
    ids = _expected_ids()
    texts = {r.doc_id: ids(r.text) for r in docs.collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack_pieces(docs, BYTE, 1024).collect():
        part = texts[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(texts[r.doc_id]) and len(part) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for d, got in pieces.items():
        assert [s for s, _ in sorted(got)] == np.cumsum([0] + [n for _, n in sorted(got)])[:-1].tolist()
        assert sum(n for _, n in got) == len(texts[d])
    for got in sequences.values():
        assert [o for o, _ in sorted(got)] == np.cumsum([0] + [n for _, n in sorted(got)])[:-1].tolist()
        assert sum(n for _, n in got) <= 1024
    full = sum(map(len, texts.values()))
    assert len(sequences) * 1024 - full < 0.03 * full + 1024


def test_matrices_round_trip(spark, edges, tmp_path):
    docs = edges.select("doc_id", "text").dropDuplicates(["doc_id"])
    ids = _expected_ids()
    texts = {d: ids(t) for d, t in EDGES}
    back = defaultdict(dict)
    for r in packing.write_matrices(packing.pack_matrices(docs, BYTE, 256), str(tmp_path / "m")).collect():
        row = np.frombuffer(r.ids, "<u4").tolist()
        assert len(row) == 256 and not any(row[r.n_tokens :]) and r.cu_seqlens[-1] == r.n_tokens
        assert r.position_resets == r.cu_seqlens[:-1]
        positions = packing.position_ids(r.position_resets, r.n_tokens, 256)
        for d, s, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            back[d][s] = row[a:b]
            assert positions[a:b].tolist() == list(range(b - a))
    assert {d: sum((p[s] for s in sorted(p)), []) for d, p in back.items()} == texts


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.token_counts(none, WORD).count() == 0
    assert packing.pack_pieces(none, BYTE).count() == packing.pack_matrices(none, BYTE).count() == 0
