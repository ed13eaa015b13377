"""Parts that run inside tasks, without Spark."""

import io
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from medalla.llm import common, language, near_dups, pack, quality, shingles, warc
from medalla.llm.line_templates import line_keys
from medalla.llm.token_store import EliasFano
from medalla.llm.tokens import Encoder, default_tokenizer

from . import odd


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_tokenizer(), memo_pieces=50)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=5))
def test_ids_are_those_of_the_library(encoder, texts):
    want = [np.array(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == want


def test_ids_of_odd_texts(encoder):
    texts = ["", None, "\x1c a\x85b c", "İstanbul ΣΑΣ. é e ́x don't I'M 12,5. <|endoftext|> a<|endoftext|>b ''s ...,, a., x'.", "a." * 5000]
    for _ in range(2):  # from the library, then from the memo
        assert encoder.encode(texts) == [encoder._ids(t or "") for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**12), max_size=700))
def test_elias_fano_selects(values):
    values = sorted(values)
    raw = EliasFano.of(values).to_bytes()
    back, end = EliasFano.from_bytes(b"??" + raw, 2)
    assert end == len(raw) + 2 and back.n == len(values)
    assert back.select(0, len(values)).tolist() == values
    for i in random.Random(0).sample(range(len(values)), min(5, len(values))):
        assert back.select(i) == values[i]
        assert back.select(i, min(len(values), i + 300)).tolist() == values[i : i + 300]


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 50_000))
    assert len(EliasFano.of(ends).to_bytes()) * 8 / len(ends) < 13  # 2 + log2(1000) bits, and places


def test_shingles_match_plain_python(monkeypatch):
    monkeypatch.setattr(shingles, "SEGMENT", 1000)  # long texts are hashed in segments
    texts = [t for _, t in odd.documents()] + ["A  b\x0bC d e f", "a b c d e F", "a b c", "A b\tc"]
    sets = shingles.shingle_sets(pa.array(texts))
    plain = [odd.shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert len(np.intersect1d(a, b)) == len(plain[i] & plain[j])


def test_super_min_hash_estimates_with_less_variance():
    rng, errors = np.random.default_rng(1), []
    for _ in range(150):
        a = rng.integers(0, 2**63, 60, dtype=np.uint64)
        b = np.append(a[:45], rng.integers(0, 2**63, 15, dtype=np.uint64))
        one, two = near_dups.super_min_hash([np.sort(a), np.sort(b)], 128)
        errors.append((one == two).mean() - 45 / 75)
    assert abs(np.mean(errors)) < 0.015
    assert np.std(errors) < 0.9 * np.sqrt(0.6 * 0.4 / 128)


def test_super_min_hash_by_the_book():
    """Against the definition: each element's ranks in its own random order of the slots."""
    slots, sets = 8, [np.array([3, 99], np.uint64), np.array([], np.uint64), np.arange(40, dtype=np.uint64)]
    got = near_dups.super_min_hash(sets, slots)
    for row, s in zip(got, sets):
        want = [2**64 - 1] * slots
        for e in s:
            order = list(range(slots))
            for step in range(slots):
                draw = int(shingles.mix(np.array([(int(e) + (step + 1) * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
                pick = step + ((draw & 0xFFFFFFFF) * (slots - step) >> 32)
                order[step], order[pick] = order[pick], order[step]
                want[order[step]] = min(want[order[step]], step << 32 | draw >> 32)
        assert row.tolist() == want


def test_sum_of_squares_packs_within_bounds():
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1, 2049, 4000))[::-1]
    sequence, offset = pack.sum_of_squares(lengths, 2048)
    for s in set(sequence.tolist()):
        own = sorted(zip(offset[sequence == s], lengths[sequence == s]))
        at = 0
        for o, n in own:
            assert o == at
            at += n
        assert at <= 2048
    assert sequence.max() + 1 <= 1.01 * max(np.ceil(lengths.sum() / 2048), (lengths > 1024).sum())


def test_sum_of_squares_takes_the_smallest_sum():
    lengths, size = [3, 3, 2, 4, 1, 5, 2, 2, 6, 1], 7
    bins: list[int] = []
    got, _ = pack.sum_of_squares(lengths, size)
    for n, where in zip(lengths, got):
        squares = lambda b: sum(sum(x == g for x in b) ** 2 for g in range(1, size))
        choices = {i: squares(bins[:i] + [g - n] + bins[i + 1 :]) for i, g in enumerate(bins) if g >= n}
        choices = choices or {len(bins): 0}
        assert choices[where] == min(choices.values())
        bins = bins[:where] + [bins[where] - n] + bins[where + 1 :] if where < len(bins) else bins + [size - n]


def test_line_keys_generalise_one_field_and_digits():
    line = "the quick brown fox jumps over the lazy dog near the old river bank"
    other = line.replace("lazy", "sleepy")
    far = line.replace("fox", "cat").replace("bank", "side")
    _, text, number, ends, keys, fresh = line_keys(pa.array([f"{line}\n\n{line}", other, far, "order 12 of 3 is ready", "Order 7 of 99 is ready", None]))
    of = {(t, n): set(keys[a:b].tolist()) for t, n, a, b in zip(text, number, ends, ends[1:])}
    assert of[0, 0] == of[0, 2] and len(of[0, 0]) == 5
    assert fresh[ends[1] : ends[2]].tolist() == [0] * 5
    assert len(of[0, 0] & of[1, 0]) == 1 and not of[0, 0] & of[2, 0]
    assert of[3, 0] == of[4, 0] and len(of[3, 0]) == 1
    assert not any(t == 5 for t, _ in of)


def test_quality_grams_stay_within_texts():
    parts = ["abcdef gh", "", "x", "gh! gh! gh!"]
    together = quality.grams(pa.array(parts))
    for i, text in enumerate(parts):
        alone = quality.grams(pa.array([text]))
        a, b = together[1][i], max(together[1][i], together[2][i])
        assert together[0][a:b].tolist() == alone[0][alone[1][0] : max(alone[1][0], alone[2][0])].tolist()
        assert together[3][together[4][i] : together[4][i + 1]].tolist() == alone[3].tolist()
        assert together[5][together[6][i] : together[6][i + 1]].tolist() == alone[5].tolist()


def test_linear_machine_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 20))
    y = np.where(x[:, 3] - x[:, 5] > 0, 1.0, -1.0)
    w, bias = language.fit_machine(x, y)
    assert (np.sign(x @ w + bias) == y).mean() > 0.95


@pytest.mark.parametrize("size", [1, 7, 100, 1 << 18])
def test_archive_reads_in_any_piece_size(size):
    rng, raw, want = random.Random(5), b"", []
    for page, n in enumerate([0, 1, 5, 1000, 3333]):
        body = bytes(rng.randrange(256) for _ in range(n))
        row = {"page_id": page, "url": "http://x/ä b\r\n", "length": n, "digest": "D", "record_type": "response", "refers_to": None}
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        raw += packer.compress(warc._head(row) + body + b"\r\n\r\n") + packer.flush()
        want.append((page, body))
    got: dict[int, bytes] = {}
    for row in warc.records(io.BytesIO(raw), size):
        got[row["page_id"]] = got.get(row["page_id"], b"") + row["data"]
        assert len(row["data"]) <= max(1, size)
    assert sorted(got.items()) == want
    with pytest.raises((EOFError, ValueError)):
        list(warc.records(io.BytesIO(raw[:-30]), size))


def test_packing_encodes_little_text_at_once(monkeypatch):
    sizes, real = [], Encoder.encode_block
    monkeypatch.setattr(Encoder, "encode_block", lambda self, texts: sizes.append(sum(len(t or "") for t in texts)) or real(self, texts))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(30)), "text": ["some words " * 10_000] * 30})
    out = list(pack._cutter(default_tokenizer(), 0, 2048)([batch]))
    assert max(sizes) <= 1 << 20 and sum(s for s in sizes if s > 100) == 30 * 110_000  # the encoder probes itself with a short one
    assert [i for b in out for i, p in zip(b.column("doc_id").to_pylist(), b.column("piece").to_pylist()) if p == 0] == list(range(30))


def test_packing_in_the_pipeline_keeps_a_small_memo():
    texts = [" ".join(f"{i:06d}" for i in range(at, at + 20_000)) for at in range(0, 400_000, 20_000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    cut = lambda **memory: pa.Table.from_batches(list(pack._cutter(default_tokenizer(), 0, 2048, **memory)([batch])))
    small = cut(**corpus_pipeline.PACKING_MEMORY)
    (kept,) = sys.modules["medalla_worker_cache"].kept.values()
    assert 50_000 < len(kept.young) + len(kept.old) <= 120_000
    common.worker_cache("packing")
    assert small == cut()


def test_groups_are_packed_without_the_encoder_beside_them():
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words", None]})
    cut = pa.Table.from_batches(list(pack._cutter(default_tokenizer(), 0, 2048)([batch])))
    kept = sys.modules["medalla_worker_cache"]
    assert kept.owner == "tokens" and kept.kept
    group = cut.append_column("uid", pa.array([0, 1])).append_column("group", pa.array([0, 0], pa.int64()))
    assert pack._packer(2048)(group).column("offset").to_pylist() == [0, cut.column("length")[0].as_py()]
    assert kept.owner != "tokens" and not kept.kept


def test_each_task_gives_freed_memory_back(monkeypatch):
    times = []
    monkeypatch.setattr(common, "give_back", lambda: times.append(1), raising=False)
    for _ in range(3):
        common.worker_cache("some operator")
    assert len(times) == 3
